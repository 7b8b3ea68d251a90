"""Quality classifier: a byte-level convolutional network in numpy.

A filter is a table of weights, one for each of ``WIDTH`` places and 256 byte values. Filters
slide over all bytes of a document; the document is cut into overlapping chunks of ``CHUNK``
bytes that cover it whole, each filter keeps its largest value in a chunk, and the mean and
the maximum over the chunks give one probability. Texts are read in pieces of bounded size,
so a very long document needs no more memory than its block maxima, a quarter of it.

The network is fitted on the driver on a bounded sample of labelled rows: the first
``max_docs`` by a hash of the id, of texts up to ``max_bytes``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalmart.llm.common import computed, named, take_over, texts

WIDTH = 6
FILTERS = 16
BLOCK = 64
CHUNK_BLOCKS = 4  # a chunk is 256 bytes, the next begins 192 bytes further
STEP_BLOCKS = 3
PIECE = 1 << 17
MAX_DOCS = 6000
MAX_BYTES = 16_000
THRESHOLD = 0.7


@dataclass
class Network:
    table: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # 2 * FILTERS: for the mean and for the maximum over chunks
    base: float


def padded(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All documents in one array, each zero-padded to whole blocks; blocks of each; and the
    places, ascending, where no window counts.

    The padding holds a filter's width. Windows count that start inside a document (an empty
    one has a window at its first place), so that no filter sees two documents.
    """
    blocks = np.array([-(-(len(d) + WIDTH - 1) // BLOCK) for d in docs], np.int64)
    flat = np.zeros(int(blocks.sum()) * BLOCK + WIDTH - 1, np.uint8)
    at, outside = 0, []
    for d, n in zip(docs, blocks, strict=True):
        flat[at : at + len(d)] = np.frombuffer(d, np.uint8)
        end = at + int(n) * BLOCK
        outside.append(np.arange(at + max(1, len(d)), end))
        at = end
    return flat, blocks, np.concatenate(outside)


def block_maxima(net: Network, flat: np.ndarray, outside: np.ndarray, places: bool = False):
    """Each filter's largest value in each block, and where it is if asked for. Windows at
    the places ``outside`` do not count; a block of these alone has minus infinity."""
    n = len(flat) - WIDTH + 1
    top = np.empty((n // BLOCK, FILTERS), np.float32)
    where = np.empty((n // BLOCK, FILTERS), np.int64) if places else None
    for at in range(0, n, PIECE):
        m = min(PIECE, n - at)
        values = net.table[0].take(flat[at : at + m], 0)
        for j in range(1, WIDTH):
            values += net.table[j].take(flat[at + j : at + j + m], 0)
        values[outside[slice(*outside.searchsorted((at, at + m)))] - at] = -np.inf
        cube = values.reshape(-1, BLOCK, FILTERS)
        b = at // BLOCK
        if places:
            arg = cube.argmax(1)
            where[b : b + len(cube)] = arg + at + np.arange(len(cube))[:, None] * BLOCK
            top[b : b + len(cube)] = np.take_along_axis(cube, arg[:, None], 1)[:, 0]
        else:
            top[b : b + len(cube)] = cube.max(1)
    return top, where


def chunks_of(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last block of every chunk, and the number of the first chunk of each document."""
    counts = 1 + np.maximum(0, -(-(blocks - CHUNK_BLOCKS) // STEP_BLOCKS))
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    starts = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    doc = np.repeat(np.arange(len(blocks)), counts)
    begin = starts[doc] + (np.arange(len(doc)) - firsts[doc]) * STEP_BLOCKS
    end = np.minimum(begin + CHUNK_BLOCKS, (starts + blocks)[doc]) - 1
    return begin, end, firsts


def chunk_maxima(top: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each filter in each chunk, and the block that has it."""
    best, block = top[begin], np.repeat(begin[:, None], FILTERS, 1)
    for k in range(1, CHUNK_BLOCKS):
        other = np.minimum(begin + k, end)
        more = top[other] > best
        best = np.where(more, top[other], best)
        block = np.where(more, other[:, None], block)
    return best, block


def _pooled(net: Network, best: np.ndarray, firsts: np.ndarray):
    hidden = np.tanh(best + net.bias)
    counts = np.diff(np.append(firsts, len(best)))
    mean = np.add.reduceat(hidden, firsts) / counts[:, None]
    high = np.maximum.reduceat(hidden, firsts)
    return hidden, counts, mean, high


def probabilities(net: Network, docs: list[bytes]) -> np.ndarray:
    """Probability of label 1 for each document, from its bytes alone; an empty one scores as
    a single zero byte."""
    if not docs:
        return np.empty(0)
    flat, blocks, outside = padded(docs)
    top, _ = block_maxima(net, flat, outside)
    begin, end, firsts = chunks_of(blocks)
    best, _ = chunk_maxima(top, begin, end)
    _, _, mean, high = _pooled(net, best, firsts)
    # Row by row, not as a product of matrices, whose last bits depend on the number of rows.
    z = (np.concatenate([mean, high], 1).astype(float) * net.out).sum(1) + net.base
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: list[bytes], labels: list[int], *, epochs: int = 14, batch: int = 48, rate: float = 0.02, seed: int = 7) -> Network:
    """Fits the network by Adam; the gradient reaches only the places that won the maximum.

    With one label alone, or no documents, the score is that label's share (0.5 without any).
    """
    rng = np.random.default_rng(seed)
    y = np.array(labels, float)
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    net = Network(
        rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(2 * FILTERS),
        float(np.log(share / (1 - share))),
    )
    if not 0 < y.sum() < len(y):
        return net
    net.out = rng.normal(0, 0.3, 2 * FILTERS)
    params = [net.table, net.bias, net.out, np.array([net.base])]
    first = [np.zeros(p.shape) for p in params]
    second = [np.zeros(p.shape) for p in params]
    step, total = 0, epochs * -(-len(docs) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), batch):
            rows = order[at : at + batch]
            flat, blocks, outside = padded([docs[i] for i in rows])
            top, where = block_maxima(net, flat, outside, places=True)
            begin, end, firsts = chunks_of(blocks)
            best, block = chunk_maxima(top, begin, end)
            hidden, counts, mean, high = _pooled(net, best, firsts)
            x = np.concatenate([mean, high], 1)
            z = x @ params[2] + params[3][0]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            to_x = error[:, None] * params[2][None]
            doc = np.repeat(np.arange(len(rows)), counts)
            winner = hidden >= high[doc]
            to_hidden = to_x[doc, :FILTERS] / counts[doc][:, None] + to_x[doc, FILTERS:] * winner
            to_best = to_hidden * (1 - hidden**2)
            spot = where[block, np.arange(FILTERS)[None]]
            to_table = np.zeros(net.table.shape)
            columns = np.broadcast_to(np.arange(FILTERS), spot.shape)
            for j in range(WIDTH):
                cells = flat[spot + j].astype(np.int64) * FILTERS + columns
                to_table[j] = np.bincount(cells.ravel(), to_best.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            step += 1
            pace = rate * (1 - step / (total + 1)) + 0.001
            grads = [to_table, to_best.sum(0), x.T @ error + 1e-4 * params[2], np.array([error.sum()])]
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    net.base = float(params[3][0])
    return net


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Rows whose labels are not learned: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, *, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES, learn: Column | None = None) -> tuple[list[bytes], list[int]]:
    """At most ``max_docs`` labelled texts of at most ``max_bytes`` each, for the driver.

    Rows that ``learn`` does not hold for, and rows without an id or a label, are left out.
    """
    chosen = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = chosen.where(~held_out() if learn is None else learn)
    short = texts(docs).where(F.octet_length("text") <= max_bytes)
    first = chosen.join(short.select("doc_id"), "doc_id", "left_semi")
    first = first.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_docs)
    rows = short.join(F.broadcast(first), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text", "label").limit(max_docs).collect()
    return [r["text"].encode() for r in rows], [r["label"] for r in rows]


def _scored(docs: DataFrame, net: Network, columns: tuple[str, ...], text_col: str) -> DataFrame:
    def run(batch: list[str]):
        take_over("quality")
        return [pa.array(probabilities(net, [t.encode() for t in batch]), pa.float64())]

    return computed(docs, columns, text_col, [T.StructField("score", T.DoubleType())], run, 1 << 20)


def score(docs: DataFrame, net: Network, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Probability that a text is of quality 1, from its bytes alone: ``doc_id``, ``score``.

    One row per row of ``docs``. NULL texts score as empty ones; equal texts score alike; no
    row gives no row; other columns are left out.
    """
    return _scored(docs, net, (id_col,), text_col).select(F.col("c0").alias("doc_id"), "score")


def keep_good(docs: DataFrame, net: Network, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    found = _scored(docs, net, tuple(docs.columns), text_col).where(F.col("score") >= threshold)
    return found.select(*named(docs.columns))


def op8_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: score and decision at 0.7."""
    net = fit(*sample(docs, labels))
    return score(docs, net).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
