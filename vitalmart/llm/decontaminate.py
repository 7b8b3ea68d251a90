"""Benchmark decontamination by Wu-Manber search over words.

The alphabet is words, a block is two neighbouring words. A shift table says how far the
search may jump after seeing a block; blocks that end a test string have shift 0, and the
bucket of such a block holds the test strings that end with it, which are then compared
word by word. A document of n clean words is read in about n / 12 steps.

Documents are not shuffled: the search is one map over them. Distinct items are dealt by hash
to blocks of about ``block_bytes`` of text, which Spark writes to the shared folder; a task reads
one block after another from there. So a task holds the tables of one block, and the driver
only the folder's path, however long the benchmark is.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import named, parts_for, placed, shared_path, slices, take_over, text_bytes

WINDOW = 13
BLOCK_BYTES = 16 << 20

# A-Z become a-z; digits, a-z and all bytes of non-ASCII characters are word bytes.
_WORD = set((string.digits + string.ascii_lowercase).encode()) | set(range(128, 256))
_TABLE = bytes(
    b if b in _WORD else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode().translate(_TABLE).split()


class WuManber:
    """Multi-pattern search for word sequences, one shift table per pattern length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
        for p in patterns:
            by_length[len(p)].append(p)
        self.patterns = patterns
        self.tables = []
        for m, group in sorted(by_length.items()):
            b = min(2, m)
            shift: dict[tuple[bytes, ...], int] = {}
            bucket: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = defaultdict(list)
            for p in group:
                for end in range(b, m + 1):
                    block = p[end - b : end]
                    shift[block] = min(shift.get(block, m - b + 1), m - end)
                bucket[p[m - b :]].append(p)
            self.tables.append((m, b, shift, dict(bucket)))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Start and pattern of every occurrence, overlapping ones too."""
        n = len(words)
        for m, b, shift, bucket in self.tables:
            skip = m - b + 1
            at = m
            while at <= n:
                block = tuple(words[at - b : at])
                jump = shift.get(block, skip)
                if jump:
                    at += jump
                    continue
                here = tuple(words[at - m : at])
                for p in bucket[block]:
                    if p == here:
                        yield at - m, p
                at += 1


def windows_of(text: str | None, window: int = WINDOW) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if not words:
        return set()
    if len(words) < window:
        return {tuple(words)}
    return {tuple(words[i : i + window]) for i in range(len(words) - window + 1)}


def _item_blocks(items: DataFrame, block_bytes: int) -> tuple[str, int]:
    """Writes the distinct items in blocks of bounded size; the folder and how many blocks.

    A single item is never divided, however long its text is.
    """
    blocks = parts_for(text_bytes(items), block_bytes)
    path = shared_path(items.sparkSession, "benchmark-items")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    dealt = items.distinct().withColumn("block", block).repartition("block")
    dealt.write.partitionBy("block").parquet(path)
    return path, blocks


def _patterns_of(path: str, block: int, window: int) -> dict[tuple[bytes, ...], set[str]]:
    """The windows of one block with the ids of their items; a block may have no file."""
    system, place = fs.FileSystem.from_uri(path)
    patterns: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for file in system.get_file_info(fs.FileSelector(f"{place}/block={block}", allow_not_found=True)):
        if not file.path.endswith(".parquet"):
            continue
        with system.open_input_file(file.path) as opened:
            rows = pq.ParquetFile(opened).read(["item_id", "text"]).to_pydict()
        for item, text in zip(rows["item_id"], rows["text"], strict=True):
            for w in windows_of(text, window):
                patterns[w].update(() if item is None else (item,))
    return dict(patterns)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


EMPTY_SPANS = "array<struct<start:bigint,end:bigint>>"


def _searched(docs: DataFrame, items: DataFrame, columns: tuple[str, ...], text_col: str, window: int, block_bytes: int) -> DataFrame:
    """Columns by place, then ``n_words``, ``spans`` and ``items``, from one map."""
    frame, text = placed(docs, columns, text_col)
    found = frame.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast(EMPTY_SPANS).alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    bench = items.where(F.length("text") > 0).select(F.col("item_id").cast("string"), "text")
    path, blocks = _item_blocks(bench, block_bytes)
    return frame.mapInArrow(_searcher(path, blocks, window, text), found.schema)


def find_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Where windows of benchmark items (``item_id``, ``text``) occur in each document.

    Returns one row per row of ``docs``: ``doc_id``, ``n_words``, ``spans`` (disjoint word
    ranges that windows cover, end exclusive, in order) and ``items`` (ids as text of the
    items with occurring windows, sorted, each once). A window is ``window`` consecutive words
    of an item; a shorter item with words is one window. NULL or empty texts have no words.
    Items without words or text match nothing; items with a NULL id match but are not listed;
    equal items and repeated rows count once in ``items``. Without items or documents the
    result has no matches or rows. Other columns are left out.
    """
    found = _searched(docs, items, (id_col,), text_col, window, block_bytes)
    return found.select(F.col("c0").alias("doc_id"), "n_words", "spans", F.array_sort("items").alias("items"))


def keep_clean(
    docs: DataFrame, items: DataFrame, *, text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = _searched(docs, items, tuple(docs.columns), text_col, window, block_bytes)
    return found.where(~is_contaminated(n_hit(), F.col("n_words"))).select(*named(docs.columns))


def _searcher(path: str, blocks: int, window: int, text_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("decontaminate")
        held: dict[int, WuManber] = {}

        def engine_of(block: int) -> WuManber:
            if block not in held:
                held.clear()
                held[block] = WuManber(_patterns_of(path, block, window))
            return held[block]

        # With several blocks, each is read once a slice, so slices are larger.
        most = (4 if blocks == 1 else 64) << 20
        for whole in batches:
            for batch in slices(whole, text_name, most):
                texts = batch.column(text_name)
                n_words = [0] * batch.num_rows
                hits: list[list[tuple[int, int]]] = [[] for _ in n_words]
                names: list[set[str]] = [set() for _ in n_words]
                for block in range(blocks):
                    engine = engine_of(block)
                    for row, text in enumerate(texts):
                        words = words_of(text.as_py())
                        n_words[row] = len(words)
                        for start, p in engine.find(words):
                            hits[row].append((start, start + len(p)))
                            names[row] |= engine.patterns[p]
                        hits[row] = _joined(hits[row])
                spans = [[{"start": a, "end": b} for a, b in found] for found in hits]
                made = [pa.array(n_words, pa.int64()), pa.array(spans, SPANS), pa.array(map(sorted, names), pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "n_words", "spans", "items"])

    return run


def n_hit(spans: str | Column = "spans") -> Column:
    """Words inside any occurrence."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(n_hit_col: Column, n_words: Column) -> Column:
    """A twentieth of the words or more lies inside occurrences."""
    return (n_hit_col > 0) & (F.lit(20) * n_hit_col >= n_words)


def op7_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of the contract from the operator's spans and items."""
    found = find_items(docs, items).select("doc_id", "n_words", n_hit().alias("n_hit"), "items")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )
