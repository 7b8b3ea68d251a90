"""Document fingerprints by locally consistent parsing.

A text is a string of bytes. On each level, runs of equal symbols become one symbol; then
every symbol is compared with the one left of it and replaced by the place and value of the
lowest bit in which the two differ (deterministic coin tossing). A few such rounds leave
numbers so small that a local maximum stands every few symbols; phrases begin at the maxima,
and the hash of a phrase is a symbol of the next level. Where a phrase begins depends on a
few symbols around it alone, so equal substrings have equal phrases inside, whatever their
offset. The fingerprint holds the smallest phrase names of two levels, 32 bits each: of sets of
m and n names, about m * n / 2**32 agree by chance.

All texts of a batch are parsed at once, level by level, as arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalmart.llm.common import MAX_ID, parts_for, slices, text_bytes, texts

ROUNDS = 4
LEVELS = (2, 3)
KEPT = 32
BUCKET_TEXT_BYTES = 16 << 20
MOST_BUCKETS = 20_000  # beyond, buckets grow; their rows stream, so a large one needs no more memory

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, _ODD, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    """Number of the lowest set bit; x has one."""
    return np.bitwise_count((x & (~x + x.dtype.type(1))) - x.dtype.type(1))


def next_level(names: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names one level up. ``first`` marks the first symbol of each document."""
    fresh = first.copy()
    fresh[1:] |= names[1:] != names[:-1]
    heads = np.flatnonzero(fresh)
    if len(heads) < len(names):
        runs = np.diff(np.append(heads, len(names))).astype(np.uint64)
        names, first = names[heads], first[heads]
        names = np.where(runs > 1, _mix(names + runs * _ODD), names)
        # a run may hash to its neighbour's name only by a collision of 64 bits
    label = names
    for round_ in range(ROUNDS):
        before = np.empty_like(label)
        before[0] = 0
        before[1:] = label[:-1]
        before = np.where(first, ~label, before)
        differ = before ^ label
        differ = np.where(differ == 0, label.dtype.type(1), differ)
        bit = _lowest_bit(differ)
        label = (bit << np.uint8(1)) | ((label >> bit.astype(label.dtype)) & label.dtype.type(1)).astype(np.uint8)
    left = np.empty_like(label)
    left[0], left[1:] = 255, label[:-1]
    right = np.empty_like(label)
    right[-1], right[:-1] = 255, label[1:]
    last = np.append(first[1:], True)
    # a maximum needs both neighbours, and the first two symbols stay together
    begin = (label > left) & (label > right) & ~first & ~last
    begin = begin | first
    heads = np.flatnonzero(begin)
    place = np.arange(len(names)) - np.repeat(heads, np.diff(np.append(heads, len(names))))
    terms = _mix(names + np.uint64(level)) * _POWERS[place & 63]
    sizes = np.diff(np.append(heads, len(names))).astype(np.uint64)
    return _mix(np.add.reduceat(terms, heads) + sizes), first[heads]


def phrases(docs: list[bytes], levels: tuple[int, ...] = LEVELS) -> list[list[np.ndarray]]:
    """Distinct phrase names of each document on each of the levels, as 32 bits, ascending."""
    sizes = np.array([len(d) for d in docs], np.int64)
    full = np.flatnonzero(sizes)
    out = [[np.empty(0, np.uint64) for _ in levels] for _ in docs]
    if not len(full):
        return out
    raw = np.frombuffer(b"".join(docs), np.uint8)
    names = raw.astype(np.uint64) + np.uint64(1)
    first = np.zeros(len(raw), bool)
    first[np.concatenate([[0], np.cumsum(sizes[full])[:-1]])] = True
    for level in range(1, max(levels) + 1):
        names, first = next_level(names, first, level)
        if level in levels:
            k = levels.index(level)
            doc = np.cumsum(first) - 1
            keys = np.unique((doc.astype(np.uint64) << np.uint64(32)) | (names >> np.uint64(32)))
            cuts = np.searchsorted(keys, np.arange(1, len(full)).astype(np.uint64) << np.uint64(32))
            for d, part in zip(full, np.split(keys & np.uint64(0xFFFFFFFF), cuts), strict=True):
                out[d][k] = part
    return out


def fingerprints(docs: list[str]) -> list[str]:
    """Smallest ``KEPT`` names of each level as hex, levels parted by a dash; "" if empty."""
    found = phrases([d.encode() for d in docs])
    return ["-".join(p[:KEPT].astype(">u4").tobytes().hex() for p in ps) if d else "" for d, ps in zip(docs, found, strict=True)]


def likeness(a: str, b: str) -> float:
    """Mean over levels of the share of common names, from 0 to 1.

    Equal fingerprints, empty ones too, give 1; an empty one and another give 0.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    total = 0.0
    parts = list(zip(a.split("-"), b.split("-"), strict=True))
    for x, y in parts:
        xs, ys = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (x, y))
        # Beyond the smaller of two full sketches' ends nothing is known of the other set.
        full = [max(s) for s in (xs, ys) if len(s) == KEPT]
        union = sorted(u for u in xs | ys if not full or u <= min(full))
        total += sum(u in xs and u in ys for u in union) / len(union)
    return total / len(parts)


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text; nothing is shuffled.

    NULL texts count as empty and have the fingerprint "". Equal texts have equal
    fingerprints whatever stands around them; repeated rows give repeated rows.
    """
    frame = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, most=1 << 20):
                found = fingerprints(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fingerprint"])

    schema = T.StructType([frame.schema["doc_id"], T.StructField("fingerprint", T.StringType())])
    return frame.mapInArrow(run, schema)


def phrase_sets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``phrases`` of every whole text: for each of ``LEVELS`` all distinct phrase
    names, ascending, where ``fingerprint`` keeps the smallest ``KEPT``.

    Long texts with a short passage in common have its inner phrases in common. NULL texts
    count as empty and have empty sets; nothing is shuffled; repeated rows give repeated rows.
    """
    frame = texts(docs, id_col, text_col)
    sets = pa.list_(pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, most=1 << 20):
                found = phrases([d.encode() for d in batch.column("text").to_pylist()])
                made = pa.array([[p.astype(np.int64) for p in ps] for ps in found], sets)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "phrases"])

    schema = T.StructType([frame.schema["doc_id"], T.StructField("phrases", T.ArrayType(T.ArrayType(T.LongType())))])
    return frame.mapInArrow(run, schema)


def in_order(frame: DataFrame, bucket_text_bytes: int = BUCKET_TEXT_BYTES) -> DataFrame:
    """Documents in descending order of id, in buckets, each with the next bucket's first row.

    Columns ``bucket``, ``copy`` (the row is that first row), ``doc_id``, ``text``. The text is
    shuffled once, each bucket to a task of its own. The driver sees one id a bucket, of at
    most ``MOST_BUCKETS``, and as many rows of 24 bytes are broadcast. NULL ids come last, rows
    of one id in the order of their texts.
    """
    spark = frame.sparkSession
    schema = "bucket bigint, copy boolean, doc_id bigint, text string"
    n = min(parts_for(text_bytes(frame), bucket_text_bytes), MOST_BUCKETS)
    shares = [i / n for i in range(1, n)]
    cuts = frame.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * n))).first()[0] if shares else None
    edges = np.array(sorted(set(cuts or ()), reverse=True), np.int64)

    @F.pandas_udf("long")
    def bucket(ids: pd.Series) -> pd.Series:
        # bucket b holds ids in (edges[b], edges[b - 1]]
        return pd.Series(len(edges) - np.searchsorted(edges[::-1], ids.to_numpy(), "left"))

    id_or_first = F.coalesce("doc_id", F.lit(-MAX_ID))  # NULLs go to the last bucket
    placed = frame.select(bucket(id_or_first).alias("bucket"), F.lit(False).alias("copy"), "doc_id", "text")
    heads = sorted(tuple(r) for r in placed.groupBy("bucket").agg(F.max("doc_id")).collect())
    if not heads:
        return spark.createDataFrame([], schema)
    before = [(heads[i - 1][0], b, head) for i, (b, head) in enumerate(heads)]
    lead = spark.createDataFrame(before, "to bigint, at bigint, head bigint")
    # MOST_BUCKETS rows at most
    copies = placed.join(F.broadcast(lead), (placed["bucket"] == lead["at"]) & placed["doc_id"].eqNullSafe(lead["head"]))
    copies = copies.groupBy("to").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"))
    rows = placed.unionByName(copies.select(F.col("to").alias("bucket"), F.lit(True).alias("copy"), "doc_id", "text"))
    dealt = rows.repartitionById(len(edges) + 1, F.col("bucket").cast("int"))
    return dealt.sortWithinPartitions("bucket", "copy", F.desc_nulls_last("doc_id"), "text")


def edited(text: str, other: str) -> str:
    """The last half of the text replaced by as many code points from the start of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def op10_fingerprint(docs: DataFrame) -> DataFrame:
    """The contract's columns: each text, its edited form and the next text, fingerprinted."""
    ordered = in_order(texts(docs))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (doc_id, text, fingerprint) of a row whose next row is still to come
        for whole in batches:
            for batch in slices(whole, most=1 << 20):
                copies, bodies = batch.column("copy").to_pylist(), batch.column("text").to_pylist()
                prints = fingerprints(bodies)
                pairs = []
                for doc_id, copy, row in zip(batch.column("doc_id").to_pylist(), copies, zip(bodies, prints, strict=True), strict=True):
                    if held is not None:
                        pairs.append((*held, *row))
                    held = None if copy else (doc_id, *row)
                changed = [edited(text, other) for _, text, _, other, _ in pairs]
                new = fingerprints(changed)
                columns = [
                    [p[0] for p in pairs],
                    [len(p[1]) for p in pairs],
                    [hashlib.sha256(e.encode()).hexdigest() for e in changed],
                    [p[2] for p in pairs],
                    new,
                    [likeness(p[2], e) for p, e in zip(pairs, new, strict=True)],
                    [likeness(p[2], p[4]) for p in pairs],
                ]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, schema)
