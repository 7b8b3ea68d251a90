"""Distinct values of a key in chunks of bounded size, where an array per key may not fit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 10_000


def _joined(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """A join on columns of both sides, NULL equal to NULL."""
    there = {c: f"_other_{n}" for n, c in enumerate(columns)}
    renamed = right.withColumnsRenamed(there)
    same = reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(o)) for c, o in there.items()])
    return left.join(renamed, same, how).drop(*there.values())


def chunked_sets(df: DataFrame, keys: Sequence[str], value: str, size: int = CHUNK) -> DataFrame:
    """The distinct values of each key as rows of ``size`` values at most: the keys, ``chunk``
    (from 0), ``chunks`` (how many the key has) and ``values`` (sorted).

    NULL values are left out, as in a collected set; NULL keys are keys. A key of ``size``
    values or fewer is one chunk. The values of a larger key are ranked by a digest: slots of
    (key, digest prefix) are counted, their sizes give each slot's start, and only the values
    of one slot are ordered together. So all its chunks but the last are full, a key of a
    third of all rows spreads over 65,536 slots, and no task or row holds all its values.
    """
    for name in ("chunk", "chunks", "values"):
        if name in keys:
            raise ValueError(f"{name} is the name of a result column")
    pairs = df.select(*keys, F.col(value).alias("_value")).where("_value is not null").distinct()
    counts = pairs.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = counts.where(F.col("_n") > size)
    marked = _joined(pairs, large, keys, "left")
    small = (
        marked.where("_n is null")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_value")).alias("values"))
        .select(*keys, F.lit(0).cast("bigint").alias("chunk"), F.lit(1).cast("bigint").alias("chunks"), "values")
    )
    spread = (
        marked.where("_n is not null")
        .withColumn("_digest", F.sha2(F.col("_value").cast("string"), 256))
        .withColumn("_slice", F.substring("_digest", 1, 4))
    )
    slot = [*keys, "_slice"]
    sizes = spread.groupBy(*slot).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_slice")) - F.col("_size")
    starts = sizes.select(*slot, before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*slot).orderBy("_digest", "_value")) - 1
    placed = _joined(spread.withColumn("_rank", rank), starts, slot, "inner")
    chunk = F.floor((F.col("_before") + F.col("_rank")) / size)
    cut = placed.groupBy(*keys, chunk.alias("chunk"), F.ceil(F.col("_n") / size).alias("chunks"))
    full = cut.agg(F.array_sort(F.collect_list("_value")).alias("values"))
    return small.unionByName(full)


def whole_sets(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The array form of chunks: one row per key with all ``values``, sorted. For keys whose
    values fit one row."""
    return chunks.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("values"))).alias("values"))
