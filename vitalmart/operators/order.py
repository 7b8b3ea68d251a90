"""Proof that a frame's rows come in an order, without bringing them together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A column and whether it ascends. NULL is the smallest value, as when Spark sorts.
Key = tuple[str, bool]


def _behind(a: Column, b: Column, ascending: bool) -> Column:
    """``a`` may not stand directly before ``b``."""
    first, second = (a, b) if ascending else (b, a)
    return F.coalesce(first > second, first.isNotNull() & second.isNull())


def _misplaced(before: Column, here: Column, order: Sequence[Key]) -> Column:
    """The struct ``before`` must come after ``here``: behind in one column, equal in all
    columns before it."""
    cases, equal = [], F.lit(True)
    for n, (_, ascending) in enumerate(order):
        a, b = before[f"k{n}"], here[f"k{n}"]
        cases.append(equal & _behind(a, b, ascending))
        equal = equal & a.eqNullSafe(b)
    return reduce(Column.__or__, cases)


def order_of(df: DataFrame, order: Sequence[Key]) -> DataFrame:
    """One row: ``row_count``, ``faults`` (rows that stand behind a larger one) and ``in_order``.

    Rows are taken in the order the frame yields them. Neighbours are compared within each
    partition, which stays as large as it was; then the last row of every partition is
    compared with the first one of the next, one row a partition.
    """
    key = F.struct(*[F.col(c).alias(f"k{n}") for n, (c, _) in enumerate(order)])
    placed = df.select(key.alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    before = F.lag("key").over(Window.partitionBy("part").orderBy("at"))
    inner = placed.withColumn("before", before).groupBy("part").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("before").isNotNull() & _misplaced(F.col("before"), F.col("key"), order)).alias("faults"),
        F.min_by("key", "at").alias("first"),
        F.max_by("key", "at").alias("last"),
    )
    edge = F.lag("last").over(Window.orderBy("part"))
    edges = inner.withColumn("before", edge)
    crossing = F.col("before").isNotNull() & _misplaced(F.col("before"), F.col("first"), order)
    found = edges.agg(F.sum("n").alias("n"), F.sum(F.col("faults") + crossing.cast("int")).alias("faults"))
    return found.select(
        F.coalesce("n", F.lit(0)).alias("row_count"), F.coalesce("faults", F.lit(0)).alias("faults"),
        (F.coalesce("faults", F.lit(0)) == 0).alias("in_order"),
    )
