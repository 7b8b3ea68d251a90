"""Joining points to the intervals that hold them, by bins, for sides of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _number(df: DataFrame, column: str) -> Column:
    """Dates, times and numbers as doubles; the order of values is kept, equal ones stay equal."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif not isinstance(kind, T.NumericType):
        raise TypeError(f"{column} is {kind.simpleString()}: points and bounds are numbers, dates or timestamps")
    return value.cast("double")


def interval_join(
    points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, on: Sequence[str] = ()
) -> DataFrame:
    """Every point with every interval it lies in, bounds included, and equal in ``on``.

    Intervals are sorted into levels by length, each a power of two at least as long, and cut
    into bins of that width: two bins at most, however long an interval is. A point falls in
    one bin of each level that occurs. So the join is an equality of level and bin, hashed or
    broadcast or split by skew as Spark sees fit, and the bounds are compared within it.
    Points and intervals with a NULL or NaN, and intervals that end before they begin, match
    nothing. Bounds may be infinite. Columns must differ in name but for those of ``on``;
    ``_level`` and ``_bin`` are taken.
    """
    shared = {c.lower() for c in points.columns} & {c.lower() for c in intervals.columns}
    if shared - {c.lower() for c in on}:
        raise ValueError(f"columns on both sides: {sorted(shared - {c.lower() for c in on})}")
    first, last = _number(intervals, low), _number(intervals, high)
    # Bins far finer than the bounds' own precision would only be many.
    size = F.greatest(last - first, F.greatest(F.abs(first), F.abs(last)) * 2.0**-50, F.lit(2.0**-1000))
    level = F.ceil(F.log2(F.least(size, F.lit(2.0**1000)))).cast("int")
    width = F.when(size > 2.0**1000, float("inf")).otherwise(F.pow(F.lit(2.0), F.col("_level")))
    held = intervals.where(~F.isnan(first) & ~F.isnan(last) & (first <= last)).withColumn("_level", level)
    low_bin, high_bin = F.floor(F.nanvl(first / width, F.lit(0.0))), F.floor(F.nanvl(last / width, F.lit(0.0)))
    held = held.withColumn("_level", F.when(size > 2.0**1000, 2000).otherwise(F.col("_level")))
    held = held.withColumn("_bin", F.explode(F.sequence(low_bin, high_bin)))
    # The levels that occur, some ten numbers, come from a subquery of the same plan.
    levels = held.agg(F.collect_set("_level")).scalar()
    value = _number(points, at)
    spots = points.where(~F.isnan(value)).withColumn("_level", F.explode(levels))
    scale = F.when(F.col("_level") == 2000, float("inf")).otherwise(F.pow(F.lit(2.0), F.col("_level")))
    spots = spots.withColumn("_bin", F.floor(F.nanvl(value / scale, F.lit(0.0))))
    found = spots.join(held, ["_level", "_bin", *on])
    return found.where((F.col(low) <= F.col(at)) & (F.col(at) <= F.col(high))).drop("_level", "_bin")


# A bin has 2 ** ``BIN_BITS`` values, so no more different points than that.
BIN_BITS = 16


def interval_totals(
    points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, by: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Per ``by``, count and sums over all pairs of an interval and a point that lies in it.

    The same as `interval_join` grouped by columns of the intervals, without making the pairs,
    whose number grows with the product of both sides. What an interval holds is what lies up to
    its end, less what lies before its begin. Equal points are summed first; ends and points of a
    bin are walked together in order, and bins, a row each, are summed up in one task. Points and
    bounds are whole numbers; summed columns are whole numbers or decimals, so that differences
    are exact; running sums are decimals of 38 digits, so only a sum that is asked for can be too
    large for its type. A group without pairs has no row, and a sum over NULLs alone is NULL.
    """
    for df, column in ((points, at), (intervals, low), (intervals, high)):
        if not isinstance(df.schema[column].dataType, T.IntegralType):
            raise TypeError(f"{column} is no whole number")
    for column in sums:
        if not isinstance(points.schema[column].dataType, (T.IntegralType, T.DecimalType)):
            raise TypeError(f"{column} is neither a whole number nor a decimal")
    parts = ["_pairs", *[f"_{kind}_{s}" for s in sums for kind in ("sum", "seen")]]
    spot = F.col(at).cast("bigint").alias("_at")
    kinds = {s: points.schema[s].dataType for s in sums}
    scale = {s: k.scale if isinstance(k, T.DecimalType) else 0 for s, k in kinds.items()}
    whole = {s: k if isinstance(k, T.DecimalType) else T.DecimalType(20, 0) for s, k in kinds.items()}
    answer = {s: T.DecimalType(min(38, k.precision + 10), k.scale) if isinstance(k, T.DecimalType) else T.LongType() for s, k in kinds.items()}

    def total(s: str) -> Column:
        return F.coalesce(F.sum(F.col(s).cast(whole[s])), F.lit(0)).cast(T.DecimalType(38, scale[s]))

    added = [made for s in sums for made in (total(s).alias(f"_sum_{s}"), F.count(s).alias(f"_seen_{s}"))]
    counted = points.where(F.col(at).isNotNull()).groupBy(spot).agg(F.count("*").alias("_pairs"), *added)
    # In one place the begins come first, then the points, then the ends.
    begin = F.struct(F.col(low).cast("bigint").alias("_at"), F.lit(0).alias("_turn"))
    end = F.struct(F.col(high).cast("bigint").alias("_at"), F.lit(2).alias("_turn"))
    ends = intervals.where(F.col(low) <= F.col(high)).select(*by, F.explode(F.array(begin, end)).alias("_end"))
    ends = ends.select(*by, "_end.*", *[F.lit(0).cast(counted.schema[p].dataType).alias(p) for p in parts])
    together = counted.withColumn("_turn", F.lit(1)).unionByName(ends, allowMissingColumns=True)
    together = together.withColumn("_bin", F.shiftright("_at", BIN_BITS))

    upto = Window.partitionBy("_bin").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    walked = together.withColumns({p: F.sum(p).over(upto) for p in parts}).where("_turn <> 1")
    bins = together.groupBy("_bin").agg(*[F.sum(p).alias(p) for p in parts])
    earlier = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = bins.select("_bin", *[F.coalesce(F.sum(p).over(earlier), F.lit(0)).alias(f"_before{p}") for p in parts])
    placed = walked.join(before, "_bin").withColumns({p: F.col(p) + F.col(f"_before{p}") for p in parts})
    held = placed.groupBy(*by).agg(*[F.sum(F.when(F.col("_turn") == 0, -F.col(p)).otherwise(F.col(p))).alias(p) for p in parts])
    shown = [F.when(F.col(f"_seen_{s}") > 0, F.col(f"_sum_{s}").cast(answer[s])).alias(s) for s in sums]
    return held.where("_pairs > 0").select(*by, F.col("_pairs").alias("pairs"), *shown)
