"""Picking, numbering and joining rows without putting one whole group into one task.

A single encounter, patient or claim may own a large share of all rows. Each helper here
reduces such a group before it is shuffled, or spreads it over an order-preserving slot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.functions.keys import hashed


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ascending ``order``, ties settled by all columns.

    ``min`` keeps one candidate per key and map task, so a hot key costs no more to shuffle
    than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.min(rank).alias("best")).select(*keys, "best.row.*")


def first_n_as_columns(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    columns: Mapping[str, tuple[str | Column, int]],
) -> DataFrame:
    """The first rows per key, spread into numbered columns.

    ``columns`` maps an output prefix to its value and how many slots it has. The rank
    filter lets Spark cut every group to the slot count before the shuffle, and the pivot
    reuses the window's partitioning.
    """
    most = max(slots for _, slots in columns.values())
    values = {f"_{p}": F.col(v) if isinstance(v, str) else v for p, (v, _) in columns.items()}
    ranked = (
        df.filter(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
        .filter(F.col("_rank") <= most)
        .select(key, "_rank", *[v.alias(n) for n, v in values.items()])
    )
    slots = [
        F.max(F.when(F.col("_rank") == i, F.col(f"_{prefix}"))).alias(f"{prefix}{i}")
        for prefix, (_, count) in columns.items()
        for i in range(1, count + 1)
    ]
    return ranked.groupBy(key).agg(*slots)


# A key, a day of a key, or a row with its copies, is large beyond this many rows. At most
# ``MOST_LARGE`` large ones are told apart, however many rows there are.
LARGE_ROWS, MOST_LARGE = 100_000, 10_000
PIECE = 10_000


def numbered(
    df: DataFrame,
    key: str,
    day: str,
    tie: Sequence[str],
    name: str = "line_num",
    large_rows: int = LARGE_ROWS,
) -> DataFrame:
    """Number all rows of each key by day, then by a digest of the ``tie`` columns.

    Keys of up to ``large_rows`` rows are numbered by one window. Larger keys are found by a
    count over keys alone, may be broadcast, and are numbered day by day and slice by slice;
    without any, adaptive execution drops that part before it runs. Beyond the ``MOST_LARGE``
    largest keys the window numbers the rest as well. Both ways give the same numbers. Rows
    without a key are not numbered and left out.
    """
    columns = df.columns
    keyed = df.filter(F.col(key).isNotNull())
    sizes = keyed.groupBy(key).agg(F.count("*").alias("_size")).filter(F.col("_size") > large_rows)
    large = F.broadcast(sizes.orderBy(F.desc("_size"), key).limit(MOST_LARGE).select(key))
    marks = {"_digest": hashed(*tie), "_day": F.coalesce(F.col(day).cast("string"), F.lit(""))}
    in_key = Window.partitionBy(key).orderBy("_day", "_digest", *columns)
    plain = keyed.join(large, key, "left_anti").withColumns(marks).select(
        *columns, F.row_number().over(in_key).cast("bigint").alias(name)
    )
    # Whole rows of large keys only are counted, so that other rows are shuffled once.
    folded = keyed.join(large, key, "left_semi").groupBy(*columns).agg(F.count("*").alias("_copies"))
    hot = folded.withColumns(marks)
    return plain.unionByName(_numbered_in_slices(hot, columns, key, name, large_rows))


def _numbered_in_slices(
    folded: DataFrame, columns: Sequence[str], key: str, name: str, large_rows: int
) -> DataFrame:
    """Numbers for rows of large keys, given once with ``_copies``, ``_day`` and ``_digest``.

    Rows of one (key, day) are sorted together, and the sizes of a key's days give each day
    its starting number. Large days are cut into slots by digest prefix, which follow the
    wanted order, and the sizes of a day's slots give each slot its start; so a hot key spreads
    over its days, and a hot day over 65,536 slots. Large days, and rows with very many copies,
    are few by their definition and so may be broadcast. The numbers of a row with very many
    copies are made in pieces that are dealt out. Results do not depend on row order, so tasks
    may run again.
    """
    on_day, slot = [key, "_day"], [key, "_day", "_slice"]
    days = folded.groupBy(*on_day).agg(F.sum("_copies").alias("_size"))
    total = days.agg(F.sum("_size")).scalar()
    large = F.greatest(F.lit(large_rows), F.floor(total / MOST_LARGE))
    large_days = days.filter(F.col("_size") > large).select(*on_day, F.lit(True).alias("_large"))
    prefix = F.when(F.col("_large"), F.substring("_digest", 1, 4)).otherwise("")
    sliced = folded.join(F.broadcast(large_days), on_day, "left").withColumn("_slice", prefix)

    before = F.sum("_size").over(Window.partitionBy(key).orderBy("_day")) - F.col("_size")
    day_starts = days.select(*on_day, before.alias("_before"))
    slices = sliced.filter("_large").groupBy(*slot).agg(F.sum("_copies").alias("_size"))
    in_day = F.sum("_size").over(Window.partitionBy(*on_day).orderBy("_slice")) - F.col("_size")
    starts = day_starts.join(slices.select(*slot, in_day.alias("_in_day")), on_day, "left").select(
        *on_day,
        F.coalesce("_slice", F.lit("")).alias("_slice"),
        (F.col("_before") + F.coalesce("_in_day", F.lit(0))).alias("_before"),
    )
    within = (
        Window.partitionBy(*slot)
        .orderBy("_digest", *columns)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = sliced.withColumn("_upto", F.sum("_copies").over(within)).join(starts, slot)
    few = placed.filter(F.col("_copies") <= large).select(
        *columns, "_copies", (F.col("_before") + F.col("_upto") - F.col("_copies")).alias("_from")
    )

    # Rows of very many copies: what comes before each is summed over its day.
    many = folded.filter(F.col("_copies") > large)
    place = F.struct("_digest", *columns)
    marks = many.select(*on_day, place.alias("_place"), F.col("_copies").alias("_times"))
    smaller = F.sum(F.when(place < F.col("_place"), F.col("_copies")).otherwise(0))
    many_from = (
        folded.join(F.broadcast(marks), on_day)
        .groupBy(*on_day, "_place", "_times")
        .agg(smaller.alias("_in_day"))
        .join(day_starts, on_day)
        .select("_place.*", F.col("_times").alias("_copies"), (F.col("_before") + F.col("_in_day")).alias("_from"))
        .select(*columns, "_copies", "_from")
    )

    def pieces(rows: DataFrame) -> DataFrame:
        first = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(PIECE)))
        cut = rows.select(*columns, (F.col("_from") + F.col("_copies")).alias("_last"), "_from", first.alias("_at"))
        low = F.col("_from") + F.col("_at")
        return cut.select(*columns, (low + 1).alias("_low"), F.least(low + PIECE, "_last").alias("_high"))

    dealt = pieces(many_from)
    dealt = dealt.repartition(key, "_low")
    together = pieces(few).unionByName(dealt)
    return together.select(*columns, F.explode(F.sequence("_low", "_high")).alias(name))


def left_join_hot_right(
    left: DataFrame, right: DataFrame, key: str, keys: DataFrame | None = None
) -> DataFrame:
    """Left join whose right side may hold very many rows of one key.

    A left outer join can only split its left side, so the matches come from an inner
    join, where adaptive execution may split either side, and the rest from an anti join.
    Rows without a key match nothing; they are taken apart, so both joins read the same
    rows of the left side and share its shuffle. ``keys`` may name a frame with all keys of the
    right side that are in the left one, and of the left one's keys no others; it spares
    making the right side twice.
    """
    keyed, found = left.filter(F.col(key).isNotNull()), right.filter(F.col(key).isNotNull())
    matched = keyed.join(found, key)
    known = found if keys is None else keys.filter(F.col(key).isNotNull())
    rest = keyed.join(known.select(key).distinct(), key, "left_anti")
    rest = rest.unionByName(left.filter(F.col(key).isNull()))
    return matched.unionByName(rest, allowMissingColumns=True)


def running_until(
    df: DataFrame, amount: str, day: str, key: str, threshold: float
) -> DataFrame:
    """Running total in (day, key) order at the row that first reaches the threshold.

    ``key`` is a hex digest, so its leading characters cut a day into even, ordered
    slices. Each slice reports its sum and its highest running total, days combine their
    slices; the crossing day, its crossing slice and, walking that slice's rows again, the
    crossing row are found in turn: the input is read twice. Amounts may be negative. Without a crossing the grand total is returned.
    The window over days sees one row per distinct day.
    """
    limit = F.lit(threshold).cast("decimal(18,2)")
    rows = df.filter(F.col(amount).isNotNull()).select(
        F.coalesce(F.col(day).cast("string"), F.lit("")).alias("day"),
        F.substring(key, 1, 4).alias("slice"),
        F.col(key).alias("key"),
        F.col(amount).cast("decimal(18,2)").alias("amount"),
    )

    def upto(order: Sequence[str], *within: str) -> Column:
        frame = Window.partitionBy(*within) if within else Window
        ordered = frame.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return F.sum("amount").over(ordered)

    walked = rows.withColumn("run", upto(["key", "amount"], "day", "slice"))
    slices = (
        walked.groupBy("day", "slice")
        .agg(F.sum("amount").alias("amount"), F.max("run").alias("peak"))
        .withColumn("before", upto(["slice"], "day") - F.col("amount"))
    )
    # One row a day goes through the window over days, without its slices: what it adds, and
    # the highest total reached in it.
    days = slices.groupBy("day").agg(
        F.sum("amount").alias("amount"), F.max(F.col("before") + F.col("peak")).alias("peak")
    )
    bases = days.select("day", "peak", (upto(["day"]) - F.col("amount")).alias("base"))

    def first_to_cross(places: DataFrame, place: str, base: str) -> DataFrame:
        """One row: the first place whose highest total reaches the limit, else the last one."""
        crossed = F.when(F.col(base) + F.col("peak") >= limit, F.col(place))
        found = F.struct(place, base)
        return places.agg(
            F.coalesce(F.min_by(found, crossed), F.max_by(found, place)).alias("hit")
        ).select("hit.*")

    day_hit = first_to_cross(bases, "day", "base")
    within = slices.join(F.broadcast(day_hit), "day").select(
        F.struct("day", "slice").alias("place"),
        "peak",
        (F.col("base") + F.col("before")).alias("before"),
    )
    hit = first_to_cross(within, "place", "before").select("place.*", "before")
    walk = Window.partitionBy("day", "slice").orderBy("key", "amount")
    run = F.sum("amount").over(walk.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    here = rows.join(F.broadcast(hit), ["day", "slice"]).withColumn("run", run)
    row = F.struct("key", "amount")
    crossing = F.min_by("run", F.when(F.col("run") >= limit, row))
    # Without a crossing the last row of the last slice has the grand total.
    answer = F.coalesce(crossing, F.max_by("run", row), F.lit(0)).cast("decimal(18,2)")
    return here.agg(answer.alias("total_until_threshold")).withColumn("threshold", limit)
