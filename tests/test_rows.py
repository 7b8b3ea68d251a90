"""Row operators against brute force, with groups that hold most of the rows."""

import hashlib
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vitalmart.operators import rows as ops


def test_first_n_drops_the_overflow(spark):
    df = spark.createDataFrame([("e", i) for i in range(12)] + [("f", 3), (None, 1)], "k string, v int")
    out = ops.first_n_as_columns(df, "k", [F.col("v")], {"d": ("v", 10), "p": (F.col("v") * 2, 2)})
    got = {r["k"]: r for r in out.collect()}
    assert set(got) == {"e", "f"}
    assert [got["e"][f"d{i}"] for i in range(1, 11)] == list(range(10))
    assert (got["f"]["d1"], got["f"]["d2"], got["f"]["p1"]) == (3, None, 6)


def test_first_n_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = ops.first_n_as_columns(df, "k", [F.col("id")], {"d": ("id", 5)})
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_best_row(spark, rows):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, None, "c")], "k int, p int, v string")
    assert rows(ops.best_row(df, ["k"], [F.col("p")]), "k", "v") == [(1, "a"), (2, "c")]


def test_numbered_with_hot_key_and_copies(spark):
    random.seed(7)
    data = [("hot", f"2020-01-{random.randint(1, 9):02d}", random.randint(1, 40)) for _ in range(600)]
    data += [("hot", "2020-01-05", 7)] * 300 + [("cold", None, 1), ("cold", "2020-01-01", 2)]
    df = spark.createDataFrame(data, "k string, day string, v int").withColumn("day", F.to_date("day"))
    got = ops.numbered(df, "k", "day", ["v"]).collect()
    assert Counter((r["k"], str(r["day"]), r["v"]) for r in got) == Counter(
        (k, str(d) if d else "None", v) for k, d, v in data
    )
    groups = defaultdict(list)
    for r in got:
        digest = hashlib.sha256(str(r["v"]).encode()).hexdigest()
        groups[r["k"]].append((r["line_num"], str(r["day"]) if r["day"] else "", digest))
    for members in groups.values():
        members.sort()
        assert [n for n, *_ in members] == list(range(1, len(members) + 1))
        assert [m[1:] for m in members] == sorted(m[1:] for m in members)


def test_left_join_keeps_unmatched_and_null_keys(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 99)], "k int, r int")
    got = rows(ops.left_join_hot_right(left, right, "k"), "k", "l", "r")
    assert got == rows(left.join(right, "k", "left"), "k", "l", "r")
    assert len(got) == 52


def claims(spark, amounts):
    rows_ = [
        (hashlib.sha256(str(i).encode()).hexdigest(), day, Decimal(amount) if amount is not None else None)
        for i, (day, amount) in enumerate(amounts)
    ]
    return spark.createDataFrame(rows_, "key string, day string, amount decimal(10,2)").withColumn(
        "day", F.to_date("day")
    ), rows_


def walk(rows_, threshold):
    run = Decimal(0)
    for _, key, amount in sorted((d or "", k, a) for k, d, a in rows_ if a is not None):
        run += amount
        if run >= threshold:
            return run
    return run


@pytest.mark.parametrize("threshold", [1, 100, 555, 2000, 10**6])
def test_running_until_matches_a_walk(spark, threshold):
    random.seed(threshold)
    amounts = [
        (random.choice(["2020-01-01", "2020-01-02", "2020-01-03", None]), random.randint(-30, 60))
        for _ in range(200)
    ] + [("2020-01-02", None)]
    df, rows_ = claims(spark, amounts)
    got = ops.running_until(df, "amount", "day", "key", threshold).first()
    assert got["total_until_threshold"] == walk(rows_, threshold)


def test_running_until_crossing_row_counts(spark):
    df, _ = claims(spark, [("2020-01-01", 60), ("2020-01-02", 50), ("2020-01-03", 40)])
    total = lambda t: ops.running_until(df, "amount", "day", "key", t).first()[0]
    assert (total(100), total(1000)) == (Decimal("110.00"), Decimal("150.00"))
    empty = ops.running_until(df.filter("false"), "amount", "day", "key", 5)
    assert empty.first()[0] == Decimal("0.00")


def by_brute_force(data):
    groups = defaultdict(list)
    for k, d, v in data:
        groups[k].append((str(d) if d else "", hashlib.sha256(str(v).encode()).hexdigest(), k, d, v))
    return sorted(
        ((k, d or "", v, n) for members in groups.values() for n, (_, _, k, d, v) in enumerate(sorted(members, key=lambda m: m[:2]), 1)),
        key=repr,
    )


@pytest.mark.parametrize("large_rows", [3, 40, 100_000])
def test_numbered_is_one_order_whatever_is_large(spark, large_rows):
    rng = random.Random(large_rows)
    data = [("hot", f"2020-01-{rng.randint(1, 3):02d}", rng.randint(1, 60)) for _ in range(400)]
    data += [("hot", "2020-01-02", 7)] * 170 + [("hot", "2020-01-02", 9)] * 90 + [("warm", "2020-01-02", 7)] * 50 + [("cold", None, 1), (None, None, 1)]
    df = spark.createDataFrame(data, "k string, day string, v int").withColumn("day", F.to_date("day"))
    want = by_brute_force([r for r in data if r[0]])
    for parts in (1, 7):
        got = ops.numbered(df.repartition(parts), "k", "day", ["v"], large_rows=large_rows).collect()
        assert sorted(((r["k"], str(r["day"]) if r["day"] else "", r["v"], r["line_num"]) for r in got), key=repr) == want


def test_plans_hold_no_row_for_all(spark):
    df = spark.range(100).selectExpr("'k' as key", "cast(id % 5 as string) as day", "cast(id as decimal(10,2)) as amount")
    plan = ops.running_until(df, "amount", "day", "key", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "inline" not in plan
    plan = ops.numbered(df, "key", "day", ["amount"])._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically" not in plan


def test_small_groups_are_numbered_in_one_window(spark):
    df = spark.range(100).selectExpr("cast(id % 9 as string) as k", "cast(id % 5 as string) as day", "id as v").repartition(3)
    out = ops.numbered(df, "k", "day", ["v"])
    assert out.count() == 100
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Window [") == 1 and "_slice" not in final


def test_left_join_makes_its_hot_side_once(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, l string")
    made = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 99), (3, 4)], "k int, r int")
    right = made.groupBy("k", "r").agg(F.count("*").alias("made_once"))
    got = ops.left_join_hot_right(left, right, "k", keys=made)
    assert rows(got) == rows(left.join(right, "k", "left"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("count(1) AS made_once") == 1
