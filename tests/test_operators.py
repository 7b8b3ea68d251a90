"""Chunked sets, interval joins, order proofs, fitted scores, catalog and run log."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalmart.operators.intervals import interval_join
from vitalmart.operators.order import order_of
from vitalmart.operators.sets import chunked_sets, whole_sets
from vitalmart.plans.scoring import fit_linear
from vitalmart.session import scratch_path
from vitalmart.sources import tables


@pytest.mark.parametrize("size", [1, 3, 50, 10_000])
def test_chunks_hold_every_value_once(spark, size):
    rng = random.Random(size)
    data = [("hot", None, rng.randint(1, 700)) for _ in range(3000)] + [("warm", "b", n % 7) for n in range(60)]
    data += [("one", None, None), ("one", None, 5), (None, "x", 1), (None, "x", 2), ("none", "y", None)]
    frame = spark.createDataFrame(data, "k string, j string, v int").repartition(5)
    want = defaultdict(set)
    for k, j, v in data:
        if v is not None:
            want[k, j].add(v)
    rows = chunked_sets(frame, ["k", "j"], "v", size).collect()
    found = defaultdict(list)
    for r in rows:
        assert r["values"] == sorted(r["values"]) and 0 < len(r["values"]) <= size
        found[r["k"], r["j"]].append(r)
    assert set(found) == set(want)
    for key, chunks in found.items():
        assert sorted(v for r in chunks for v in r["values"]) == sorted(want[key])
        n = -(-len(want[key]) // size)
        assert sorted(r["chunk"] for r in chunks) == list(range(n)) and {r["chunks"] for r in chunks} == {n}
        assert all(len(r["values"]) == size for r in chunks if r["chunk"] < n - 1)
    whole = {(r["k"], r["j"]): r["values"] for r in whole_sets(chunked_sets(frame, ["k", "j"], "v", size), ["k", "j"]).collect()}
    assert whole == {k: sorted(v) for k, v in want.items()}
    assert chunked_sets(frame.limit(0), ["k", "j"], "v", size).collect() == []


def test_a_hot_key_is_spread(spark):
    frame = spark.range(200_000).selectExpr("'hot' as k", "id as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    chunks = chunked_sets(frame, ["k"], "v", 1000)
    got = chunks.groupBy(F.spark_partition_id()).agg(F.sum(F.size("values")).alias("n")).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 8 and sum(r["n"] for r in got) == 200_000
    with pytest.raises(ValueError):
        chunked_sets(frame.withColumnRenamed("k", "chunk"), ["chunk"], "v")


INF = float("inf")


@pytest.mark.parametrize("seed", [1, 2])
def test_interval_join_by_brute_force(spark, seed):
    rng = random.Random(seed)
    number = lambda: rng.choice([rng.uniform(-50, 50), float(rng.randint(-5, 5)), rng.uniform(-1e-3, 1e-3), 1e6, 0.0])
    points = [(n, rng.choice("ab"), number()) for n in range(300)] + [(900, "a", None), (901, None, 1.0), (902, "a", float("nan"))]
    spans = []
    for n in range(120):
        low = number()
        spans.append((n, rng.choice("ab"), low, low + rng.choice([0.0, 1e-6, 0.5, 3.0, 100.0, 1e9, -1.0])))
    spans += [(900, "a", None, 3.0), (901, "a", 0.0, None), (902, "b", -INF, INF), (903, "a", 1.0, INF), (904, None, 0.0, 1.0)]
    left = spark.createDataFrame(points, "p int, k string, x double")
    right = spark.createDataFrame(spans, "i int, k string, lo double, hi double")
    inside = lambda x, lo, hi: None not in (x, lo, hi) and lo <= x <= hi
    want = sorted((p, i) for p, k, x in points for i, j, lo, hi in spans if k == j and k and inside(x, lo, hi))
    found = interval_join(left.repartition(3), right, "x", "lo", "hi", on=["k"])
    assert sorted((r["p"], r["i"]) for r in found.collect()) == want
    alone = interval_join(left.drop("k"), right.drop("k"), "x", "lo", "hi")
    assert sorted((r["p"], r["i"]) for r in alone.collect()) == sorted((p, i) for p, _, x in points for i, _, lo, hi in spans if inside(x, lo, hi))
    plan = found._jdf.queryExecution().optimizedPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_of_dates_and_large_numbers(spark):
    day = dt.date(2020, 1, 1)
    stays = spark.createDataFrame([(n, day + dt.timedelta(n), day + dt.timedelta(n + n % 40)) for n in range(90)], "i int, a date, b date")
    visits = spark.createDataFrame([(n, day + dt.timedelta(n * 2)) for n in range(70)], "p int, d date")
    want = sorted((p, i) for p in range(70) for i in range(90) if i <= 2 * p <= i + i % 40)
    assert sorted((r["p"], r["i"]) for r in interval_join(visits, stays, "d", "a", "b").collect()) == want
    big = spark.createDataFrame([(2**62, 2**62 + 2), (2**62 + 3, 2**62 + 3)], "a bigint, b bigint")
    spots = spark.range(2**62, 2**62 + 5).withColumnRenamed("id", "x")
    got = interval_join(spots, big, "x", "a", "b").groupBy("a").count().orderBy("a").collect()
    assert [r["count"] for r in got] == [3, 1]
    assert interval_join(spots.limit(0), big, "x", "a", "b").collect() == [] and interval_join(spots, big.limit(0), "x", "a", "b").collect() == []
    with pytest.raises(ValueError):
        interval_join(spots, big.withColumnRenamed("b", "X"), "x", "a", "X")
    with pytest.raises(TypeError):
        interval_join(spots.withColumn("x", F.col("x").cast("string")), big, "x", "a", "b")


def test_order_is_proven_over_partitions(spark):
    frame = spark.range(0, 5000, 1, 9).select((F.col("id") % 50).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"))
    order = [("a", True), ("b", False)]
    kept = frame.orderBy(F.col("a"), F.col("b").desc())
    assert tuple(order_of(kept, order).first()) == (5000, 0, True)
    assert not order_of(kept.orderBy("a", "b"), order).first()["in_order"]
    shuffled = order_of(kept.repartition(6), order).first()
    assert shuffled["row_count"] == 5000 and shuffled["faults"] > 100 and not shuffled["in_order"]
    # each partition in order, but not the partitions among themselves
    edges = spark.range(0, 100, 1, 4).sortWithinPartitions(F.col("id").desc())
    assert tuple(order_of(edges, [("id", False)]).first()) == (100, 3, False)
    nulls = spark.createDataFrame([(1,), (None,), (2,)], "x int").coalesce(1)
    assert tuple(order_of(nulls, [("x", True)]).first()) == (3, 1, False)
    assert tuple(order_of(nulls.limit(0), [("x", True)]).first()) == (0, 0, True)


def test_linear_fit_is_least_squares(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1, 1e4, 1e-3] + [1e6, 0, 5]
    y = 3 + x @ [2.0, -0.5, 700.0] + rng.normal(size=400)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(6)
    features = {n: F.col(n) for n in "abc"}
    model = fit_linear(frame, features, F.col("y"))
    centred = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    assert model.row_count == 400 and np.allclose(list(model.weights.values()), centred, rtol=1e-6)
    scored = frame.select("y", model.score(features).alias("s"))
    assert scored.where("s is null").count() == 1
    got = scored.dropna().toPandas()
    assert abs((got.y - got.s).mean()) < 1e-6 and 1 - ((got.y - got.s) ** 2).sum() / ((got.y - got.y.mean()) ** 2).sum() == pytest.approx(model.r2)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    assert model.as_rows(spark).count() == 4


def test_linear_fit_of_odd_rows(spark):
    frame = spark.createDataFrame([(1.0, 2.0, 7.0), (1.0, 4.0, 9.0), (1.0, 6.0, 11.0)], "one double, x double, y double")
    model = fit_linear(frame, {"one": F.col("one"), "x": F.col("x"), "twice": F.col("x") * 2}, F.col("y"))
    assert model.r2 == pytest.approx(1) and model.weights["one"] == pytest.approx(0)
    assert model.weights["x"] + 2 * model.weights["twice"] == pytest.approx(1)
    none = fit_linear(frame.limit(0), {"x": F.col("x")}, F.col("y"))
    assert (none.row_count, none.weights, none.r2) == (0, {"x": 0.0}, None)
    with pytest.raises(ValueError):
        fit_linear(frame, {}, F.col("y"))


def test_catalog_beside_what_is_expected(spark):
    spark.sql("CREATE SCHEMA listed")
    tables.write_table(spark.range(3).selectExpr("id", "cast(id as string) as name", "1 as more"), "listed.here")
    spark.sql("CREATE VIEW listed.shown AS SELECT id FROM listed.here")
    spark.range(1).createOrReplaceTempView("passing_by")
    found = tables.catalog_rows(spark, "listed")
    assert {(r["table_name"], r["table_type"], r["column_name"], r["position"]) for r in found.collect()} == {
        ("here", "MANAGED", "id", 1), ("here", "MANAGED", "name", 2), ("here", "MANAGED", "more", 3), ("shown", "VIEW", "id", 1),
    }
    expected = [("HERE", "id", "bigint"), ("here", "name", "int"), ("here", "gone", None), ("absent", "x", "int")]
    frame = spark.createDataFrame(expected, "table_name string, column_name string, data_type string")
    got = {(r["table_name"], r["column_name"]): r["status"] for r in tables.catalog_differences(found, frame).collect()}
    assert got == {
        ("here", "id"): "OK", ("here", "name"): "OTHER TYPE", ("here", "gone"): "MISSING",
        ("here", "more"): "EXTRA", ("absent", "x"): "TABLE MISSING",
    }
    assert tables.catalog_rows(spark, "default").columns == found.columns


def test_run_log_is_kept_entry_by_entry(spark):
    path = scratch_path(spark, "log")
    spark.sql("CREATE SCHEMA logged")
    log = tables.RunLog(spark, path)
    log.attempt("silver", "a", lambda: tables.write_table(spark.range(4), "logged.a", "silver"))
    assert log.read().count() == 1  # already there while the run goes on

    def broken():
        raise ValueError("no file")

    log.attempt("silver", "b", broken)
    other = tables.RunLog(spark, path)
    other.attempt("gold", "c", lambda: tables.write_table(spark.range(2), "logged.c", "gold"))
    assert log.read(every_run=True).count() == 3 and other.read().count() == 1
    row = tables.stage_summary(log.read()).first()
    assert (row["tables_processed"], row["tables_successful"], row["total_rows"], row["errors"], row["success"]) == (2, 1, 4, ["no file"], False)
    assert row["elapsed_seconds"] > 0
