"""Totals of the points in intervals, beside the join that makes every pair."""

import random

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from vitalmart.operators import intervals


def test_totals_are_those_of_the_join(spark, rows):
    pick = random.Random(5)
    points = [(pick.randrange(-300_000, 300_000), pick.choice([None, 1, 7, -2])) for _ in range(300)]
    points += [(70_000, 5)] * 4 + [(None, 3), (2**63 - 1, 1), (-(2**63), 1)]
    spans = [(pick.randrange(9), low, low + pick.choice([0, 10, 70_000, 400_000, -1])) for low in (pick.randrange(-300_000, 300_000) for _ in range(60))]
    spans += [(10, 70_000, 70_000), (10, 70_000, 70_000), (11, -(2**63), 2**63 - 1), (12, 1, None), (13, 900_000, 900_001), (None, 0, 70_000)]
    at = spark.createDataFrame(points, "at bigint, amount bigint").repartition(3)
    held = spark.createDataFrame(spans, "g int, low bigint, high bigint").repartition(3)
    found = intervals.interval_totals(at, held, "at", "low", "high", ["g"], ["amount", "at"])
    pairs = [(g, a, v) for g, low, high in spans for a, v in points if None not in (low, high, a) and low <= a <= high]
    expected = []
    for g in {p[0] for p in pairs}:
        amounts = [v for k, _, v in pairs if k == g and v is not None]
        expected.append((g, sum(k == g for k, _, _ in pairs), sum(amounts) if amounts else None, sum(a for k, a, _ in pairs if k == g)))
    assert rows(found) == sorted(expected, key=repr)
    with pytest.raises(TypeError):
        intervals.interval_totals(at.select(F.col("at").cast("double"), "amount"), held, "at", "low", "high", ["g"], [])


def test_the_query_makes_no_pairs(spark, sf_dir):
    plan = QUERIES["jn7_interval_join"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if " Join " in line]
    assert len(joins) == 1 and "_bin" in joins[0] and "_level" not in plan
