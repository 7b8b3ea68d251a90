"""What is shuffled for lookups is held once: a text or what is made of it, a row or its rank."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.queries import Clinic
from vitalmart.operators import rows as ops
from vitalmart.plans import cleaned


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name, made", [("medication", "start_datetime"), ("procedure", "start_datetime"), ("condition", "onset_date"), ("allergy", "onset_date")])
def test_texts_are_not_joined_beside_what_is_made_of_them(spark, sf_dir, name, made):
    lines = optimized(Clinic(spark, sf_dir)[name]).splitlines()
    first = next(n for n, line in enumerate(lines) if "Join LeftOuter" in line)
    assert any(f"AS {made}#" in line for line in lines[:first])
    assert not any(f"AS {made}#" in line for line in lines[first:])
    assert any("AS _raw_START#" in line for line in lines[first:])


def test_picked_rows_are_held_once(spark):
    df = spark.range(9).selectExpr("id % 3 as k", "id as v", "cast(id as string) as t")
    assert "min_by(" not in optimized(ops.best_row(df, ["k"], [F.col("v")]))


def test_products_are_held_once(spark, sf_dir):
    text = optimized(Clinic(spark, sf_dir)["medication"])
    assert "struct(product_id" in text and "min_by(" not in text


def test_picked_rows_may_be_named_as_their_ranks(spark, rows):
    df = spark.createDataFrame([(1, 2, "b"), (1, None, "z"), (1, None, None), (2, 5, None)], "k int, o0 int, row string")
    best = ops.best_row(df, ["k"], [F.col("o0")])
    assert rows(best) == [(1, None, None), (2, 5, None)] and best.columns == ["k", "o0", "row"]


def test_conversions_after_a_join_see_the_raw_text(spark):
    spec = cleaned.SPECS["medication"]
    columns = sorted({*spec.text.values(), *spec.timestamp.values(), *spec.money.values(), *spec.count.values()})
    starts = ["2020-01-02 03:04:05", "2020-01-02T03:04:05Z", " 2020-01-02 03:04 ", "2020-01-02", "", "never", None]
    raw = [{**dict.fromkeys(columns), "PATIENT": "p", "CODE": "1", "START": s, "_rec_src": "S"} for s in starts]
    raw = spark.createDataFrame(raw, ", ".join(f"{n} string" for n in columns) + ", _rec_src string")
    concepts = spark.createDataFrame([("1", "a", "SCD")], "rxcui string, rxnorm_name string, tty string")
    with_lookup, alone = [cleaned.medication(raw, dt.date(2002, 1, 1), *some) for some in ((concepts,), ())]
    assert with_lookup.columns == alone.columns
    shown = ["medication_id", "start_datetime", "prescribed_date"]
    got, want = [sorted(map(tuple, df.select(*shown).collect()), key=repr) for df in (with_lookup, alone)]
    assert got == want
    by_hand = raw.select(F.sha2(F.concat_ws("|", "PATIENT", "CODE", F.coalesce("START", F.lit(""))), 256), F.col("START"))
    assert {(r[0], bool(r[1] and r[1].strip().startswith("2020") and ":" in r[1])) for r in by_hand.collect()} == {(i, s is not None) for i, s, _ in got}
