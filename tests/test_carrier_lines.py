"""Carrier lines are shuffled by encounter once, and by code only where they are of carrier claims."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from vitalmart.operators import rows as ops
from vitalmart.plans import cleaned, cms


def plan_of(df, kind):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_lines_are_numbered_before_codes_are_looked_up(spark, sf_dir):
    lines = plan_of(QUERIES["fact_cms_carrier_claims"](spark, sf_dir), "optimizedPlan").splitlines()
    lookups = [n for n, line in enumerate(lines) if "Join LeftOuter" in line and "_code#" in line]
    windows = [n for n, line in enumerate(lines) if "Window [row_number()" in line]
    assert len(lookups) == 1 and lookups[0] < windows[0]


def test_readers_of_lines_share_one_shuffle(spark, sf_dir):
    text = plan_of(QUERIES["fact_cms_carrier_claims"](spark, sf_dir), "executedPlan")
    wide = [line for line in text.splitlines() if "FileScan" in line and "l_orderkey" in line and "l_shipdate" in line]
    shapes = {re.sub(r"#\d+L?", "", line[line.index("FileScan") :]) for line in wide}
    assert len(wide) > 1 and len(shapes) == 1


def test_whole_rows_of_large_keys_only_are_counted(spark):
    df = spark.range(100).selectExpr("cast(id % 9 as string) as k", "cast(id % 5 as string) as day", "id as v")
    lines = plan_of(ops.numbered(df, "k", "day", ["v"]), "optimizedPlan").splitlines()
    counted = [n for n, line in enumerate(lines) if re.search(r"Aggregate \[k#\d+, day#\d+, v#", line)]
    assert counted
    for n in counted:
        below = next(line for line in lines[n + 1 :] if "Project" not in line)
        assert "Join LeftSemi" in below


@pytest.fixture
def clinic(spark):
    def build(codes):
        encounter = spark.createDataFrame(
            [("e1", "p", "wellness"), ("e2", "p", "outpatient"), ("e3", "p", "inpatient"), ("e4", "q", "wellness")],
            "encounter_id string, patient_id string, encounter_class string",
        ).selectExpr("*", "'d' as provider_id", "timestamp'2020-01-01 10:00:00' as start_datetime",
                     "timestamp'2020-01-02 10:00:00' as end_datetime", "'S' as source_system")
        raw = [
            ("p", "e1", "A", "2020-01-01 08:00:00", "1"), ("p", "e1", "B", "2020-01-01 09:00:00", "2"),
            ("p", "e1", "C", "2020-01-02 09:00:00", "3"), ("p", "e2", "B", "2020-01-01 09:00:00", "4"),
            ("p", "e3", "B", "2020-01-01 09:00:00", "5"), ("p", None, "A", "2020-01-01 09:00:00", "6"),
            ("p", "e1", "A", "2020-01-01 08:00:00", "1"),
        ]
        raw = spark.createDataFrame(raw, "PATIENT string, ENCOUNTER string, CODE string, START string, BASE_COST string")
        raw = raw.selectExpr("*", "null as STOP", "concat('Did ', CODE) as DESCRIPTION", "null as REASONCODE",
                             "null as REASONDESCRIPTION", "'S' as _rec_src").withColumns(
            {n: F.col(n).cast("string") for n in ("STOP", "REASONCODE", "REASONDESCRIPTION")})
        listed = spark.createDataFrame(
            codes, "hcpcs_code string, short_description string, code_type string, betos_code string, is_active boolean"
        )
        return encounter, raw, listed

    return build


ONCE = [("A", "a", "T", "x", True), ("A", "old", "T", "x", False), ("B", "b", "T", "y", True), (None, "n", "T", "z", True)]
TWICE = [*ONCE, ("B", "bb", "T", "yy", True), ("A", "aa", "T", "xx", True)]


@pytest.mark.parametrize("codes, once", [(ONCE, True), (TWICE, False), ([], True)])
def test_codes_met_late_give_the_same_claims(rows, clinic, codes, once):
    encounter, raw, listed = clinic(codes)
    as_of = dt.date(2020, 1, 1)
    assert cleaned.lists_codes_once(listed) is once
    met_first = cms.fact_cms_carrier_claims(encounter, cleaned.procedure(raw, as_of, listed))
    met_late = cms.fact_cms_carrier_claims(encounter, cleaned.procedure(raw, as_of), listed)
    assert met_late.schema == met_first.schema
    assert rows(met_late) == rows(met_first)
    shown = rows(met_late, "clm_id", "clm_line_num", "hcpcs_description", "line_nch_pmt_amt")
    assert ("e4", 1, None, Decimal("0.00")) in shown and len(shown) == (10 if codes == TWICE else 6)
    for claim, count in (("e1", 7 if codes == TWICE else 4), ("e2", 2 if codes == TWICE else 1)):
        assert sorted(n for c, n, *_ in shown if c == claim) == list(range(1, count + 1))
