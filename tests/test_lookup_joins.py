"""Cleaned rows are shuffled once for their lookups, before digests and texts are made of them."""

import datetime as dt

import pytest

from checks.bridge import Raw
from checks.queries import QUERIES, Clinic
from vitalmart.plans import cleaned


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["medication", "procedure", "condition", "claimresponse", "allergy"])
def test_digests_are_made_after_the_join(spark, sf_dir, name):
    lines = optimized(Clinic(spark, sf_dir)[name]).splitlines()
    first = next(n for n, line in enumerate(lines) if "Join LeftOuter" in line)
    assert not any("sha2(" in line or "SNOMED" in line for line in lines[first:])


def test_prescriptions_are_joined_by_drug_only(spark, sf_dir):
    plan = optimized(QUERIES["cleaned_medication"](spark, sf_dir)).splitlines()
    joins = [line for line in plan if "Join LeftOuter" in line]
    by_drug = [n for n, line in enumerate(joins) if "(medication_code" in line]
    by_product = [n for n, line in enumerate(joins) if "_product_key" in line]
    assert len(by_drug) == 2 and len(by_product) == 1
    spread = [line.index("Join LeftOuter") for line in joins]
    # Products are joined below the packages, beside the prescriptions and not over them.
    assert by_drug[0] == 0 and spread[by_product[0]] > spread[0]


def test_drug_lookups_nobody_reads_are_not_joined(spark, sf_dir):
    plan = optimized(QUERIES["agg_medication_utilization"](spark, sf_dir))
    assert "product_key" not in plan and "ndc_code" not in plan


def test_drugs_known_to_some_lookups_only(spark, rows):
    as_of = dt.date(2002, 1, 1)
    names = cleaned.SPECS["medication"]
    columns = sorted({*names.text.values(), *names.timestamp.values(), *names.money.values(), *names.count.values()})
    raw = [{**dict.fromkeys(columns), "PATIENT": "p", "CODE": code} for code in ("1", "2", "3", "4")]
    schema = ", ".join(f"{n} string" for n in columns) + ", _rec_src string"
    facts = spark.createDataFrame([{**r, "_rec_src": "S"} for r in raw], schema)
    concepts = spark.createDataFrame([("1", "a", "SCD"), ("1", "b", "SBD"), ("2", "c", "IN"), (None, "d", "IN")], "rxcui string, rxnorm_name string, tty string")
    crosswalk = spark.createDataFrame([("1", "00001000102"), ("1", "00001000101"), ("3", "00002000201"), (None, "00009000901")], "rxcui string, ndc_11_digit string")
    fields = "proprietary_name nonproprietary_name dosage_form_name route_name labeler_name".split()
    products = spark.createDataFrame([("x", "0001-0001", *fields)], "product_id string, product_ndc string, " + ", ".join(f"{f} string" for f in fields))
    shown = ("medication_code", "rxnorm_name", "ndc_code", "manufacturer")
    full = cleaned.medication(facts, as_of, concepts, crosswalk, products)
    assert [r[:3] for r in rows(full, *shown)] == sorted([("1", "a", "00001000101"), ("1", "b", "00001000101"), ("2", "c", None), ("3", None, "00002000201"), ("4", None, None)], key=repr)
    orders = [cleaned.medication(facts, as_of, *some).columns for some in ((), (concepts,), (None, crosswalk), (None, crosswalk, products), (concepts, None, products))]
    assert all(o == full.columns for o in orders)
    assert rows(cleaned.medication(facts, as_of, None, crosswalk), *shown)[0] == ("1", None, "00001000101", None)
