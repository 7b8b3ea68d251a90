"""Codes made from part keys stay distinct however many parts there are."""

import pytest
from pyspark.sql import functions as F

from checks import bridge
from vitalmart.operators import rows as ops
from vitalmart.plans import cleaned


@pytest.mark.parametrize("code", ["hcpcs", "icd_raw", "ndc"])
def test_codes_are_distinct_up_to_ten_million(spark, code):
    keys = spark.range(0, 60_000).union(spark.range(60_001, 10_000_000, 11))
    made = keys.selectExpr("id", f"{getattr(bridge, code)('id')} as code")
    width = {"hcpcs": 5, "icd_raw": 7, "ndc": 13}[code]
    got = made.agg(F.count("*"), F.count_distinct("code"), F.max(F.length("code"))).first()
    assert got[0] == got[1] and got[2] <= width


@pytest.mark.parametrize(("code", "key"), [("hcpcs", 10**8), ("icd_raw", 3 * 10**9), ("ndc", 10**8)])
def test_keys_that_do_not_fit_fail(spark, code, key):
    with pytest.raises(Exception, match="more than"):
        spark.range(key, key + 1).selectExpr(getattr(bridge, code)("id")).collect()


def test_numbered_with_a_million_equal_rows(spark):
    df = spark.range(1_000_000).selectExpr("'hot' as k", "'2020-01-01' as day", "'x' as tie")
    out = ops.numbered(df.repartition(8), "k", "day", ["tie"])
    got = out.agg(F.count("*"), F.count_distinct("line_num"), F.min("line_num"), F.max("line_num")).first()
    assert tuple(got) == (1_000_000, 1_000_000, 1, 1_000_000)
    assert dict(out.dtypes)["line_num"] == "bigint"


def test_running_total_reads_its_input_twice(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id % 7 as string) as day", "sha2(cast(id as string), 256) as key", "cast(1 as decimal(10,2)) as amount").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = ops.running_until(df, "amount", "day", "key", 400)
    assert float(out.collect()[0][0]) == 400.0
    text = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Scan parquet") == 2
    assert float(ops.running_until(df, "amount", "day", "key", 5000).first()[0]) == 1000.0


def test_left_join_keeps_rows_without_a_key(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, w string")
    got = rows(ops.left_join_hot_right(left, right, "k"), "k", "v", "w")
    assert got == sorted([(1, "a", "x"), (1, "a", "y"), (2, "b", None), (None, "c", None)], key=repr)


def test_condition_targets_multiply_counts(spark, sf_dir):
    clinic = __import__("checks.queries", fromlist=["Clinic"]).Clinic(spark, sf_dir)
    mapping = clinic["lookup_snomed_icd10cm_map"]
    raw = clinic.raw["conditions"]
    fanned = cleaned.condition(raw, bridge.AS_OF, mapping).groupBy("condition_code", "icd10cm_code").count()
    counted = cleaned.condition_targets(raw, bridge.AS_OF, mapping)
    assert sorted(map(tuple, fanned.collect()), key=repr) == sorted(map(tuple, counted.collect()), key=repr)


@pytest.mark.parametrize("name", ["lookup_hcpcs_codes", "lookup_icd10cm_codes", "v_snomed_icd10cm_simple"])
def test_code_files_are_made_in_methods_the_jvm_compiles(spark, sf_dir, name):
    """Longer methods than 8,000 bytes are interpreted, at some 100 microseconds a part."""
    from checks.queries import Clinic

    found = Clinic(spark, sf_dir)["v_hcpcs_active" if name == "lookup_hcpcs_codes" else name]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = found.select("*")._jdf.queryExecution()
        made = found.debug().codegenToSeq()
        sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
        dealt = "hashpartitioning(p_partkey" in found.executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000 and dealt
