"""Files to mart in a small warehouse, with run log and failures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.bridge import Raw
from vitalmart.plans import cleaned, lookups, pipeline, reports
from vitalmart.sources import layouts, tables
from vitalmart.session import scratch_path

AS_OF = dt.date(2002, 1, 1)
LAYERS = tables.Layers("t_bronze", "t_silver", "t_gold")


@pytest.fixture(scope="module")
def built(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("source"))
    raw = Raw(spark, sf_dir)
    for schema in ("t_bronze", "t_silver", "t_gold"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for table, layout in layouts.CSV_COLUMNS.items():
        if table == "symptoms":  # left out: its failure must end up in the run log
            continue
        frame = raw[table]
        have = {c.upper() for c in frame.columns}
        columns = [
            F.col(c) if c.upper() in have else F.lit(None).cast("string").alias(c)
            for c in layouts.names(layout)
        ]
        frame.select(*columns).coalesce(1).write.option("emptyValue", "").csv(
            f"{root}/East/output/csv/{table}.csv"
        )
    names = {need for maker, needs in lookups.TABLES.values() for need in needs}
    files = {n: (lambda n=n: raw[n]) for n in names if n != "as_of" and n not in lookups.TABLES}
    log = pipeline.build_all(spark, root, files, LAYERS, AS_OF)
    return log


def test_run_log(spark, built):
    failed = {r["table_name"] for r in built.filter("not success").collect()}
    assert failed == {"bronze_symptoms", "bronze_notes", "bronze_text_encounters"}
    summary = {r["stage"]: r for r in tables.stage_summary(built).collect()}
    assert summary["silver"]["tables_successful"] == 18 and summary["silver"]["success"]
    assert summary["gold"]["tables_successful"] == 26
    assert summary["lookups"]["tables_successful"] == 20
    assert summary["lookup_views"]["tables_successful"] == 29 and summary["lookup_views"]["total_rows"] is None
    counted = built.filter("table_name = 'fact_encounter'").first()["row_count"]
    assert counted == spark.table("t_gold.fact_encounter").count() == 1500


def test_stored_tables_carry_refresh_times(spark, built):
    assert "last_updated" in spark.table("t_silver.v_patient_flattened").columns
    assert {"source_last_updated", "dim_created_dts"} <= set(spark.table("t_gold.dim_patient").columns)
    assert "fact_refresh_dts" in spark.table("t_gold.fact_claim").columns
    assert "agg_refresh_dts" in spark.table("t_gold.agg_readmission_rates").columns
    hcpcs = spark.table("t_bronze.lookup_hcpcs_codes")
    assert hcpcs.select("_rec_src").first()[0] == "REFERENCE.HCPCS"


def test_failed_lookup_stops_what_needs_it(spark, built):
    def broken():
        raise ValueError("no such file" + "!" * 3000)

    failed = {"t_bronze.bronze_devices"}
    log = pipeline.build_lookups(spark, {"hcpcs_lines": broken}, LAYERS, AS_OF, failed)
    errors = {r.table_name: r.error for r in log if not r.success}
    assert errors["lookup_hcpcs_codes"].endswith("!" * 3000)
    assert "lookup_hcpcs_codes, which failed in this run" in errors["v_hcpcs_active"]
    cleaned_log = {r.table_name: r for r in pipeline.build_cleaned(spark, LAYERS, AS_OF, failed)}
    assert not cleaned_log["v_procedure_flattened"].success
    assert not cleaned_log["v_device_flattened"].success
    assert cleaned_log["v_patient_flattened"].success


def test_report_views(spark, built):
    assert pipeline.register_report_views(spark, LAYERS) == list(reports.VIEWS)
    total = spark.sql("SELECT count(*) FROM fact_patient_claims").first()[0]
    assert total == spark.table("rprt_patient_claims").count() > 0
    assert spark.table("dim_diagnosis").count() > 0


def test_verification_and_listing(spark, built):
    expected = [*lookups.TABLES, "lookup_missing"]
    got = {r["table_name"]: r for r in tables.verify_tables(spark, "t_bronze", expected).collect()}
    assert got["lookup_missing"]["status"] == "MISSING" and got["lookup_missing"]["row_count"] is None
    assert all(got[n]["status"] == "OK" and got[n]["row_count"] > 0 for n in lookups.TABLES)
    assert {n.lower() for n in cleaned.TABLE_NAMES.values()} <= set(tables.list_tables(spark, "t_silver"))
    described = tables.describe(spark, "t_gold.dim_date")
    assert described.filter("col_name = 'month_end'").first()["data_type"] == "date"


def test_run_metadata_json(spark, built):
    path = scratch_path(spark, "metadata")
    tables.write_run_metadata(built, path)
    assert spark.read.json(path).count() == 5


def test_code_file_readers_fail_only_their_tables(spark, tmp_path):
    folders = {s: str(tmp_path) for s in ("hcpcs", "icd10cm", "ndc", "snomed", "rxnorm", "rxnorm_prescribe")}
    readers_ = pipeline.code_files(spark, folders)
    (tmp_path / "RXNDOC.RRF").write_text("k|v|t|e|\n")
    assert readers_["doc"]().count() == 1
    assert len(readers_) == 17
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers_["atoms"]()
