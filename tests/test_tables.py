"""Semantics of table builders on small hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.queries import Clinic
from vitalmart.plans import cleaned, cms, lookups, reports, star


def stays(spark, rows_):
    schema = "patient_key string, start string, stop string, inpatient boolean"
    return spark.createDataFrame(rows_, schema).select(
        "patient_key",
        F.to_timestamp("start").alias("start_date"),
        F.to_timestamp("stop").alias("end_date"),
        F.col("inpatient").alias("is_inpatient"),
        (~F.col("inpatient")).alias("is_emergency"),
    )


def test_readmissions_by_start(spark):
    df = stays(
        spark,
        [("p", "2024-01-01", None, True), ("p", "2024-01-31", None, False), ("p", "2024-04-01", None, True)],
    )
    total = star.agg_readmission_rates(df).agg(
        *[F.sum(c) for c in ("total_admissions", "readmissions_30_day", "readmissions_60_day", "readmissions_90_day")]
    )
    assert tuple(total.first()) == (2, 1, 1, 2)


def test_readmissions_on_one_day_and_unknown_starts(spark):
    df = stays(
        spark,
        [("p", "2024-01-01 08:00:00", None, True)] * 4 + [("p", None, None, True), ("q", "2024-01-02", None, True)],
    )
    row = star.agg_readmission_rates(df).first()
    assert (row["total_admissions"], row["unique_patients"], row["readmissions_30_day"]) == (3, 1, 3)
    assert row["avg_days_to_30_day_readmit"] == 0.0


def test_readmissions_from_discharge(spark):
    df = stays(
        spark,
        [("p", "2024-01-01", "2024-01-20", True), ("p", "2024-02-10", None, True), ("p", "2024-02-05", None, False)],
    )
    got = star.agg_readmission_rates(df, basis="discharge_to_admit").collect()
    assert [(r["total_admissions"], r["readmissions_30_day"]) for r in got] == [(1, 0), (1, 1)]
    assert got[1]["avg_days_to_30_day_readmit"] == 21.0


@pytest.mark.parametrize(
    ("code", "chapters"),
    [("C44", {"02"}), ("D49", {"02"}), ("D50", {"03"}), ("D3A", {"02"}), ("H59", {"07"}), ("H60", {"08"}),
     ("O9A", {"15"}), ("T88", {"19"}), ("Z3A", {"21"}), ("U07", {"22"}), ("Y99", {"20"})],
)
def test_each_code_falls_in_one_chapter(spark, code, chapters):
    df = spark.createDataFrame([(code[0], code)], "chapter_letter string, category_code string")
    got = lookups.with_chapter(df).collect()
    assert [{r["chapter_num"]} for r in got] == [chapters]


def test_conditions_keep_their_grain(spark, sf_dir):
    clinic = Clinic(spark, sf_dir)
    assert clinic["condition"].count() == clinic.raw["conditions"].count()
    assert clinic["procedure"].count() == clinic.raw["procedures"].count()
    assert clinic["medication"].count() == clinic.raw["medications"].count()


def test_keys_are_unique(spark, sf_dir):
    clinic = Clinic(spark, sf_dir)
    for table, key in {
        "dim_patient": "patient_key",
        "dim_encounter_type": "encounter_type_key",
        "dim_date": "date_key",
        "lookup_rxnorm_concepts": "rxcui",
        "v_snomed_icd10cm_simple": "snomed_concept_id",
    }.items():
        assert clinic[table].groupBy(key).count().filter("count > 1").count() == 0, table


def test_zero_fill_leaves_no_null(spark, sf_dir):
    df = Clinic(spark, sf_dir)["agg_patient_summary"]
    counted = [c for c in df.columns if c.startswith(("total_", "active_", "avg_"))]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in counted]).first()
    assert set(nulls) == {0}


def test_lookups_are_optional(spark, sf_dir):
    raw = Clinic(spark, sf_dir).raw["conditions"]
    df = cleaned.build("condition", raw, dt.date(2002, 1, 1))
    assert dict(df.dtypes)["icd10cm_code"] == "string"
    assert df.filter("icd10cm_code is not null").count() == 0


def test_stub_diagnoses_have_the_same_columns(spark, sf_dir):
    made = reports.dim_diagnosis(Clinic(spark, sf_dir)["condition"])
    stub = reports.dim_diagnosis(None, spark)
    assert stub.count() == 0 and set(stub.columns) == set(made.columns)


def test_failed_check_stops_the_query(spark, sf_dir):
    clinic = Clinic(spark, sf_dir)
    frames = [clinic[n] for n in ("fact_cms_outpatient_claims", "fact_cms_inpatient_claims", "dim_cms_beneficiary")]
    with pytest.raises(Exception, match="No beneficiaries found"):
        reports.enforce(reports.data_checks(*frames, "XX")).collect()


def test_claim_summary_blank_state_means_all(spark, sf_dir):
    clinic = Clinic(spark, sf_dir)
    frames = [clinic[n] for n in ("fact_cms_outpatient_claims", "fact_cms_inpatient_claims", "dim_cms_beneficiary")]
    assert reports.claim_summary(*frames).count() == reports.claim_summary(*frames, state="  ").count() > 1
    assert reports.claim_summary(*frames, state="NATION_1").count() == 1


def test_sex_and_race_codes(spark):
    people = spark.createDataFrame(
        [("1", "m", "White", "x"), ("2", "female", "Other", "Hispanic or Latino"), ("3", "?", "Other", "x")],
        "patient_id string, gender string, race string, ethnicity string",
    )
    for extra in ("birth_date", "death_date", "state", "county", "source_system"):
        people = people.withColumn(extra, F.lit(None).cast("string"))
    conditions = spark.createDataFrame([("1", "44054006"), ("1", "90688005")], "patient_id string, condition_code string")
    got = {r["desynpuf_id"]: r for r in cms.dim_cms_beneficiary(people, conditions).collect()}
    assert [(got[i]["bene_sex_ident_cd"], got[i]["bene_race_cd"]) for i in "123"] == [(1, 1), (2, 5), (0, 3)]
    assert (got["1"]["sp_diabetes"], got["1"]["bene_esrd_ind"], got["2"]["sp_diabetes"]) == (1, "Y", 2)


def test_cleaning_applies_to_streams(spark, sf_dir, tmp_path):
    raw = Clinic(spark, sf_dir).raw["supplies"]
    raw.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    cleaned_stream = cleaned.shape(stream, cleaned.SPECS["supply"], dt.date(2024, 1, 1))
    query = (
        cleaned_stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == raw.count()


def test_calendar_of_the_mart_has_the_days_of_all_encounters(spark, sf_dir):
    clinic = Clinic(spark, sf_dir)
    _, maker, needs = star.TABLES["dim_date"]
    dates = maker(*[clinic[n] for n in needs])
    facts = clinic["fact_encounter"]
    monthly = star.agg_financial_summary(facts, dates)
    assert monthly.agg(F.sum("total_encounters")).first()[0] == facts.count()
    for key in ("start_date_key", "end_date_key"):
        days = facts.where(facts[key].isNotNull()).select(F.col(key).alias("date_key"))
        assert days.join(dates, "date_key", "left_anti").count() == 0
    assert maker(clinic["encounter"].limit(0)).count() == star.dim_date(spark).count()
