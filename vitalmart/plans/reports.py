"""Analyst views over the mart, the standard questions, and set-based claim summaries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.keys import surrogate_key
from vitalmart.functions.measures import bands, is_blank, or_zero, recode
from vitalmart.operators.rows import running_until
from vitalmart.plans.cms import (
    DIAGNOSIS_SLOTS,
    FLAG_COLUMNS,
    fact_cms_inpatient_claims,
    fact_cms_outpatient_claims,
)
from vitalmart.plans.star import named
from vitalmart.sources.tables import typed_nulls

c = F.col

# --- views -----------------------------------------------------------------------------

# Analyst names of mart columns, and sex letters.
SEX_LETTERS = {1: "M", 2: "F"}
BENEFICIARY_NAMES = {
    "beneficiary_code": "desynpuf_id",
    "date_of_birth": "bene_birth_dt",
    "death_date": "bene_death_dt",
    "state": "sp_state_code",
}
CLAIM_NAMES = {
    "claim_id": "claim_key",
    "beneficiary_code": "desynpuf_id",
    "attending_physician_provider_key": "provider_key",
    "attending_physician_npi": "at_physn_npi",
    "claim_start_date": "clm_from_dt",
    "claim_end_date": "clm_thru_dt",
    "claim_payment_amount": "clm_pmt_amt",
    "primary_payer_claim_paid_amount": "nch_prmry_pyr_clm_pd_amt",
}


def _sex() -> Column:
    return recode("bene_sex_ident_cd", SEX_LETTERS, "U")


def dim_beneficiary(beneficiary: DataFrame) -> DataFrame:
    return beneficiary.select(
        *named(
            "beneficiary_key",
            "bene_esrd_ind",
            *FLAG_COLUMNS.values(),
            "source_system",
            gender=_sex(),
            race_cd="bene_race_cd",
            county_cd="bene_county_cd",
            **BENEFICIARY_NAMES,
        )
    )


def dim_provider(provider: DataFrame) -> DataFrame:
    return provider


def dim_date(calendar: DataFrame) -> DataFrame:
    return calendar


def fact_patient_claims(outpatient: DataFrame, inpatient: DataFrame) -> DataFrame:
    """Both claim kinds under common names; only inpatient claims have an admission."""

    def labelled(claims: DataFrame, kind: str, admission: Column) -> DataFrame:
        return claims.select(
            *named("beneficiary_key", "service_date_key", "source_system", **CLAIM_NAMES),
            F.lit(kind).alias("claim_type"),
            admission.cast("date").alias("inpatient_admission_date"),
        )

    return labelled(outpatient, "Outpatient", F.lit(None)).unionByName(
        labelled(inpatient, "Inpatient", c("clm_admsn_dt"))
    )


def rprt_patient_claims(
    claims: DataFrame, beneficiary: DataFrame, provider: DataFrame
) -> DataFrame:
    person = beneficiary.select(
        *named("beneficiary_key", gender=_sex(), **BENEFICIARY_NAMES)
    )
    doctor = provider.select(
        "provider_key", "provider_id", "provider_name", c("state").alias("provider_state")
    )
    return (
        claims.drop("beneficiary_code", "service_date_key", "source_system")
        .join(person, "beneficiary_key")
        .join(doctor, c("attending_physician_provider_key") == c("provider_key"), "left")
        .drop("attending_physician_provider_key", "attending_physician_npi")
    )


def dim_diagnosis(condition: DataFrame | None, spark=None) -> DataFrame:
    """Distinct diagnoses; without conditions an empty frame of the same shape."""
    if condition is None:
        names = "diagnosis_key diagnosis_code description icd10cm_code source_system".split()
        return spark.range(0).select(*typed_nulls(names))
    return (
        condition.filter(c("condition_code").isNotNull())
        .select(
            c("condition_code").alias("diagnosis_code"),
            c("condition_description").alias("description"),
            "icd10cm_code",
            "source_system",
        )
        .distinct()
        .withColumn("diagnosis_key", surrogate_key("diagnosis_code"))
    )


VIEWS: dict[str, tuple[Callable[..., DataFrame], Sequence[str]]] = {
    "dim_beneficiary": (dim_beneficiary, ("dim_cms_beneficiary",)),
    "dim_provider": (dim_provider, ("dim_cms_provider",)),
    "dim_date": (dim_date, ("dim_date",)),
    "fact_patient_claims": (
        fact_patient_claims,
        ("fact_cms_outpatient_claims", "fact_cms_inpatient_claims"),
    ),
    "rprt_patient_claims": (
        rprt_patient_claims,
        ("fact_patient_claims", "dim_cms_beneficiary", "dim_cms_provider"),
    ),
    "dim_diagnosis": (dim_diagnosis, ("condition",)),
}

# --- standard questions ----------------------------------------------------------------


def _totals(by: Sequence[str | Column], df: DataFrame) -> DataFrame:
    return df.groupBy(*by).agg(
        F.sum("claim_payment_amount").alias("total_claim_amount"),
        F.count("*").alias("claim_count"),
    )


def _year() -> Column:
    return F.year("claim_start_date").alias("year")


def _with_person(claims: DataFrame, beneficiary: DataFrame) -> DataFrame:
    people = beneficiary.select("beneficiary_key", "state", "gender")
    return claims.join(people, "beneficiary_key")


def _person_totals(
    claims: DataFrame, beneficiary: DataFrame, by: Sequence[str], per_claim: Sequence[Column] = ()
) -> DataFrame:
    """Totals over personal columns, claims being summed per person before the join.

    A person with very many claims then meets the beneficiaries as a few rows.
    """
    return (
        _with_person(_totals(["beneficiary_key", *per_claim], claims), beneficiary)
        .groupBy(*by)
        .agg(
            F.sum("total_claim_amount").alias("total_claim_amount"),
            F.sum("claim_count").alias("claim_count"),
        )
    )


def totals_by_year_state_gender(claims: DataFrame, beneficiary: DataFrame) -> DataFrame:
    dated = claims.filter("claim_start_date is not null")
    by = ["year", "state", "gender"]
    return _person_totals(dated, beneficiary, by, [_year()]).orderBy(*by)


def totals_by_state(claims: DataFrame, beneficiary: DataFrame) -> DataFrame:
    located = beneficiary.filter("state is not null")
    totals = _person_totals(claims, located, ["state"])
    return totals.orderBy(F.desc("total_claim_amount"), "state")


def totals_in_year(claims: DataFrame, beneficiary: DataFrame, year: int) -> DataFrame:
    """Totals by state and gender for the year bound to the ``:year`` parameter."""
    spark = claims.sparkSession
    return spark.sql(
        "SELECT b.state, b.gender, sum(f.claim_payment_amount) AS total_claim_amount, "
        "count(f.claim_id) AS claim_count "
        "FROM {claims} f JOIN {people} b USING (beneficiary_key) "
        "WHERE year(f.claim_start_date) = :year "
        "GROUP BY ALL ORDER BY total_claim_amount DESC, state, gender",
        args={"year": year},
        claims=claims,
        people=beneficiary,
    )


def report_by_year_gender(report: DataFrame) -> DataFrame:
    dated = report.filter("claim_start_date is not null")
    return _totals([_year(), "gender"], dated).orderBy("year", "gender")


def report_by_state(report: DataFrame) -> DataFrame:
    located = report.filter("state is not null")
    return _totals(["state"], located).orderBy(F.desc("total_claim_amount"), "state")


def claims_with_local_provider(report: DataFrame, local_state: str = "NY") -> DataFrame:
    """Claims whose attending provider is local, by default in New York."""
    return report.filter(c("provider_state") == local_state)


def claims_in_state_and_year(report: DataFrame, state: str, year: int) -> DataFrame:
    wanted = (c("state") == state) & (F.year("claim_start_date") == year)
    return report.filter(wanted).agg(F.count("*").alias("claim_count"))


def diagnoses_of_top_claims(
    outpatient: DataFrame, inpatient: DataFrame, diagnoses: DataFrame, top: int = 10
) -> DataFrame:
    """Diagnosis descriptions of the claims with the highest payments.

    Only ``top`` claims reach the join, so that side is the broadcast one.
    """
    slots = [f"icd_dgns_cd{i}" for i in range(1, DIAGNOSIS_SLOTS + 1)]
    stacked = outpatient.select("claim_key", "clm_pmt_amt", *slots).unionByName(
        inpatient.select("claim_key", "clm_pmt_amt", *slots)
    )
    highest = stacked.orderBy(F.desc("clm_pmt_amt"), "claim_key").limit(top)
    coded = highest.select(
        c("claim_key").alias("claim_id"),
        c("clm_pmt_amt").alias("claim_payment_amount"),
        F.explode(F.array_distinct(F.array_compact(F.array(*slots)))).alias("code"),
    )
    names = diagnoses.select(
        F.coalesce("icd10cm_code", "diagnosis_code").alias("code"), "diagnosis_code", "description"
    )
    return names.join(coded, "code").select(
        "claim_id", "claim_payment_amount", "code", "diagnosis_code", "description"
    )


def diagnoses_of_top_encounters(
    encounter: DataFrame,
    condition: DataFrame,
    procedure: DataFrame,
    diagnoses: DataFrame,
    top: int = 10,
) -> DataFrame:
    """`diagnoses_of_top_claims` where the claims are not stored yet: the highest claims are
    found from encounters alone, and code slots are made for these only."""

    def kinds(*inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
        return fact_cms_outpatient_claims(*inputs), fact_cms_inpatient_claims(*inputs)

    outpatient, inpatient = kinds(encounter, condition, procedure)
    paid = ("claim_key", "clm_pmt_amt", c("clm_id").alias("encounter_id"))
    claims = outpatient.select(*paid).unionByName(inpatient.select(*paid))
    highest = claims.orderBy(F.desc("clm_pmt_amt"), "claim_key").limit(top)
    theirs = F.broadcast(highest.select("encounter_id").distinct())
    few = [rows.join(theirs, "encounter_id", "left_semi") for rows in (encounter, condition, procedure)]
    return diagnoses_of_top_claims(*kinds(*few), diagnoses, top)


def predicted_amounts(claims: DataFrame, beneficiary: DataFrame) -> DataFrame:
    """Every claimant with the mean payment of claimants of the same state and gender."""
    own = claims.groupBy("beneficiary_key", "beneficiary_code").agg(
        F.sum("claim_payment_amount").alias("claim_payment_amount"),
        F.count("claim_payment_amount").alias("payments"),
    )
    claimants = _with_person(own, beneficiary)
    mean = (F.sum("claim_payment_amount") / F.sum("payments")).cast("decimal(22,6)")
    means = claimants.groupBy(c("state").alias("_state"), c("gender").alias("_gender")).agg(
        mean.alias("predicted_amount")
    )
    same_group = c("state").eqNullSafe(c("_state")) & c("gender").eqNullSafe(c("_gender"))
    return claimants.join(means, same_group, "left").select(
        "beneficiary_code", "state", "gender", "predicted_amount"
    )


# --- claim summaries that scripts would compute in loops -------------------------------


def _both(outpatient: DataFrame, inpatient: DataFrame, *columns: str) -> DataFrame:
    return (
        outpatient.select(*columns, F.lit("Outpatient").alias("kind"))
        .unionByName(inpatient.select(*columns, F.lit("Inpatient").alias("kind")))
    )


def claim_totals(outpatient: DataFrame, inpatient: DataFrame) -> DataFrame:
    total = or_zero(F.sum("clm_pmt_amt")).cast("decimal(18,2)")
    return _both(outpatient, inpatient, "clm_pmt_amt").agg(
        F.count("*").alias("num_claims"), total.alias("total_payment")
    )


def claim_year_range(outpatient: DataFrame, inpatient: DataFrame) -> DataFrame:
    year = F.year("clm_from_dt")
    return _both(outpatient, inpatient, "clm_from_dt").agg(
        F.min(year).alias("min_year"), F.max(year).alias("max_year")
    )


# Tiers of the claim total and sizes of the claim count.
TOTAL_TIERS = ((1000000, "Very high"), (100000, "High"), (1000, "Medium"))
COUNT_SIZES = ((100000, "Large dataset"), (1000, "Medium dataset"), (1, "Small dataset"))


def claim_profile(outpatient: DataFrame, inpatient: DataFrame) -> DataFrame:
    """Claim mix, amount tier, size and presence message, decided from one aggregate."""
    counts = _both(outpatient, inpatient, "clm_pmt_amt").agg(
        F.count_if(c("kind") == "Inpatient").alias("inpatient_count"),
        F.count_if(c("kind") == "Outpatient").alias("outpatient_count"),
        or_zero(F.sum("clm_pmt_amt")).cast("decimal(18,2)").alias("total"),
    )
    has_in, has_out = c("inpatient_count") > 0, c("outpatient_count") > 0
    presence = (
        F.when(has_in & has_out, "Both claim types present")
        .when(has_in, "Inpatient only")
        .when(has_out, "Outpatient only")
        .otherwise("No claims")
    )
    description = F.when(has_in, "Inpatient claims").otherwise("Outpatient claims")
    claim_count = c("inpatient_count") + c("outpatient_count")
    return counts.select(
        claim_count.alias("claim_count"),
        "total",
        description.alias("description"),
        bands("total", TOTAL_TIERS, "Low").alias("tier"),
        bands(claim_count, COUNT_SIZES, "No claims").alias("message"),
        presence.alias("result"),
    )


def total_until(claims: DataFrame, threshold: float) -> DataFrame:
    """Payments added by date until the threshold is first reached."""
    return running_until(claims, "clm_pmt_amt", "clm_from_dt", "claim_key", threshold)


def positive_payments(claims: DataFrame) -> DataFrame:
    total = or_zero(F.sum("clm_pmt_amt")).cast("decimal(18,2)")
    return claims.filter("clm_pmt_amt > 0").agg(
        F.count("*").alias("nonzero_count"), total.alias("total_amt")
    )


def states_seen(beneficiary: DataFrame, most: int = 5) -> DataFrame:
    """The first few states in order, as one text."""
    states = (
        beneficiary.filter("sp_state_code is not null")
        .select(c("sp_state_code").alias("state"))
        .distinct()
        .orderBy("state")
        .limit(most)
    )
    listed = F.array_join(F.array_sort(F.collect_list("state")), ", ")
    return states.agg(listed.alias("states_seen"))


def loop_bounds(outpatient: DataFrame, inpatient: DataFrame, beneficiary: DataFrame) -> DataFrame:
    """Two counts scripts loop up to: at most 10 claims, and the number of states."""
    states = beneficiary.agg(F.count_distinct("sp_state_code")).scalar()
    claims = F.least(F.count("*"), F.lit(10))
    return _both(outpatient, inpatient, "clm_pmt_amt").agg(claims.alias("target_count")).select(
        "target_count", states.alias("distinct_states")
    )


def claim_summary(
    outpatient: DataFrame, inpatient: DataFrame, beneficiary: DataFrame, state: str | None = None
) -> DataFrame:
    """Claim count and amount per state; no state, or a blank one, means all states."""
    people = beneficiary.select("beneficiary_key", c("sp_state_code").alias("state"))
    if state is not None and state.strip():
        people = people.filter(c("state") == state)
    per_person = (
        _both(outpatient, inpatient, "beneficiary_key", "clm_pmt_amt")
        .groupBy("beneficiary_key")
        .agg(F.count("*").alias("claim_count"), F.sum("clm_pmt_amt").alias("total_amount"))
    )
    return (
        per_person.join(people, "beneficiary_key")
        .groupBy("state")
        .agg(
            F.sum("claim_count").alias("claim_count"), F.sum("total_amount").alias("total_amount")
        )
    )


# --- failing values as data ------------------------------------------------------------


def safe_ratio(df: DataFrame, part: str, whole: str, name: str = "ratio") -> DataFrame:
    """A ratio that is NULL with the error named, where dividing would fail."""
    failed = c(whole) == 0
    return df.withColumns(
        {
            name: F.try_divide(part, whole),
            "error": F.when(failed, "DIVIDE_BY_ZERO"),
        }
    )


def rejects(
    raw: DataFrame, key: str, checks: Mapping[str, tuple[Callable[[Column], Column], str]]
) -> DataFrame:
    """Values a conversion could not read, one row each, beside the key of their row.

    ``checks`` maps a raw column to its conversion and the name of the target type.
    """
    failures = [
        F.when(
            ~is_blank(column) & convert(c(column)).isNull(),
            F.struct(
                F.lit(column).alias("source_column"),
                c(column).alias("source_value"),
                F.lit("CAST_INVALID_INPUT").alias("error_condition"),
                F.concat(
                    F.lit("The value '"), c(column), F.lit(f"' cannot be read as {target}.")
                ).alias("error_message"),
            ),
        )
        for column, (convert, target) in checks.items()
    ]
    found = F.explode(F.array_compact(F.array(*failures))).alias("failure")
    return raw.select(c(key).alias("record_key"), found).select("record_key", "failure.*")


def data_checks(
    outpatient: DataFrame, inpatient: DataFrame, beneficiary: DataFrame, state: str
) -> DataFrame:
    """Whether the claims are not empty and the state is known, one row per check."""
    claims = _both(outpatient, inpatient, "clm_pmt_amt").agg(F.count("*").alias("observed"))
    known = beneficiary.filter(c("sp_state_code") == state).agg(F.count("*").alias("observed"))

    def check(name: str, counted: DataFrame, message: str) -> DataFrame:
        passed = c("observed") > 0
        return counted.select(
            F.lit(name).alias("check_name"),
            "observed",
            passed.alias("passed"),
            F.when(~passed, message).alias("message"),
        )

    return check("claims_present", claims, "No claims in gold fact tables.").unionByName(
        check("state_known", known, "No beneficiaries found for the given state.")
    )


def enforce(checks: DataFrame) -> DataFrame:
    """The checks again, failing the query with the message of one that did not pass."""
    return checks.withColumn(
        "passed", F.when(c("passed"), F.lit(True)).otherwise(F.raise_error(c("message")).cast("boolean"))
    )
