"""The star schema: 6 dimensions, 5 facts and 8 aggregates.

Builders take cleaned (or already built) frames, so a plan can run from stored tables or
straight through. Fact rows keep the money type of the cleaned layer; rates are doubles
rounded to two places. Refresh times are added by the writer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalmart.functions.keys import date_key, surrogate_key
from vitalmart.functions.measures import (
    bands,
    count_where,
    days_between,
    or_false,
    or_zero,
    pct,
    per_head,
    recode,
)
from vitalmart.operators.rows import left_join_hot_right

c = F.col

# Band floors from high to low.
AGE_GROUPS = (
    (65, "Senior (65+)"),
    (50, "Middle Age (50-64)"),
    (35, "Adult (35-49)"),
    (18, "Young Adult (18-34)"),
)
SIZE_BANDS = ((10000, "Large"), (1000, "Medium"), (100, "Small"))
PAYER_TIERS = ((0.8, "Premium"), (0.6, "Standard"), (0.4, "Basic"))
COST_TIERS = ((5000, "High Cost"), (1000, "Medium Cost"))
RISK_LEVELS = ((3, "High"), (1, "Medium"))
VOLUME_TIERS = ((1000, "High Volume"), (100, "Medium Volume"))
USE_TIERS = ((1000, "High Utilization"), (100, "Medium Utilization"))
ENCOUNTER_CATEGORIES = {"EMER": "Emergency", "IMP": "Inpatient", "AMB": "Outpatient"}
ACUITY = {"EMER": 1, "IMP": 2, "AMB": 3}
CHRONIC_DAYS = 90
READMISSION_DAYS = (30, 60, 90)


def named(*same: str, **renamed: str | Column) -> list[Column]:
    """Columns kept as they are, then columns given as output name = source."""
    kept = [c(n) for n in same]
    return kept + [(c(s) if isinstance(s, str) else s).alias(n) for n, s in renamed.items()]


def zero_filled(*columns: str) -> list[Column]:
    return [or_zero(n).alias(n) for n in columns]


# --- dimensions ------------------------------------------------------------------------


def _calendar(days: DataFrame) -> DataFrame:
    """The attributes of each day of column ``date``."""
    day = c("date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.date_trunc("month", day).alias("month_start"),
        F.last_day(day).alias("month_end"),
        F.date_trunc("quarter", day).alias("quarter_start"),
        F.date_trunc("year", day).alias("year_start"),
    )


def dim_date(spark: SparkSession, start_year: int = 2000, end_year: int = 2030) -> DataFrame:
    """One row per calendar day, generated by row number so any span is distributed."""
    first, past = dt.date(start_year, 1, 1), dt.date(end_year + 1, 1, 1)
    days = spark.range((past - first).days)
    return _calendar(days.select(F.date_add(F.lit(first), c("id").cast("int")).alias("date")))


def dim_date_of_encounters(
    encounter: DataFrame, start_year: int = 2000, end_year: int = 2030
) -> DataFrame:
    """The calendar from the first to the last year given, widened to whole years until every
    encounter meets the days it starts and ends on.

    The span is one aggregate over the encounters, taken when the frame runs. Encounters
    without dates, or none at all, leave the years given.
    """
    start, end = F.to_date("start_datetime"), F.to_date("end_datetime")
    seen = encounter.agg(
        F.least(F.min(start), F.min(end)).alias("first"),
        F.greatest(F.max(start), F.max(end)).alias("last"),
    )
    first = F.least(F.year("first"), F.lit(start_year))
    last = F.greatest(F.year("last"), F.lit(end_year))
    span = F.sequence(F.make_date(first, F.lit(1), F.lit(1)), F.make_date(last, F.lit(12), F.lit(31)))
    return _calendar(seen.select(F.explode(span).alias("date")))


def dim_patient(patient: DataFrame) -> DataFrame:
    parts = ("name_prefix", "first_name", "middle_name", "last_name", "name_suffix")
    loaded = {"source_last_updated": "last_updated"} if "last_updated" in patient.columns else {}
    return patient.select(
        surrogate_key("patient_id").alias("patient_key"),
        *named(
            "patient_id",
            "first_name",
            "middle_name",
            "last_name",
            "gender",
            "birth_date",
            "death_date",
            "is_deceased",
            "age_years",
            "city",
            "state",
            "country",
            "marital_status",
            "race",
            "ethnicity",
            "source_system",
            full_name=F.concat_ws(" ", *parts),
            age_group=bands("age_years", AGE_GROUPS, "Pediatric (0-17)", "Unknown"),
            address="address_line",
            zip_code="postal_code",
            mrn="medical_record_number",
            **loaded,
        ),
    )


def dim_provider(practitioner: DataFrame) -> DataFrame:
    return practitioner.select(
        surrogate_key("practitioner_id").alias("provider_key"),
        surrogate_key("organization_id").alias("organization_key"),
        *named(
            "gender",
            "specialty",
            "specialty_code",
            "organization_id",
            "city",
            "state",
            "encounter_count",
            "procedure_count",
            "active",
            "source_system",
            provider_id="practitioner_id",
            provider_name="name",
            address="address_line",
            zip_code="postal_code",
        ),
    )


def dim_organization(organization: DataFrame) -> DataFrame:
    return organization.select(
        surrogate_key("organization_id").alias("organization_key"),
        *named(
            "organization_id",
            "name",
            "type_code",
            "type_display",
            "city",
            "state",
            "phone",
            "latitude",
            "longitude",
            "revenue",
            "utilization",
            "active",
            "source_system",
            address="address_line",
            zip_code="postal_code",
            size_classification=bands("utilization", SIZE_BANDS, "Very Small"),
        ),
    )


def dim_payer(payer: DataFrame) -> DataFrame:
    covered, uncovered = c("covered_encounters"), c("uncovered_encounters")
    monthly = per_head(c("amount_covered"), c("member_months"))
    return payer.select(
        surrogate_key("payer_id").alias("payer_key"),
        *named(
            "payer_id",
            "payer_name",
            "ownership_type",
            "is_active",
            "phone",
            "city",
            "state",
            "amount_covered",
            "amount_uncovered",
            "revenue",
            "coverage_ratio",
            "covered_encounters",
            "uncovered_encounters",
            "covered_medications",
            "uncovered_medications",
            "covered_procedures",
            "uncovered_procedures",
            "covered_immunizations",
            "uncovered_immunizations",
            "quality_of_life_score_avg",
            "member_months",
            "source_system",
            zip_code="postal_code",
            total_encounters=covered + uncovered,
            member_count="unique_customers",
            encounter_coverage_rate_pct=pct(covered, covered + uncovered),
            pmpm_covered=F.when(c("member_months") > 0, monthly).otherwise(F.lit(0.0)),
            payer_tier=bands("coverage_ratio", PAYER_TIERS, "Minimal"),
        ),
    )


def dim_encounter_type(encounter: DataFrame) -> DataFrame:
    """One row per class code and type code, the two columns the key is made of."""
    code = c("encounter_class_code")
    return (
        encounter.filter(code.isNotNull())
        .groupBy("encounter_class_code", "encounter_type_code")
        .agg(
            F.min("encounter_class").alias("encounter_class"),
            F.min("encounter_type").alias("encounter_type"),
        )
        .select(
            surrogate_key("encounter_class_code", "encounter_type_code").alias(
                "encounter_type_key"
            ),
            "*",
            recode(code, ENCOUNTER_CATEGORIES, "Other").alias("encounter_category"),
            recode(code, ACUITY, 4).alias("acuity_level"),
        )
    )


# --- facts -----------------------------------------------------------------------------


def fact_encounter(encounter: DataFrame) -> DataFrame:
    owners = ("encounter", "patient", "provider", "organization")
    return encounter.select(
        *[surrogate_key(f"{o}_id").alias(f"{o}_key") for o in owners],
        *named(
            "encounter_id",
            "encounter_class_code",
            "encounter_class",
            "encounter_type_code",
            "reason_code",
            "reason_description",
            "duration_minutes",
            "is_emergency",
            "is_inpatient",
            "is_ambulatory",
            "source_system",
            start_date_key=date_key("start_datetime"),
            end_date_key=date_key("end_datetime"),
            encounter_description="encounter_type",
            start_date="start_datetime",
            end_date="end_datetime",
            base_encounter_cost=or_zero("base_cost"),
            total_claim_cost=or_zero("total_cost"),
            payer_coverage_amount=or_zero("payer_coverage"),
            patient_responsibility=or_zero("patient_responsibility"),
        ),
    )


def _clinical_keys(entity: str) -> list[Column]:
    return [
        surrogate_key(f"{o}_id").alias(f"{o}_key") for o in (entity, "patient", "encounter")
    ]


def fact_condition(condition: DataFrame, as_of: dt.date) -> DataFrame:
    open_days = days_between("onset_date", F.lit(as_of).cast("date"))
    chronic = (c("duration_days") > CHRONIC_DAYS) | (c("is_active") & (open_days > CHRONIC_DAYS))
    return condition.select(
        *_clinical_keys("condition"),
        *named(
            "condition_id",
            "condition_code",
            "code_system",
            "condition_description",
            "category_code",
            "clinical_status",
            "verification_status",
            "onset_date",
            "abatement_date",
            "duration_days",
            "is_active",
            "is_resolved",
            "source_system",
            onset_date_key=date_key("onset_date"),
            abatement_date_key=date_key("abatement_date"),
            is_chronic=or_false(chronic),
        ),
    )


def fact_medication(medication: DataFrame) -> DataFrame:
    return medication.select(
        *_clinical_keys("medication"),
        *named(
            "medication_id",
            "medication_code",
            "code_system",
            "medication_description",
            "rx_status",
            "rx_intent",
            "refills_allowed",
            "reason_description",
            "is_active",
            "source_system",
            start_date_key=date_key("prescribed_date"),
            end_date_key=date_key("end_datetime"),
            start_date="prescribed_date",
            end_date=F.to_date("end_datetime"),
        ),
        *zero_filled("base_cost", "total_cost", "payer_coverage", "patient_cost"),
    )


def fact_procedure(procedure: DataFrame) -> DataFrame:
    return procedure.select(
        *_clinical_keys("procedure"),
        *named(
            "procedure_id",
            "procedure_code",
            "code_system",
            "procedure_description",
            "procedure_status",
            "performed_date",
            "reason_code",
            "reason_description",
            "source_system",
            procedure_date_key=date_key("performed_date"),
            cost_tier=bands("procedure_cost", COST_TIERS, "Low Cost"),
        ),
        *zero_filled("procedure_cost"),
    )


RESPONSE_COLUMNS = {
    "claim_outcome": "outcome",
    "approved_amount": "benefit_amount",
    "paid_amount": "payment_amount",
    "outstanding_amount": "outstanding_amount",
    "payment_date": "payment_date",
    "adjudicated_procedure_code": "procedure_code",
    "is_complete": "is_complete",
    "is_partial": "is_partial",
}


def fact_claim(claim: DataFrame, response: DataFrame, grain: str = "response") -> DataFrame:
    """Claims with their responses.

    ``grain="response"`` gives a row per claim and response, so a claim's submitted amount
    repeats. ``grain="claim"`` first folds the responses of a claim into sums, the latest
    payment date and the lowest procedure code; it is complete only if all of them are.
    """
    claim = claim.filter(c("claim_id").isNotNull() & c("patient_id").isNotNull())
    answers = response.filter("claim_id is not null").select(
        "claim_id", *named(**RESPONSE_COLUMNS)
    )
    if grain == "claim":
        complete = F.bool_and("is_complete")
        partial = ~complete & F.bool_or(c("is_partial") | c("is_complete"))
        outcome = F.when(complete, "complete").when(partial, "partial").otherwise("queued")
        per_claim = answers.groupBy("claim_id").agg(
            outcome.alias("claim_outcome"),
            F.sum("approved_amount").alias("approved_amount"),
            F.sum("paid_amount").alias("paid_amount"),
            F.sum("outstanding_amount").alias("outstanding_amount"),
            F.max("payment_date").alias("payment_date"),
            F.min("adjudicated_procedure_code").alias("adjudicated_procedure_code"),
            complete.alias("is_complete"),
            partial.alias("is_partial"),
        )
        joined = claim.join(per_claim, "claim_id", "left")
    else:
        joined = left_join_hot_right(claim, answers, "claim_id")
    return joined.select(
        surrogate_key("claim_id").alias("claim_key"),
        surrogate_key("patient_id").alias("patient_key"),
        surrogate_key("provider_id").alias("provider_key"),
        surrogate_key("primary_coverage_id").alias("coverage_key"),
        *named(
            "claim_id",
            "claim_type_code",
            "claim_type",
            "claim_status",
            "claim_use",
            "primary_diagnosis_code",
            "secondary_diagnosis_code",
            "diagnosis_count",
            "service_date",
            "claim_outcome",
            "payment_date",
            "adjudicated_procedure_code",
            "source_system",
            service_date_key=date_key("service_date"),
            created_date_key=date_key("created_date"),
            claim_created_date="created_date",
            submitted_amount=or_zero("total_amount"),
            patient_liability=or_zero("total_amount") - or_zero("paid_amount"),
            payment_rate_pct=pct(or_zero("paid_amount"), c("total_amount")),
            is_fully_paid=or_false("is_complete"),
            is_partially_paid=or_false("is_partial"),
            has_outstanding_balance=or_zero("outstanding_amount") > 0,
        ),
        *zero_filled("approved_amount", "paid_amount", "outstanding_amount"),
    )


# --- aggregates ------------------------------------------------------------------------


def agg_patient_summary(
    patients: DataFrame,
    encounters: DataFrame,
    conditions: DataFrame,
    medications: DataFrame,
    procedures: DataFrame,
) -> DataFrame:
    """Each fact is rolled up to the patient first, so the joins are one row to one row
    and share the rollups' partitioning."""
    key = "patient_key"
    visits = encounters.groupBy(key).agg(
        F.count("*").alias("total_encounters"),
        count_where("is_emergency").alias("emergency_visits"),
        count_where("is_inpatient").alias("inpatient_stays"),
        count_where("is_ambulatory").alias("ambulatory_visits"),
        F.sum("total_claim_cost").alias("total_healthcare_cost"),
        F.sum("payer_coverage_amount").alias("total_payer_coverage"),
        F.sum("patient_responsibility").alias("total_patient_cost"),
        F.avg("total_claim_cost").alias("avg_encounter_cost"),
    )
    illnesses = conditions.groupBy(key).agg(
        F.count("*").alias("total_conditions"),
        count_where("is_active").alias("active_conditions"),
        count_where("is_chronic").alias("chronic_conditions"),
    )
    drugs = medications.groupBy(key).agg(
        F.count("*").alias("total_prescriptions"),
        count_where("is_active").alias("active_prescriptions"),
        F.sum("total_cost").alias("total_medication_cost"),
    )
    treatments = procedures.groupBy(key).agg(
        F.count("*").alias("total_procedures"),
        F.sum("procedure_cost").alias("total_procedure_cost"),
    )
    rollups = (visits, illnesses, drugs, treatments)
    measures = [m for rollup in rollups for m in rollup.columns if m != key]
    about = named(
        key,
        "patient_id",
        "age_years",
        "age_group",
        "gender",
        "race",
        "ethnicity",
        "state",
        "is_deceased",
        patient_full_name="full_name",
    )
    joined = patients.select(*about)
    for rollup in rollups:
        joined = joined.join(rollup, key, "left")
    filled = joined.withColumns({m: or_zero(m) for m in measures})
    return filled.withColumns(
        {
            "chronic_risk_level": bands("chronic_conditions", RISK_LEVELS, "Low"),
            "emergency_utilization_level": bands("emergency_visits", RISK_LEVELS, "Low"),
        }
    )


def agg_encounter_type_summary(encounters: DataFrame) -> DataFrame:
    return encounters.groupBy("encounter_class", "encounter_class_code").agg(
        F.count("*").alias("encounter_count"),
        F.count_distinct("patient_key").alias("unique_patients"),
        F.sum("total_claim_cost").alias("total_cost"),
        F.avg("total_claim_cost").alias("avg_cost"),
        F.avg("duration_minutes").alias("avg_duration_minutes"),
    )


def agg_condition_prevalence(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    """Share of all patients per condition; the patient count is a scalar subquery."""
    everyone = patients.agg(F.count("*")).scalar().cast("double")
    sick = c("unique_patients").cast("double")
    return (
        conditions.groupBy("condition_code", "condition_description")
        .agg(
            F.count("*").alias("total_occurrences"),
            F.count_distinct("patient_key").alias("unique_patients"),
            count_where("is_active").alias("active_cases"),
            count_where("is_chronic").alias("chronic_cases"),
            F.avg("duration_days").alias("avg_duration_days"),
        )
        .withColumn("prevalence_pct", F.try_divide(sick, everyone) * 100)
    )


def agg_provider_performance(providers: DataFrame, encounters: DataFrame) -> DataFrame:
    work = encounters.groupBy("provider_key").agg(
        F.count("*").alias("total_encounters"),
        F.count_distinct("patient_key").alias("unique_patients"),
        count_where("is_emergency").alias("emergency_encounters"),
        count_where("is_inpatient").alias("inpatient_encounters"),
        count_where("is_ambulatory").alias("ambulatory_encounters"),
        F.sum("total_claim_cost").alias("total_charges"),
        F.sum("payer_coverage_amount").alias("total_payer_payments"),
        F.sum("patient_responsibility").alias("total_patient_charges"),
        F.avg("total_claim_cost").alias("avg_charge_per_encounter"),
        F.avg("duration_minutes").alias("avg_encounter_duration_minutes"),
        F.min("start_date").alias("first_encounter_date"),
        F.max("start_date").alias("last_encounter_date"),
    )
    dates = ("first_encounter_date", "last_encounter_date")
    measures = [m for m in work.columns if m != "provider_key" and m not in dates]
    heads = c("unique_patients")
    return (
        providers.select(
            "provider_key", "provider_id", "provider_name", "specialty", "organization_id", "state"
        )
        .join(work, "provider_key", "left")
        .withColumns({m: or_zero(m) for m in measures})
        .withColumns(
            {
                "encounters_per_patient": per_head(c("total_encounters"), heads),
                "revenue_per_patient": per_head(c("total_charges"), heads),
                "volume_tier": bands("total_encounters", VOLUME_TIERS, "Low Volume"),
            }
        )
    )


def agg_medication_utilization(medications: DataFrame) -> DataFrame:
    return (
        medications.groupBy("medication_code", "medication_description")
        .agg(
            F.count("*").alias("total_prescriptions"),
            F.count_distinct("patient_key").alias("unique_patients"),
            count_where("is_active").alias("active_prescriptions"),
            F.sum("total_cost").alias("total_medication_cost"),
            F.sum("base_cost").alias("total_base_cost"),
            F.sum("payer_coverage").alias("total_payer_coverage"),
            F.sum("patient_cost").alias("total_patient_cost"),
            F.avg("total_cost").alias("avg_prescription_cost"),
            F.avg("patient_cost").alias("avg_patient_cost"),
            F.avg("refills_allowed").alias("avg_refills_allowed"),
            F.min("start_date").alias("first_prescription_date"),
            F.max("start_date").alias("last_prescription_date"),
        )
        .withColumns(
            {
                "payer_coverage_rate_pct": pct(
                    c("total_payer_coverage"), c("total_medication_cost")
                ),
                "utilization_tier": bands("total_prescriptions", USE_TIERS, "Low Utilization"),
            }
        )
    )


def agg_payer_statistics(payers: DataFrame, claims: DataFrame) -> DataFrame:
    billed = claims.groupBy(c("coverage_key").alias("payer_key")).agg(
        F.count("*").alias("total_claims"),
        F.count_distinct("patient_key").alias("unique_patients"),
        F.sum("submitted_amount").alias("total_submitted"),
        F.sum("approved_amount").alias("total_approved"),
        F.sum("paid_amount").alias("total_paid"),
        F.sum("outstanding_amount").alias("total_outstanding"),
        F.avg("submitted_amount").alias("avg_claim_amount"),
        F.avg("paid_amount").alias("avg_payment_amount"),
        count_where("is_fully_paid").alias("fully_paid_claims"),
        count_where("is_partially_paid").alias("partially_paid_claims"),
        count_where("has_outstanding_balance").alias("claims_with_balance"),
        F.avg(days_between("service_date", "payment_date")).alias("avg_days_to_payment"),
    )
    measures = [m for m in billed.columns if m not in ("payer_key", "avg_days_to_payment")]
    about = named(
        "payer_key",
        "payer_id",
        "payer_name",
        "ownership_type",
        "payer_tier",
        "member_count",
        "quality_of_life_score_avg",
        profile_coverage_ratio="coverage_ratio",
    )
    submitted = c("total_submitted")
    return (
        payers.select(*about)
        .join(billed, "payer_key", "left")
        .withColumns({m: or_zero(m) for m in measures})
        .withColumns(
            {
                "payment_rate_pct": pct(c("total_paid"), submitted),
                "approval_rate_pct": pct(c("total_approved"), submitted),
            }
        )
    )


def agg_financial_summary(encounters: DataFrame, dates: DataFrame) -> DataFrame:
    """Money and volume per month, over encounters inside the calendar.

    Distinct counts are made apart from the sums, each over its own distinct pairs, and the
    monthly rows are joined; one aggregate for all would repeat every encounter four times.
    """
    month = ["year", "quarter", "month"]
    placed = encounters.join(
        dates.select("date_key", *month), c("start_date_key") == c("date_key")
    )

    def unique(key: str, name: str) -> DataFrame:
        pairs = placed.select(*month, key).distinct()
        return pairs.groupBy(*month).agg(F.count(key).alias(name))

    return (
        placed.groupBy(*month)
        .agg(
            F.count("*").alias("total_encounters"),
            count_where("is_emergency").alias("emergency_encounters"),
            count_where("is_inpatient").alias("inpatient_encounters"),
            count_where("is_ambulatory").alias("ambulatory_encounters"),
            F.sum("base_encounter_cost").alias("total_base_cost"),
            F.sum("total_claim_cost").alias("total_claim_cost"),
            F.sum("payer_coverage_amount").alias("total_payer_coverage"),
            F.sum("patient_responsibility").alias("total_patient_responsibility"),
            F.avg("total_claim_cost").alias("avg_claim_cost"),
            F.avg("payer_coverage_amount").alias("avg_payer_coverage"),
            F.avg("patient_responsibility").alias("avg_patient_responsibility"),
            F.sum("duration_minutes").alias("total_duration_minutes"),
            F.avg("duration_minutes").alias("avg_duration_minutes"),
        )
        .join(unique("patient_key", "unique_patients"), month)
        .join(unique("provider_key", "unique_providers"), month)
        .join(unique("organization_key", "unique_organizations"), month)
        .withColumns(
            {
                "payer_coverage_rate_pct": pct(c("total_payer_coverage"), c("total_claim_cost")),
                "emergency_rate_pct": pct(c("emergency_encounters"), c("total_encounters")),
                "avg_encounters_per_patient": per_head(
                    c("total_encounters"), c("unique_patients")
                ),
                "year_quarter": F.concat("year", F.lit("-Q"), "quarter"),
                "year_month": F.concat_ws("-", "year", F.lpad("month", 2, "0")),
            }
        )
        .orderBy("year", "quarter", "month")
    )


def agg_readmission_rates(encounters: DataFrame, basis: str = "start_to_start") -> DataFrame:
    """Share of admissions that follow an earlier one within 30, 60 and 90 days.

    Admissions are inpatient and emergency stays. Gaps count days between calendar days,
    so all admissions of a patient on one day act alike: the first looks back to the
    patient's previous day with an admission, every other one has gap 0. Folding days
    first leaves the window at most one row per patient and calendar day, however many
    admissions one patient has.

    ``basis="start_to_start"`` measures from the previous start and leaves a patient's
    first admission out of the total. ``basis="discharge_to_admit"`` counts inpatient
    stays only, measures from the latest earlier discharge and keeps first admissions.
    """
    to_admit = basis == "discharge_to_admit"
    stays = c("is_inpatient") if to_admit else c("is_inpatient") | c("is_emergency")
    ends = F.to_date("end_date" if to_admit else "start_date")
    per_day = (
        encounters.filter(stays & c("start_date").isNotNull())
        .groupBy("patient_key", F.to_date("start_date").alias("day"))
        .agg(F.count("*").alias("stays"), F.max(ends).alias("left_on"))
    )
    past = (
        Window.partitionBy("patient_key")
        .orderBy("day")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    gap = days_between(F.max("left_on").over(past), "day")
    if to_admit:
        # Stays that begin on one day do not follow each other's discharge.
        looked = per_day.select(
            "patient_key",
            "day",
            F.when(gap < 0, 0).otherwise(gap).alias("gap"),
            "stays",
            c("stays").alias("looking"),
            F.lit(0).alias("same_day"),
        )
    else:
        looked = per_day.select("patient_key", "day", gap.alias("gap"), "stays").select(
            "*",
            F.when(c("gap").isNull(), 0).otherwise(1).alias("looking"),
            (c("stays") - 1).alias("same_day"),
        )
    total = c("stays") if to_admit else c("looking") + c("same_day")

    def within(limit: int) -> Column:
        return F.when(c("gap") <= limit, c("looking")).otherwise(0) + c("same_day")

    def mean_gap(limit: int) -> Column:
        gaps = F.sum(F.when(c("gap") <= limit, c("gap") * c("looking")))
        return F.try_divide(or_zero(gaps).cast("double"), F.sum(within(limit)))

    counted = looked.withColumn("admissions", total).filter(c("admissions") > 0)
    first, last = READMISSION_DAYS[0], READMISSION_DAYS[-1]
    return (
        counted.groupBy(
            F.year("day").alias("year"),
            F.quarter("day").alias("quarter"),
            F.month("day").alias("month"),
        )
        .agg(
            F.sum("admissions").alias("total_admissions"),
            F.count_distinct("patient_key").alias("unique_patients"),
            *[F.sum(within(d)).alias(f"readmissions_{d}_day") for d in READMISSION_DAYS],
            *[mean_gap(d).alias(f"avg_days_to_{d}_day_readmit") for d in (first, last)],
        )
        .withColumns(
            {
                f"readmission_rate_{d}_day_pct": pct(
                    c(f"readmissions_{d}_day"), c("total_admissions")
                )
                for d in READMISSION_DAYS
            }
        )
        .orderBy("year", "quarter", "month")
    )


# --- what is built from what -----------------------------------------------------------

# Kind, builder and inputs of each table, in build order. Inputs are cleaned entities,
# earlier tables of this list, or the as-of date.
TABLES: dict[str, tuple[str, Callable[..., DataFrame], Sequence[str]]] = {
    "dim_date": ("dimension", dim_date_of_encounters, ("encounter",)),
    "dim_patient": ("dimension", dim_patient, ("patient",)),
    "dim_provider": ("dimension", dim_provider, ("practitioner",)),
    "dim_organization": ("dimension", dim_organization, ("organization",)),
    "dim_payer": ("dimension", dim_payer, ("payer",)),
    "dim_encounter_type": ("dimension", dim_encounter_type, ("encounter",)),
    "fact_encounter": ("fact", fact_encounter, ("encounter",)),
    "fact_condition": ("fact", fact_condition, ("condition", "as_of")),
    "fact_medication": ("fact", fact_medication, ("medication",)),
    "fact_procedure": ("fact", fact_procedure, ("procedure",)),
    "fact_claim": ("fact", fact_claim, ("claim", "claimresponse")),
    "agg_patient_summary": (
        "aggregate",
        agg_patient_summary,
        (
            "dim_patient",
            "fact_encounter",
            "fact_condition",
            "fact_medication",
            "fact_procedure",
        ),
    ),
    "agg_encounter_type_summary": (
        "aggregate",
        agg_encounter_type_summary,
        ("fact_encounter",),
    ),
    "agg_condition_prevalence": (
        "aggregate",
        agg_condition_prevalence,
        ("fact_condition", "dim_patient"),
    ),
    "agg_provider_performance": (
        "aggregate",
        agg_provider_performance,
        ("dim_provider", "fact_encounter"),
    ),
    "agg_medication_utilization": (
        "aggregate",
        agg_medication_utilization,
        ("fact_medication",),
    ),
    "agg_payer_statistics": ("aggregate", agg_payer_statistics, ("dim_payer", "fact_claim")),
    "agg_financial_summary": (
        "aggregate",
        agg_financial_summary,
        ("fact_encounter", "dim_date"),
    ),
    "agg_readmission_rates": ("aggregate", agg_readmission_rates, ("fact_encounter",)),
}
