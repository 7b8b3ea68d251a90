"""The cleaned layer: 18 typed tables, each declared as a ``Spec``.

A spec groups output columns by conversion (text, date, timestamp, double, money, count),
adds hashed ids and constants, and lists derived columns, which may use everything typed
before. Names starting with ``_`` are inputs only. All specs are stateless projections,
so they also apply to streaming frames; lookups are left joins added around them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions import casts
from vitalmart.functions.codes import ndc9
from vitalmart.functions.keys import hashed
from vitalmart.functions.measures import (
    days_between,
    filled_slots,
    minutes_between,
    open_or,
    or_zero,
    recode,
    whole_years,
)
from vitalmart.sources.tables import typed_nulls

Derived = Callable[[Column], Column]  # takes the as-of date


@dataclass(frozen=True)
class Spec:
    raw: str
    required: tuple[str, ...]
    ids: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    text: Mapping[str, str] = field(default_factory=dict)
    date: Mapping[str, str] = field(default_factory=dict)
    timestamp: Mapping[str, str] = field(default_factory=dict)
    double: Mapping[str, str] = field(default_factory=dict)
    money: Mapping[str, str] = field(default_factory=dict)
    count: Mapping[str, str] = field(default_factory=dict)
    constant: Mapping[str, object] = field(default_factory=dict)
    derived: Mapping[str, Derived] = field(default_factory=dict)
    with_state: bool = False


CONVERSIONS = {
    "text": lambda value: value,
    "date": casts.as_date,
    "timestamp": casts.as_timestamp,
    "double": casts.as_double,
    "money": casts.as_decimal,
    "count": casts.as_long,
}


def shape(
    raw: DataFrame,
    spec: Spec,
    as_of: dt.date,
    dates_from_timestamps: bool = False,
    match: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Apply a spec to its raw table.

    Rows missing a required key are filtered on the raw column, where the filter can
    reach the scan. ``dates_from_timestamps`` also accepts timestamp text for dates.
    ``match`` joins lookups to the converted columns; what it adds comes last. Digests,
    constants and derived columns are made after it, so a join does not shuffle them. Nor does
    it both a text that a digest reads and what is converted from that text.
    """
    convert = dict(CONVERSIONS)
    if dates_from_timestamps:
        convert["date"] = lambda value: casts.as_date(value, accept_timestamp=True)
    source_of = {
        out: (convert[kind], source)
        for kind in CONVERSIONS
        for out, source in getattr(spec, kind).items()
    }
    # Digests read raw columns; those that are kept as text go by their new name.
    text_of = {source: out for out, source in spec.text.items()}
    parts = {p: text_of.get(p, f"_raw_{p}") for names in spec.ids.values() for p in names}
    raw_of = {p: out for p, out in parts.items() if out not in source_of}
    typed = {out: to(F.col(source)) for out, (to, source) in source_of.items() if source not in raw_of}
    carried = {out: F.col(p) for p, out in raw_of.items()}
    carried["source_system"] = F.col("_rec_src")
    if spec.with_state:
        carried["source_state"] = F.col("_state")

    present = raw.filter(" AND ".join(f"{spec.text[k]} IS NOT NULL" for k in spec.required))
    # Texts come last: rows whose fixed-width columns lie together compress better in a shuffle.
    typed = dict(sorted(typed.items(), key=lambda item: item[0] in spec.text))
    converted = present.select(*[column.alias(out) for out, column in {**typed, **carried}.items()])
    met = match(converted) if match else converted
    added = met.columns[len(converted.columns) :]

    made = {
        out: F.col(out) if out in typed else to(F.col(raw_of[source]))
        for out, (to, source) in source_of.items()
    }
    made |= {out: hashed(*[parts[p] for p in names]) for out, names in spec.ids.items()}
    made |= {out: F.lit(value) for out, value in spec.constant.items()}
    made |= {out: F.col(out) for out in carried if not out.startswith("_")}
    shaped = met.select(*[column.alias(out) for out, column in made.items()], *added)
    if not spec.derived:
        return shaped
    # One select: a derived column may use the ones before it as lateral aliases.
    today = F.lit(as_of).cast("date")
    shown = [out for out in made if not out.startswith("_")]
    derived = [rule(today).alias(out) for out, rule in spec.derived.items()]
    return shaped.select(*shown, *derived, *added)


def _is(column: str, value: str) -> Derived:
    return lambda today: F.col(column) == value


def _copy(column: str) -> Derived:
    return lambda today: F.col(column)


def _closed_as(closed: str) -> Derived:
    return lambda today: open_or(closed, "_stop")


def _lower_or(column: str, default: str) -> Derived:
    return lambda today: F.coalesce(F.lower(column), F.lit(default))


def _lowered(column: str) -> Column:
    return F.lower(F.col(column))


def _either_severe(today: Column) -> Column:
    severe = (_lowered("_severity1") == "severe") | (_lowered("_severity2") == "severe")
    return F.when(severe, "high").otherwise("low")


def _claim_outcome(today: Column) -> Column:
    settled = or_zero("outstanding_amount") == 0
    return (
        F.when(settled, "complete")
        .when(or_zero("payment_amount") > 0, "partial")
        .otherwise("queued")
    )


# Class codes, status names and code systems.
CLASS_CODES = {"inpatient": "IMP", "emergency": "EMER"}
AMBULATORY_CLASSES = ("ambulatory", "outpatient", "wellness", "urgentcare")
MARITAL_STATUS = {"M": "Married", "S": "Never Married", "D": "Divorced", "W": "Widowed"}
RELATIONSHIPS = {"self": "self", "spouse": "spouse", "guardian": "parent"}
RELATIONSHIP_NAMES = {"self": "Self", "spouse": "Spouse", "parent": "Parent"}
SNOMED_SYSTEM = "http://snomed.info/sct"
LOINC_SYSTEM = "http://loinc.org"
RXNORM_SYSTEM = "http://www.nlm.nih.gov/research/umls/rxnorm"
VACCINE_SYSTEM = "http://hl7.org/fhir/sid/cvx"

_ADDRESS = {"address_line": "ADDRESS", "city": "CITY", "state": "STATE", "postal_code": "ZIP"}
_EVENT = {"patient_id": "PATIENT", "encounter_id": "ENCOUNTER"}
_REASON = {"reason_code": "REASONCODE", "reason_description": "REASONDESCRIPTION"}
_PLACE = {"latitude": "LAT", "longitude": "LON"}
_COUNTERS = {
    f"{side}_{what}": f"{side}_{what}".upper()
    for what in ("encounters", "medications", "procedures", "immunizations")
    for side in ("covered", "uncovered")
}

SPECS: dict[str, Spec] = {
    "patient": Spec(
        raw="patients",
        required=("patient_id",),
        text={
            "patient_id": "Id",
            "first_name": "FIRST",
            "middle_name": "MIDDLE",
            "last_name": "LAST",
            "name_prefix": "PREFIX",
            "name_suffix": "SUFFIX",
            **_ADDRESS,
            "county": "COUNTY",
            "marital_status_code": "MARITAL",
            "medical_record_number": "Id",
            "ssn_last_four": "SSN",
            "_gender": "GENDER",
            "_race": "RACE",
            "_ethnicity": "ETHNICITY",
        },
        date={"birth_date": "BIRTHDATE", "death_date": "DEATHDATE"},
        double={
            **_PLACE,
            "healthcare_expenses": "HEALTHCARE_EXPENSES",
            "healthcare_coverage": "HEALTHCARE_COVERAGE",
            "income": "INCOME",
        },
        constant={"country": "US"},
        derived={
            "gender": lambda today: _lowered("_gender"),
            "is_deceased": lambda today: F.col("death_date").isNotNull(),
            "age_years": lambda today: whole_years(
                F.col("birth_date"), F.coalesce("death_date", today)
            ),
            "marital_status": lambda today: recode("marital_status_code", MARITAL_STATUS),
            "race": lambda today: F.initcap("_race"),
            "ethnicity": lambda today: recode(
                "_ethnicity", {"hispanic": "Hispanic or Latino"}, "Not Hispanic or Latino"
            ),
        },
        with_state=True,
    ),
    "encounter": Spec(
        raw="encounters",
        required=("encounter_id", "patient_id"),
        text={
            "encounter_id": "Id",
            "patient_id": "PATIENT",
            "provider_id": "PROVIDER",
            "organization_id": "ORGANIZATION",
            "payer_id": "PAYER",
            "encounter_class": "ENCOUNTERCLASS",
            "encounter_type_code": "CODE",
            "encounter_type": "DESCRIPTION",
            **_REASON,
        },
        timestamp={"start_datetime": "START", "end_datetime": "STOP"},
        money={
            "base_cost": "BASE_ENCOUNTER_COST",
            "total_cost": "TOTAL_CLAIM_COST",
            "payer_coverage": "PAYER_COVERAGE",
        },
        constant={"encounter_status": "finished"},
        derived={
            "encounter_class_code": lambda today: recode(
                _lowered("encounter_class"), CLASS_CODES, "AMB"
            ),
            "duration_minutes": lambda today: minutes_between("start_datetime", "end_datetime"),
            "patient_responsibility": lambda today: (
                or_zero("total_cost") - or_zero("payer_coverage")
            ),
            "is_emergency": lambda today: _lowered("encounter_class") == "emergency",
            "is_inpatient": lambda today: _lowered("encounter_class") == "inpatient",
            "is_ambulatory": lambda today: _lowered("encounter_class").isin(*AMBULATORY_CLASSES),
        },
        with_state=True,
    ),
    "condition": Spec(
        raw="conditions",
        required=("patient_id", "condition_code"),
        ids={"condition_id": ("PATIENT", "CODE", "START")},
        text={
            **_EVENT,
            "condition_code": "CODE",
            "condition_description": "DESCRIPTION",
            "_stop": "STOP",
        },
        date={"onset_date": "START", "abatement_date": "STOP"},
        constant={
            "code_system": SNOMED_SYSTEM,
            "category_code": "encounter-diagnosis",
            "category_display": "Encounter Diagnosis",
            "verification_status": "confirmed",
        },
        derived={
            "clinical_status": _closed_as("resolved"),
            "recorded_date": _copy("onset_date"),
            "duration_days": lambda today: days_between("onset_date", "abatement_date"),
            "is_active": _is("clinical_status", "active"),
            "is_resolved": _is("clinical_status", "resolved"),
        },
    ),
    "observation": Spec(
        raw="observations",
        required=("patient_id", "observation_code"),
        ids={"observation_id": ("PATIENT", "CODE", "DATE", "ENCOUNTER")},
        text={
            **_EVENT,
            "observation_code": "CODE",
            "observation_description": "DESCRIPTION",
            "value_unit": "UNITS",
            "unit_code": "UNITS",
            "_value": "VALUE",
            "_category": "CATEGORY",
        },
        timestamp={"effective_datetime": "DATE"},
        constant={"code_system": LOINC_SYSTEM, "observation_status": "final"},
        derived={
            "category_code": _lower_or("_category", "laboratory"),
            "category_display": lambda today: F.coalesce(
                F.initcap("_category"), F.lit("Laboratory")
            ),
            "effective_date": lambda today: F.to_date("effective_datetime"),
            "numeric_value": lambda today: casts.measured_number(F.col("_value")),
            "string_value": lambda today: casts.measured_text(F.col("_value")),
            "display_value": lambda today: F.coalesce(
                F.concat(F.col("numeric_value").cast("string"), F.lit(" "), F.col("value_unit")),
                F.col("string_value"),
            ),
            "is_vital_sign": lambda today: _lowered("_category") == "vital-signs",
            "is_lab_result": lambda today: _lowered("_category") == "laboratory",
            "is_survey": lambda today: _lowered("_category") == "survey",
        },
    ),
    "procedure": Spec(
        raw="procedures",
        required=("patient_id", "procedure_code"),
        ids={"procedure_id": ("PATIENT", "CODE", "START", "ENCOUNTER")},
        text={
            **_EVENT,
            "procedure_code": "CODE",
            "procedure_description": "DESCRIPTION",
            **_REASON,
        },
        timestamp={"start_datetime": "START", "end_datetime": "STOP"},
        money={"procedure_cost": "BASE_COST"},
        constant={"code_system": SNOMED_SYSTEM, "procedure_status": "completed"},
        derived={"performed_date": lambda today: F.to_date("start_datetime")},
    ),
    "medication": Spec(
        raw="medications",
        required=("patient_id", "medication_code"),
        ids={"medication_id": ("PATIENT", "CODE", "START")},
        text={
            **_EVENT,
            "payer_id": "PAYER",
            "medication_code": "CODE",
            "medication_description": "DESCRIPTION",
            "reason_description": "REASONDESCRIPTION",
            "_stop": "STOP",
        },
        timestamp={"start_datetime": "START", "end_datetime": "STOP"},
        money={
            "base_cost": "BASE_COST",
            "total_cost": "TOTALCOST",
            "payer_coverage": "PAYER_COVERAGE",
        },
        count={"_dispenses": "DISPENSES"},
        constant={"code_system": RXNORM_SYSTEM, "rx_intent": "order"},
        derived={
            "rx_status": _closed_as("completed"),
            "prescribed_date": lambda today: F.to_date("start_datetime"),
            "refills_allowed": lambda today: F.coalesce("_dispenses", F.lit(1)) - 1,
            "patient_cost": lambda today: or_zero("total_cost") - or_zero("payer_coverage"),
            "is_active": lambda today: F.col("end_datetime").isNull(),
        },
    ),
    "organization": Spec(
        raw="organizations",
        required=("organization_id",),
        text={"organization_id": "Id", "name": "NAME", **_ADDRESS, "phone": "PHONE"},
        double=_PLACE,
        money={"revenue": "REVENUE"},
        count={"utilization": "UTILIZATION"},
        constant={
            "active": True,
            "type_code": "prov",
            "type_display": "Healthcare Provider",
            "country": "US",
        },
    ),
    "practitioner": Spec(
        raw="providers",
        required=("practitioner_id",),
        text={
            "practitioner_id": "Id",
            "organization_id": "ORGANIZATION",
            "name": "NAME",
            "specialty": "SPECIALITY",
            "specialty_code": "SPECIALITY",
            **_ADDRESS,
            "_gender": "GENDER",
        },
        double=_PLACE,
        count={"encounter_count": "ENCOUNTERS", "procedure_count": "PROCEDURES"},
        constant={"active": True, "country": "US"},
        derived={"gender": lambda today: _lowered("_gender")},
    ),
    "payer": Spec(
        raw="payers",
        required=("payer_id",),
        text={
            "payer_id": "Id",
            "payer_name": "NAME",
            "ownership_type": "OWNERSHIP",
            "phone": "PHONE",
            "city": "CITY",
            "state": "STATE_HEADQUARTERED",
            "postal_code": "ZIP",
            "_quality": "QOLS_AVG",
        },
        money={
            "amount_covered": "AMOUNT_COVERED",
            "amount_uncovered": "AMOUNT_UNCOVERED",
            "revenue": "REVENUE",
        },
        count={
            **_COUNTERS,
            "unique_customers": "UNIQUE_CUSTOMERS",
            "member_months": "MEMBER_MONTHS",
        },
        constant={"is_active": True},
        derived={
            "quality_of_life_score_avg": lambda today: casts.as_decimal(F.col("_quality"), 10, 2),
            "coverage_ratio": lambda today: F.try_divide(
                F.col("amount_covered").cast("double"),
                (F.col("amount_covered") + F.col("amount_uncovered")).cast("double"),
            ),
        },
    ),
    "allergy": Spec(
        raw="allergies",
        required=("patient_id", "allergy_code"),
        ids={"allergy_id": ("PATIENT", "CODE", "START")},
        text={
            **_EVENT,
            "allergy_code": "CODE",
            "allergy_description": "DESCRIPTION",
            "primary_reaction_code": "REACTION1",
            "primary_reaction": "DESCRIPTION1",
            "_system": "SYSTEM",
            "_type": "TYPE",
            "_category": "CATEGORY",
            "_severity1": "SEVERITY1",
            "_severity2": "SEVERITY2",
            "_stop": "STOP",
        },
        date={"onset_date": "START", "resolution_date": "STOP"},
        constant={"verification_status": "confirmed"},
        derived={
            "code_system": lambda today: F.coalesce("_system", F.lit(SNOMED_SYSTEM)),
            "clinical_status": _closed_as("resolved"),
            "allergy_type": _lower_or("_type", "allergy"),
            "category": _lower_or("_category", "environment"),
            "criticality": _either_severe,
            "recorded_date": _copy("onset_date"),
            "reaction_severity": lambda today: recode(
                _lowered("_severity1"), {"severe": "severe", "moderate": "moderate"}, "mild"
            ),
            "is_active": _is("clinical_status", "active"),
            "is_high_criticality": _is("criticality", "high"),
        },
    ),
    "careplan": Spec(
        raw="careplans",
        required=("careplan_id", "patient_id"),
        text={
            "careplan_id": "Id",
            **_EVENT,
            "careplan_code": "CODE",
            "careplan_description": "DESCRIPTION",
            **_REASON,
            "_stop": "STOP",
        },
        date={"start_date": "START", "end_date": "STOP"},
        constant={"careplan_intent": "order"},
        derived={
            "careplan_status": _closed_as("completed"),
            "duration_days": lambda today: days_between(
                "start_date", F.coalesce("end_date", today)
            ),
            "activity_status": lambda today: F.when(
                F.col("end_date").isNull(), "in-progress"
            ).otherwise("completed"),
            "is_active": _is("careplan_status", "active"),
        },
    ),
    "device": Spec(
        raw="devices",
        required=("patient_id",),
        text={
            **_EVENT,
            "udi": "UDI",
            "device_code": "CODE",
            "device_description": "DESCRIPTION",
            "device_name": "DESCRIPTION",
            "_start": "START",
            "_stop": "STOP",
        },
        date={"association_start": "START", "association_end": "STOP"},
        derived={
            # Absent parts are left out of this digest, not read as empty.
            "device_id": lambda today: F.coalesce(
                "udi", F.sha2(F.concat_ws("|", "patient_id", "device_code", "_start"), 256)
            ),
            "device_status": _closed_as("inactive"),
            "is_active": _is("device_status", "active"),
            "has_udi": lambda today: F.col("udi").isNotNull(),
        },
    ),
    "imagingstudy": Spec(
        raw="imaging_studies",
        required=("study_id", "patient_id"),
        text={
            "study_id": "Id",
            **_EVENT,
            **{
                name: name.upper()
                for name in (
                    "series_uid",
                    "modality_code",
                    "modality_description",
                    "bodysite_code",
                    "bodysite_description",
                    "instance_uid",
                    "sop_code",
                    "sop_description",
                    "procedure_code",
                )
            },
        },
        date={"study_date": "DATE"},
        constant={"study_status": "available"},
    ),
    "immunization": Spec(
        raw="immunizations",
        required=("patient_id", "vaccine_code"),
        ids={"immunization_id": ("PATIENT", "CODE", "DATE")},
        text={**_EVENT, "vaccine_code": "CODE", "vaccine_description": "DESCRIPTION"},
        date={"administration_date": "DATE", "recorded_date": "DATE"},
        money={"cost": "BASE_COST"},
        constant={
            "code_system": VACCINE_SYSTEM,
            "immunization_status": "completed",
            "is_primary_source": True,
        },
    ),
    "supply": Spec(
        raw="supplies",
        required=("patient_id", "supply_code"),
        ids={"supply_id": ("PATIENT", "CODE", "DATE", "ENCOUNTER")},
        text={**_EVENT, "supply_code": "CODE", "supply_description": "DESCRIPTION"},
        date={"delivery_date": "DATE"},
        count={"_quantity": "QUANTITY"},
        constant={
            "unit": "unit",
            "delivery_status": "completed",
            "supply_type_code": "device",
            "supply_type": "Device",
        },
        derived={
            "quantity": lambda today: F.coalesce("_quantity", F.lit(1)),
            "has_encounter": lambda today: F.col("encounter_id").isNotNull(),
        },
    ),
    "claim": Spec(
        raw="claims",
        required=("claim_id", "patient_id"),
        text={
            "claim_id": "Id",
            "patient_id": "PATIENTID",
            "provider_id": "PROVIDERID",
            "primary_coverage_id": "PRIMARYPATIENTINSURANCEID",
            "secondary_coverage_id": "SECONDARYPATIENTINSURANCEID",
            "primary_diagnosis_code": "DIAGNOSIS1",
            "secondary_diagnosis_code": "DIAGNOSIS2",
            "encounter_id": "APPOINTMENTID",
            **{f"_diagnosis{i}": f"DIAGNOSIS{i}" for i in range(1, 9)},
        },
        date={"_service": "SERVICEDATE", "_illness": "CURRENTILLNESSDATE"},
        money={"_outstanding1": "OUTSTANDING1", "_outstanding2": "OUTSTANDING2"},
        constant={
            "claim_type_code": "professional",
            "claim_type": "Professional",
            "claim_status": "active",
            "claim_use": "claim",
        },
        derived={
            "service_date": lambda today: F.coalesce("_service", "_illness"),
            "created_date": _copy("service_date"),
            "diagnosis_count": lambda today: filled_slots(
                [f"_diagnosis{i}" for i in range(1, 9)]
            ),
            "total_amount": lambda today: or_zero("_outstanding1") + or_zero("_outstanding2"),
        },
    ),
    "claimresponse": Spec(
        raw="claims_transactions",
        required=("claimresponse_id", "claim_id"),
        text={
            "claimresponse_id": "ID",
            "claim_id": "CLAIMID",
            "patient_id": "PATIENTID",
            "procedure_code": "PROCEDURECODE",
        },
        date={"created_date": "FROMDATE", "payment_date": "TODATE"},
        money={
            "submitted_amount": "AMOUNT",
            "payment_amount": "PAYMENTS",
            "benefit_amount": "PAYMENTS",
            "outstanding_amount": "OUTSTANDING",
        },
        constant={"response_status": "active"},
        derived={
            "outcome": _claim_outcome,
            "is_complete": _is("outcome", "complete"),
            "is_partial": _is("outcome", "partial"),
        },
    ),
    "coverage": Spec(
        raw="payer_transitions",
        required=("patient_id", "payer_id"),
        ids={"coverage_id": ("PATIENT", "PAYER", "START_DATE")},
        text={
            "patient_id": "PATIENT",
            "payer_id": "PAYER",
            "payer_name": "PAYER",
            "member_id": "MEMBERID",
            "owner_name": "OWNER_NAME",
            "_ownership": "PLAN_OWNERSHIP",
        },
        date={"start_date": "START_DATE", "end_date": "END_DATE"},
        constant={"coverage_type_code": "EHCPOL", "coverage_type": "Extended healthcare"},
        derived={
            "coverage_status": lambda today: F.when(
                F.coalesce("end_date", today) >= today, "active"
            ).otherwise("cancelled"),
            "coverage_duration_days": lambda today: days_between(
                "start_date", F.coalesce("end_date", today)
            ),
            "relationship_code": lambda today: recode(
                _lowered("_ownership"), RELATIONSHIPS, "self"
            ),
            "relationship": lambda today: recode("relationship_code", RELATIONSHIP_NAMES, "Self"),
            "is_active": _is("coverage_status", "active"),
        },
    ),
}

# Output table of each cleaned entity.
TABLE_NAMES = {entity: f"v_{entity}_flattened" for entity in SPECS}


# --- lookup enrichment -----------------------------------------------------------------


def enrich(
    facts: DataFrame, lookup: DataFrame | None, on: str, key: str, take: Mapping[str, str]
) -> DataFrame:
    """Left join one lookup by a fact's code, adding ``take`` (output name: lookup column).

    Without a lookup the columns are typed NULLs. No broadcast hint is given: Spark
    broadcasts the lookup when its measured size allows, and otherwise the fact side,
    being preserved, is the one adaptive execution splits when a code is very frequent.
    """
    if lookup is None:
        return facts.select("*", *typed_nulls(take))
    side = lookup.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_code"), *[F.col(c).alias(out) for out, c in take.items()]
    )
    return facts.join(side, facts[on] == side["_code"], "left").drop("_code")


def _lookup(lookup: DataFrame | None, *how) -> Callable[[DataFrame], DataFrame]:
    return lambda facts: enrich(facts, lookup, *how)


def condition(raw, as_of, snomed_map: DataFrame | None = None) -> DataFrame:
    """``snomed_map`` should hold one row per concept (the simple view); with the full
    map, a condition appears once per mapped code."""
    take = {"icd10cm_code": "icd10cm_code", "icd10cm_name": "icd10cm_name"}
    match = _lookup(snomed_map, "condition_code", "snomed_concept_id", take)
    return shape(raw, SPECS["condition"], as_of, match=match)


def condition_targets(raw, as_of, snomed_map: DataFrame) -> DataFrame:
    """How often each condition meets each of its mapped codes under the full map.

    Conditions are counted per code, and map rows per code and target, before they meet; the
    counts multiply. No row stands for one condition and one target.
    """
    found = shape(raw, SPECS["condition"], as_of).groupBy("condition_code")
    found = found.agg(F.count("*").alias("_conditions"))
    targets = snomed_map.filter("snomed_concept_id is not null").groupBy(
        F.col("snomed_concept_id").alias("condition_code"), "icd10cm_code"
    )
    targets = targets.agg(F.count("*").alias("_rows"))
    times = F.col("_conditions") * F.coalesce("_rows", F.lit(1))
    return found.join(targets, "condition_code", "left").select(
        "condition_code", "icd10cm_code", times.alias("occurrences")
    )


def _active(lookup: DataFrame | None) -> DataFrame | None:
    return None if lookup is None else lookup.filter("is_active")


# What procedures take of their code's lookup row.
PROCEDURE_CODES = {
    "hcpcs_code": "hcpcs_code",
    "hcpcs_description": "short_description",
    "hcpcs_code_type": "code_type",
    "betos_code": "betos_code",
}


def with_procedure_codes(facts: DataFrame, hcpcs: DataFrame | None) -> DataFrame:
    return enrich(facts, _active(hcpcs), "procedure_code", "hcpcs_code", PROCEDURE_CODES)


def lists_codes_once(hcpcs: DataFrame) -> bool:
    """Whether a procedure meets one active lookup row at most; this counts them in a job."""
    listed = _active(hcpcs).filter(F.col("hcpcs_code").isNotNull()).groupBy("hcpcs_code")
    return listed.agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1).isEmpty()


def procedure(raw, as_of, hcpcs: DataFrame | None = None) -> DataFrame:
    match = lambda facts: with_procedure_codes(facts, hcpcs)
    return shape(raw, SPECS["procedure"], as_of, match=match)


def medication(
    raw,
    as_of,
    concepts: DataFrame | None = None,
    crosswalk: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Drug names, one package code per drug (the lowest) and that package's product.

    The crosswalk has 11-digit package codes and the product file dashed product codes,
    so both meet on the 9 labeler and product digits. Packages and products meet first, a row
    per drug, so that prescriptions are shuffled by drug only. Both have one row a key, which
    lets Spark leave out their joins where nothing of them is read.
    """
    names = {"rxnorm_name": "rxnorm_name", "rxnorm_term_type": "tty"}
    about = {
        "ndc_proprietary_name": "proprietary_name",
        "ndc_nonproprietary_name": "nonproprietary_name",
        "dosage_form": "dosage_form_name",
        "route": "route_name",
        "manufacturer": "labeler_name",
    }
    drugs = None
    if crosswalk is not None:
        lowest = F.min("ndc_11_digit").alias("ndc_code")
        drugs = crosswalk.filter("rxcui is not null").groupBy("rxcui").agg(lowest)
        one_product = None
        if products is not None:
            kept = list(about.values())
            first = F.min(F.struct("product_id", *kept)).alias("first")
            keyed = products.withColumn("product_key", ndc9(F.col("product_ndc")))
            one_product = keyed.groupBy("product_key").agg(first)
            one_product = one_product.select("product_key", *[f"first.{name}" for name in kept])
        drugs = drugs.withColumn("_product_key", F.substring("ndc_code", 1, 9))
        drugs = enrich(drugs, one_product, "_product_key", "product_key", about).drop("_product_key")
    def match(facts: DataFrame) -> DataFrame:
        named = enrich(facts, concepts, "medication_code", "rxcui", names)
        have = {out: out for out in ("ndc_code", *about)}
        return enrich(named, drugs, "medication_code", "rxcui", have)

    return shape(raw, SPECS["medication"], as_of, match=match)


def allergy(raw, as_of, concepts: DataFrame | None = None) -> DataFrame:
    take = {"rxnorm_name": "rxnorm_name", "rxnorm_term_type": "tty"}
    return shape(raw, SPECS["allergy"], as_of, match=_lookup(concepts, "allergy_code", "rxcui", take))


def claim(raw, as_of, icd: DataFrame | None = None) -> DataFrame:
    shaped = shape(raw, SPECS["claim"], as_of)
    for slot in ("primary", "secondary"):
        take = {f"{slot}_diagnosis_desc": "short_description"}
        shaped = enrich(shaped, icd, f"{slot}_diagnosis_code", "icd10cm_code", take)
    return shaped


def claimresponse(raw, as_of, hcpcs: DataFrame | None = None) -> DataFrame:
    take = {"procedure_description": "short_description", "procedure_code_type": "code_type"}
    match = _lookup(_active(hcpcs), "procedure_code", "hcpcs_code", take)
    return shape(raw, SPECS["claimresponse"], as_of, match=match)


# Entities with lookups: builder and the lookup tables it takes, in argument order.
ENRICHED: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "condition": (condition, ("v_snomed_icd10cm_simple",)),
    "procedure": (procedure, ("lookup_hcpcs_codes",)),
    "medication": (
        medication,
        ("lookup_rxnorm_concepts", "lookup_rxnorm_ndc_crosswalk", "lookup_ndc_product"),
    ),
    "allergy": (allergy, ("lookup_rxnorm_concepts",)),
    "claim": (claim, ("lookup_icd10cm_codes",)),
    "claimresponse": (claimresponse, ("lookup_hcpcs_codes",)),
}


def build(
    entity: str,
    raw: DataFrame,
    as_of: dt.date,
    lookup: Callable[[str], DataFrame | None] = lambda name: None,
) -> DataFrame:
    """One cleaned table; ``lookup`` finds lookup tables by name, None where absent."""
    if entity in ENRICHED:
        builder, needs = ENRICHED[entity]
        return builder(raw, as_of, *[lookup(name) for name in needs])
    return shape(raw, SPECS[entity], as_of)
