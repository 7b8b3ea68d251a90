"""Medicare-claims-shaped mart: beneficiaries, providers, four claim facts, yearly costs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.keys import date_key, surrogate_key
from vitalmart.functions.measures import days_between, or_zero, recode
from vitalmart.operators.rows import first_n_as_columns, left_join_hot_right, numbered
from vitalmart.plans import cleaned
from vitalmart.plans.star import named
from vitalmart.sources.tables import typed_nulls

c = F.col

# Concept codes of each chronic condition and its flag column.
CHRONIC_CODES: dict[str, tuple[str, ...]] = {
    "alzheimers": ("26929004", "230270009", "12348006", "421529006"),
    "chf": ("42343007", "407596008", "194767001", "194779001"),
    "ckd": ("709044004", "46177005", "236425005", "236426006"),
    "cancer": ("363346000", "93870000", "109838007", "254837009"),
    "copd": ("13645005", "185086009", "68328006"),
    "depression": ("35489007", "370143000", "33078009", "192080009"),
    "diabetes": ("44054006", "73211009", "46635009", "11530004"),
    "ihd": ("414545008", "413439005", "194828000", "233838004"),
    "osteoporosis": ("64859006", "203438003", "240165008"),
    "ra_oa": ("69896004", "239873007", "396275006", "201834006"),
    "stroke": ("230690007", "422504002", "195189005", "230706003"),
    "esrd": ("90688005", "236435004", "236436003"),
}
FLAG_COLUMNS = {
    "alzheimers": "sp_alzhdmta",
    "chf": "sp_chf",
    "ckd": "sp_chrnkidn",
    "cancer": "sp_cncr",
    "copd": "sp_copd",
    "depression": "sp_depressn",
    "diabetes": "sp_diabetes",
    "ihd": "sp_ischmcht",
    "osteoporosis": "sp_osteoprs",
    "ra_oa": "sp_ra_oa",
    "stroke": "sp_strketia",
}
# Codes of sex and race, and the encounter classes of each kind of claim.
SEX_CODES = {"m": 1, "male": 1, "f": 2, "female": 2}
RACE_CODES = {"white": 1, "black": 2, "african american": 2, "asian": 4}
HISPANIC_RACE, OTHER_RACE = 5, 3
HISPANIC_NAMES = ("hispanic", "latino", "hispanic or latino")
INPATIENT_CLASSES = ("inpatient",)
OUTPATIENT_CLASSES = ("ambulatory", "outpatient", "emergency", "urgentcare")
CARRIER_CLASSES = ("wellness", "outpatient")
DIAGNOSIS_SLOTS, PROCEDURE_SLOTS = 10, 6
DEFAULT_SUPPLY_DAYS = 30

MONEY = "decimal(18,2)"
# Yearly costs, as reimbursement, beneficiary and primary payer share per claim kind.
COSTS = [
    "medreimb_ip", "benres_ip", "pppymt_ip",
    "medreimb_op", "benres_op", "pppymt_op",
    "medreimb_car", "benres_car", "pppymt_car",
]


def dollars(column: str) -> Column:
    return or_zero(column).cast(MONEY)


def in_class(encounter: DataFrame, classes: Sequence[str]) -> DataFrame:
    return encounter.filter(F.lower("encounter_class").isin(*classes))


def detect_chronic_conditions(condition: DataFrame) -> DataFrame:
    """Per patient, 1 or 0 for each chronic condition, in one pass over the conditions."""
    flags = [
        F.max(F.when(c("condition_code").isin(*codes), 1).otherwise(0)).alias(f"has_{name}")
        for name, codes in CHRONIC_CODES.items()
    ]
    return condition.groupBy("patient_id").agg(*flags)


# --- dimensions ------------------------------------------------------------------------


def dim_cms_beneficiary(patient: DataFrame, condition: DataFrame) -> DataFrame:
    race, ethnicity = F.lower("race"), F.lower("ethnicity")
    by_ethnicity = F.when(ethnicity.isin(*HISPANIC_NAMES), HISPANIC_RACE).otherwise(OTHER_RACE)
    months = {
        "bene_hi_cvrage_tot_mons": 12,
        "bene_smi_cvrage_tot_mons": 12,
        "bene_hmo_cvrage_tot_mons": 0,
        "plan_cvrg_mos_num": 0,
    }

    def flagged(name: str) -> Column:
        return c(f"has_{name}").eqNullSafe(1)

    return patient.join(detect_chronic_conditions(condition), "patient_id", "left").select(
        surrogate_key("patient_id").alias("beneficiary_key"),
        *named(
            "source_system",
            desynpuf_id="patient_id",
            bene_birth_dt="birth_date",
            bene_death_dt="death_date",
            bene_sex_ident_cd=recode(F.lower("gender"), SEX_CODES, 0),
            bene_race_cd=F.coalesce(recode(race, RACE_CODES), by_ethnicity),
            bene_esrd_ind=F.when(flagged("esrd"), "Y").otherwise("0"),
            sp_state_code="state",
            bene_county_cd="county",
            **{name: F.lit(n) for name, n in months.items()},
            **{
                column: F.when(flagged(name), 1).otherwise(2)
                for name, column in FLAG_COLUMNS.items()
            },
        ),
        *typed_nulls(["bene_zip_cd"]),
        *typed_nulls(COSTS, MONEY),
    )


def dim_cms_provider(practitioner: DataFrame) -> DataFrame:
    return practitioner.select(
        surrogate_key("practitioner_id").alias("provider_key"),
        surrogate_key("organization_id").alias("organization_key"),
        *named(
            "specialty_code",
            "gender",
            "state",
            "city",
            "organization_id",
            "active",
            "source_system",
            provider_id="practitioner_id",
            prvdr_num="practitioner_id",
            provider_name="name",
            provider_specialty="specialty",
            zip_code="postal_code",
        ),
        *typed_nulls(["npi"]),
    )


# --- facts -----------------------------------------------------------------------------


def diagnosis_slots(condition: DataFrame) -> DataFrame:
    """The first 10 diagnoses of each encounter by onset, then code and id."""
    code = F.coalesce("icd10cm_code", "condition_code")
    order = [c("onset_date"), code, c("condition_id")]
    return first_n_as_columns(
        condition, "encounter_id", order, {"icd_dgns_cd": (code, DIAGNOSIS_SLOTS)}
    )


def procedure_slots(procedure: DataFrame) -> DataFrame:
    """The first 6 procedures of each encounter and their dates."""
    order = [c("performed_date"), c("hcpcs_code"), c("procedure_id")]
    return first_n_as_columns(
        procedure,
        "encounter_id",
        order,
        {
            "icd_prcdr_cd": ("hcpcs_code", PROCEDURE_SLOTS),
            "prcdr_dt": ("performed_date", PROCEDURE_SLOTS),
        },
    )


def _institutional_claims(
    encounter: DataFrame, condition: DataFrame, procedure: DataFrame, classes: Sequence[str]
) -> tuple[DataFrame, list[Column]]:
    """Encounters of some classes beside their code slots, and the columns claims share."""
    diagnoses, procedures = diagnosis_slots(condition), procedure_slots(procedure)
    joined = (
        in_class(encounter, classes)
        .join(diagnoses, "encounter_id", "left")
        .join(procedures, "encounter_id", "left")
    )
    slots = [n for side in (diagnoses, procedures) for n in side.columns if n != "encounter_id"]
    shared = [
        surrogate_key("encounter_id").alias("claim_key"),
        surrogate_key("patient_id").alias("beneficiary_key"),
        surrogate_key("provider_id").alias("provider_key"),
        surrogate_key("organization_id").alias("organization_key"),
        *named(
            "source_system",
            clm_id="encounter_id",
            desynpuf_id="patient_id",
            clm_from_dt=F.to_date("start_datetime"),
            clm_thru_dt=F.to_date("end_datetime"),
            at_physn_npi="provider_id",
            op_physn_npi="provider_id",
            provider_id_cms="organization_id",
            clm_pmt_amt=dollars("total_cost"),
            nch_prmry_pyr_clm_pd_amt=dollars("payer_coverage"),
            nch_bene_blood_ddctbl_lblty_am=dollars("patient_responsibility"),
            service_date_key=date_key("start_datetime"),
        ),
        *named(*slots),
    ]
    return joined, shared


def fact_cms_inpatient_claims(
    encounter: DataFrame, condition: DataFrame, procedure: DataFrame
) -> DataFrame:
    """Discharge is the end of the stay, admission its start, the admitting diagnosis the
    first one."""
    joined, shared = _institutional_claims(encounter, condition, procedure, INPATIENT_CLASSES)
    return joined.select(
        *shared,
        *named(
            clm_admsn_dt=F.to_date("start_datetime"),
            nch_bene_dschrg_dt=F.to_date("end_datetime"),
            admtng_icd_dgns_cd="icd_dgns_cd1",
            nch_bene_ip_ddctbl_amt=dollars("base_cost"),
            nch_bene_pta_coinsrnc_lblty_amt=dollars("patient_responsibility"),
            clm_utlztn_day_cnt=or_zero(days_between("start_datetime", "end_datetime")),
        ),
        *typed_nulls(["ot_physn_npi", "clm_drg_cd"]),
        *typed_nulls(["clm_pass_thru_per_diem_amt"], "int"),
        *typed_nulls(["nch_ip_ncvrd_chrg_amt", "nch_ip_tot_ddctn_amt"], MONEY),
    )


def fact_cms_outpatient_claims(
    encounter: DataFrame, condition: DataFrame, procedure: DataFrame
) -> DataFrame:
    joined, shared = _institutional_claims(encounter, condition, procedure, OUTPATIENT_CLASSES)
    return joined.select(
        *shared,
        *named("is_emergency", clm_line_cnt=F.lit(1)),
        *typed_nulls(["nch_profnl_cmpnt_chrg_amt"], MONEY),
    )


def fact_cms_prescription_drug_events(medication: DataFrame) -> DataFrame:
    treated = F.greatest(F.lit(1), days_between("start_datetime", "end_datetime"))
    supply = F.when(c("end_datetime").isNull(), DEFAULT_SUPPLY_DAYS).otherwise(treated)
    return medication.select(
        surrogate_key("medication_id").alias("pde_key"),
        surrogate_key("patient_id").alias("beneficiary_key"),
        *named(
            "medication_description",
            "rxnorm_name",
            "dosage_form",
            "route",
            "manufacturer",
            "source_system",
            pde_id="medication_id",
            desynpuf_id="patient_id",
            srvc_dt="prescribed_date",
            service_date_key=date_key("prescribed_date"),
            prod_srvc_id=F.coalesce("ndc_code", "medication_code"),
            rxnorm_code="medication_code",
            brand_name="ndc_proprietary_name",
            generic_name="ndc_nonproprietary_name",
            qty_dspnsd_num=F.coalesce("refills_allowed", F.lit(1)).cast(MONEY),
            days_suply_num=supply,
            ptnt_pay_amt=dollars("patient_cost"),
            cvrd_d_plan_pd_amt=dollars("total_cost"),
            ncvrd_plan_pd_amt=dollars("payer_coverage"),
            tot_rx_cst_amt=dollars("total_cost"),
            drug_cvrg_stus_cd=F.lit("C"),
        ),
        *typed_nulls(["othtroop_amt", "lics_amt", "plro_amt"], MONEY),
        *typed_nulls(["daw_prod_slctn_cd"]),
    )


# The line amounts of a carrier claim, which all carry the procedure cost.
LINE_AMOUNTS = [
    "line_nch_pmt_amt", "line_bene_pmt_amt", "line_prvdr_pmt_amt", "line_bene_ptb_ddctbl_amt",
    "line_bene_prmry_pyr_pd_amt", "line_coinsrnc_amt", "line_sbmtd_chrg_amt",
    "line_alowd_chrg_amt",
]


def _carrier_headers(encounter: DataFrame) -> DataFrame:
    keyed = encounter.filter("encounter_id is not null and patient_id is not null")
    return in_class(keyed, CARRIER_CLASSES).select(
        "encounter_id",
        "patient_id",
        "provider_id",
        F.to_date("start_datetime").alias("clm_from_dt"),
        F.to_date("end_datetime").alias("clm_thru_dt"),
        "source_system",
    )


def fact_cms_carrier_claims(
    encounter: DataFrame, procedure: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """Professional claims, one row per procedure line; claims without lines get line 1.

    ``codes`` is the lookup of a ``procedure`` table that was not joined to it. Numbered lines
    meet it, so lines are shuffled by encounter, and only those of carrier claims by code.
    Where it lists a code more than once, a line is several, and lines meet it first.
    """
    if codes is not None:
        procedure = procedure.drop(*cleaned.PROCEDURE_CODES)
        if not cleaned.lists_codes_once(codes):
            procedure, codes = cleaned.with_procedure_codes(procedure, codes), None
    looked_up = ["hcpcs_code", "hcpcs_description", "betos_code"]
    header = _carrier_headers(encounter)
    lines = procedure.filter(c("encounter_id").isNotNull()).select(
        "encounter_id",
        "procedure_id",
        "performed_date",
        "procedure_cost",
        "procedure_description",
        *(looked_up if codes is None else ["procedure_code"]),
    )
    # Lines of other classes are never numbered.
    lines = lines.join(header.select("encounter_id"), "encounter_id", "left_semi")
    line = numbered(lines, "encounter_id", "performed_date", ["procedure_id", "procedure_cost"])
    claims = left_join_hot_right(header, line, "encounter_id", keys=procedure)
    if codes is not None:
        claims = cleaned.with_procedure_codes(claims, codes)
    return claims.select(
        surrogate_key("encounter_id").alias("claim_key"),
        surrogate_key("patient_id").alias("beneficiary_key"),
        surrogate_key("provider_id").alias("provider_key"),
        *named(
            "hcpcs_description",
            "source_system",
            clm_id="encounter_id",
            desynpuf_id="patient_id",
            clm_line_num=F.coalesce("line_num", F.lit(1)),
            clm_from_dt="clm_from_dt",
            clm_thru_dt="clm_thru_dt",
            prf_physn_npi="provider_id",
            hcpcs_cd="hcpcs_code",
            betos_cd="betos_code",
            line_srvc_desc="procedure_description",
            line_service_cnt=F.lit(1).cast(MONEY),
            service_date_key=date_key("clm_from_dt"),
            **{amount: dollars("procedure_cost") for amount in LINE_AMOUNTS},
        ),
        *typed_nulls(
            [
                "carr_clm_rfrng_pin_num",
                "carr_clm_cash_ddctbl_apld_amt",
                "line_place_of_srvc_cd",
                "line_pmt_80_100_cd",
                "line_icd_dgns_cd",
            ]
        ),
        *typed_nulls(["line_prcsg_ind_cd"], MONEY),
    )


def carrier_costs(encounter: DataFrame, procedure: DataFrame) -> DataFrame:
    """What yearly costs read of the carrier claims, without numbering their lines."""
    header = _carrier_headers(encounter)
    lines = procedure.select("encounter_id", "procedure_cost")
    joined = left_join_hot_right(header, lines, "encounter_id", keys=procedure)
    return joined.select(
        *named(
            desynpuf_id="patient_id",
            clm_from_dt="clm_from_dt",
            **{amount: dollars("procedure_cost") for amount in COST_SOURCES["car"]},
        )
    )


# --- yearly costs ----------------------------------------------------------------------

# Which claim amounts feed reimbursement, beneficiary and payer shares.
COST_SOURCES = {
    "ip": ("clm_pmt_amt", "nch_bene_pta_coinsrnc_lblty_amt", "nch_prmry_pyr_clm_pd_amt"),
    "op": ("clm_pmt_amt", "nch_bene_blood_ddctbl_lblty_am", "nch_prmry_pyr_clm_pd_amt"),
    "car": ("line_nch_pmt_amt", "line_bene_ptb_ddctbl_amt", "line_bene_prmry_pyr_pd_amt"),
}


def yearly_costs(inpatient: DataFrame, outpatient: DataFrame, carrier: DataFrame) -> DataFrame:
    """Costs per beneficiary and year over all claim kinds.

    The claims are stacked with one amount column per cost and summed once, which gives
    both the set of beneficiary years and their costs in a single shuffle. A claim
    without a date still yields its (unknown) year, but adds no cost.
    """
    kinds = {"ip": inpatient, "op": outpatient, "car": carrier}

    def stacked(kind: str) -> DataFrame:
        year = F.year("clm_from_dt")
        amounts = [
            F.when(year.isNotNull(), c(source)).cast(MONEY).alias(name)
            for source, name in zip(COST_SOURCES[kind], [n for n in COSTS if n.endswith(kind)])
        ]
        return kinds[kind].select("desynpuf_id", year.alias("year"), *amounts)

    together = reduce(
        lambda top, bottom: top.unionByName(bottom, allowMissingColumns=True),
        [stacked(kind) for kind in kinds],
    )
    sums = [or_zero(F.sum(n)).alias(n) for n in COSTS]
    return together.groupBy("desynpuf_id", "year").agg(*sums)


def agg_cms_beneficiary_summary_yearly(
    beneficiary: DataFrame, inpatient: DataFrame, outpatient: DataFrame, carrier: DataFrame
) -> DataFrame:
    about = beneficiary.drop(*COSTS, "bene_zip_cd", "source_system")
    return about.join(yearly_costs(inpatient, outpatient, carrier), "desynpuf_id")


TABLES: dict[str, tuple[str, Callable[..., DataFrame], Sequence[str]]] = {
    "dim_cms_beneficiary": ("dimension", dim_cms_beneficiary, ("patient", "condition")),
    "dim_cms_provider": ("dimension", dim_cms_provider, ("practitioner",)),
    "fact_cms_inpatient_claims": (
        "fact",
        fact_cms_inpatient_claims,
        ("encounter", "condition", "procedure"),
    ),
    "fact_cms_outpatient_claims": (
        "fact",
        fact_cms_outpatient_claims,
        ("encounter", "condition", "procedure"),
    ),
    "fact_cms_prescription_drug_events": (
        "fact",
        fact_cms_prescription_drug_events,
        ("medication",),
    ),
    "fact_cms_carrier_claims": ("fact", fact_cms_carrier_claims, ("encounter", "procedure")),
    "agg_cms_beneficiary_summary_yearly": (
        "aggregate",
        agg_cms_beneficiary_summary_yearly,
        (
            "dim_cms_beneficiary",
            "fact_cms_inpatient_claims",
            "fact_cms_outpatient_claims",
            "fact_cms_carrier_claims",
        ),
    ),
}
