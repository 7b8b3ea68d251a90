"""DuckDB twins of the registered queries: marts, reports, operators."""

from __future__ import annotations

from checks.oracle_base import (
    AS_OF,
    HCPCS_FIELDS,
    LINES,
    MONEY,
    NDC,
    NDC9,
    NDC11,
    PARTS,
    PRODUCT_NDC,
    avg6,
    day_key,
    icd_raw,
    part,
    pct,
    per_head,
    pick,
    sha,
    with_parts,
)
from checks.queries import HOME_STATE, LOCAL_STATE, QUERIES, YEAR


def key_of(column: str, name: str) -> str:
    return f"{sha(column)} {name}"


# --- star schema -----------------------------------------------------------------------

part("dim_date")(f"""
SELECT {day_key('d')} date_key, d "date", year(d)::INT "year", quarter(d)::INT "quarter", month(d)::INT "month",
  monthname(d) month_name, weekofyear(d)::INT week_of_year, day(d)::INT day_of_month, (dayofweek(d) + 1)::INT day_of_week,
  dayname(d) day_name, dayofweek(d) IN (0, 6) is_weekend, date_trunc('month', d)::TIMESTAMP month_start,
  last_day(d) month_end, date_trunc('quarter', d)::TIMESTAMP quarter_start, date_trunc('year', d)::TIMESTAMP year_start
FROM (SELECT unnest(range(DATE '2000-01-01', DATE '2031-01-01', INTERVAL 1 DAY))::DATE d)
""")
part("dim_patient", "c_patient")(f"""
SELECT {key_of('patient_id', 'patient_key')}, patient_id, first_name, middle_name, last_name, gender, birth_date,
  death_date, is_deceased, age_years, city, state, country, marital_status, race, ethnicity, source_system,
  concat_ws(' ', name_prefix, first_name, middle_name, last_name, name_suffix) full_name,
  CASE WHEN age_years < 18 THEN 'Pediatric (0-17)' WHEN age_years < 35 THEN 'Young Adult (18-34)'
    WHEN age_years < 50 THEN 'Adult (35-49)' WHEN age_years < 65 THEN 'Middle Age (50-64)'
    WHEN age_years >= 65 THEN 'Senior (65+)' ELSE 'Unknown' END age_group,
  address_line address, postal_code zip_code, medical_record_number mrn FROM c_patient
""")
part("dim_provider", "c_practitioner")(f"""
SELECT {key_of('practitioner_id', 'provider_key')}, {key_of('organization_id', 'organization_key')}, gender, specialty,
  specialty_code, organization_id, city, state, encounter_count, procedure_count, active, source_system,
  practitioner_id provider_id, "name" provider_name, address_line address, postal_code zip_code FROM c_practitioner
""")
part("dim_organization", "c_organization")(f"""
SELECT {key_of('organization_id', 'organization_key')}, organization_id, "name", type_code, type_display, city, state,
  phone, latitude, longitude, revenue, utilization, active, source_system, address_line address, postal_code zip_code,
  CASE WHEN utilization >= 10000 THEN 'Large' WHEN utilization >= 1000 THEN 'Medium' WHEN utilization >= 100 THEN 'Small'
    ELSE 'Very Small' END size_classification FROM c_organization
""")
part("dim_payer", "c_payer")(f"""
SELECT {key_of('payer_id', 'payer_key')}, payer_id, payer_name, ownership_type, is_active, phone, city, state,
  amount_covered, amount_uncovered, revenue, coverage_ratio, covered_encounters, uncovered_encounters,
  covered_medications, uncovered_medications, covered_procedures, uncovered_procedures, covered_immunizations,
  uncovered_immunizations, quality_of_life_score_avg, member_months, source_system, postal_code zip_code,
  covered_encounters + uncovered_encounters total_encounters, unique_customers member_count,
  {pct('covered_encounters', '(covered_encounters + uncovered_encounters)')} encounter_coverage_rate_pct,
  CASE WHEN member_months > 0 THEN {per_head('amount_covered', 'member_months')} ELSE 0 END pmpm_covered,
  CASE WHEN coverage_ratio >= 0.8 THEN 'Premium' WHEN coverage_ratio >= 0.6 THEN 'Standard'
    WHEN coverage_ratio >= 0.4 THEN 'Basic' ELSE 'Minimal' END payer_tier FROM c_payer
""")
part("dim_encounter_type", "c_encounter")(f"""
SELECT {sha('encounter_class_code', 'encounter_type_code')} encounter_type_key, encounter_class_code,
  encounter_type_code, min(encounter_class) encounter_class, min(encounter_type) encounter_type,
  CASE encounter_class_code WHEN 'EMER' THEN 'Emergency' WHEN 'IMP' THEN 'Inpatient' ELSE 'Outpatient' END encounter_category,
  CASE encounter_class_code WHEN 'EMER' THEN 1 WHEN 'IMP' THEN 2 ELSE 3 END acuity_level
FROM c_encounter GROUP BY 2, 3
""")
part("fact_encounter", "c_encounter")(f"""
SELECT {key_of('encounter_id', 'encounter_key')}, {key_of('patient_id', 'patient_key')},
  {key_of('provider_id', 'provider_key')}, {key_of('organization_id', 'organization_key')}, encounter_id,
  encounter_class_code, encounter_class, encounter_type_code, reason_code, reason_description, duration_minutes,
  is_emergency, is_inpatient, is_ambulatory, source_system, {day_key('start_datetime')} start_date_key,
  {day_key('end_datetime')} end_date_key, encounter_type encounter_description, start_datetime start_date,
  end_datetime end_date, coalesce(base_cost, 0) base_encounter_cost, coalesce(total_cost, 0) total_claim_cost,
  coalesce(payer_coverage, 0) payer_coverage_amount, patient_responsibility FROM c_encounter
""")
part("fact_condition", "c_condition_only")(f"""
SELECT {key_of('condition_id', 'condition_key')}, {key_of('patient_id', 'patient_key')},
  {key_of('encounter_id', 'encounter_key')}, condition_id, condition_code, code_system, condition_description,
  category_code, clinical_status, verification_status, onset_date, abatement_date, duration_days, is_active,
  is_resolved, source_system, {day_key('onset_date')} onset_date_key, {day_key('abatement_date')} abatement_date_key,
  coalesce(duration_days > 90, false) OR (is_active AND date_diff('day', onset_date, {AS_OF}) > 90) is_chronic
FROM c_condition_only
""")
part("fact_medication", "c_medication_only")(f"""
SELECT {key_of('medication_id', 'medication_key')}, {key_of('patient_id', 'patient_key')},
  {key_of('encounter_id', 'encounter_key')}, medication_id, medication_code, code_system, medication_description,
  rx_status, rx_intent, refills_allowed, reason_description, is_active, source_system,
  {day_key('prescribed_date')} start_date_key, {day_key('end_datetime')} end_date_key, prescribed_date start_date,
  end_datetime::DATE end_date, base_cost, total_cost, payer_coverage, patient_cost FROM c_medication_only
""")
part("fact_procedure", "c_procedure_only")(f"""
SELECT {key_of('procedure_id', 'procedure_key')}, {key_of('patient_id', 'patient_key')},
  {key_of('encounter_id', 'encounter_key')}, procedure_id, procedure_code, code_system, procedure_description,
  procedure_status, performed_date, reason_code, reason_description, source_system,
  {day_key('performed_date')} procedure_date_key,
  CASE WHEN procedure_cost >= 5000 THEN 'High Cost' WHEN procedure_cost >= 1000 THEN 'Medium Cost' ELSE 'Low Cost' END cost_tier,
  coalesce(procedure_cost, 0) procedure_cost FROM c_procedure_only
""")
CLAIM_COLUMNS = f"""
SELECT {key_of('claim_id', 'claim_key')}, {key_of('c.patient_id', 'patient_key')}, {key_of('provider_id', 'provider_key')},
  {key_of('primary_coverage_id', 'coverage_key')}, claim_id, claim_type_code, claim_type, claim_status, claim_use,
  primary_diagnosis_code, secondary_diagnosis_code, diagnosis_count, service_date, outcome claim_outcome, r.payment_date,
  r.procedure_code adjudicated_procedure_code, c.source_system, {day_key('service_date')} service_date_key,
  {day_key('service_date')} created_date_key, c.created_date claim_created_date, total_amount submitted_amount,
  total_amount - coalesce(payment_amount, 0) patient_liability,
  {pct('coalesce(payment_amount, 0)', 'total_amount')} payment_rate_pct,
  coalesce(outcome = 'complete', false) is_fully_paid, coalesce(outcome = 'partial', false) is_partially_paid,
  coalesce(outstanding_amount, 0) > 0 has_outstanding_balance, coalesce(payment_amount, 0) approved_amount,
  coalesce(payment_amount, 0) paid_amount, coalesce(outstanding_amount, 0) outstanding_amount
FROM c_claim c LEFT JOIN
"""
part("fact_claim", "c_claim", "c_claimresponse_only")(CLAIM_COLUMNS + "c_claimresponse_only r USING (claim_id)")
part("fact_claim_per_claim", "c_claim", "c_claimresponse_only")(
    CLAIM_COLUMNS
    + """(SELECT claim_id, sum(payment_amount) payment_amount, sum(outstanding_amount) outstanding_amount,
  max(payment_date) payment_date, min(procedure_code) procedure_code,
  CASE WHEN bool_and(outcome = 'complete') THEN 'complete' WHEN bool_or(outcome <> 'queued') THEN 'partial'
    ELSE 'queued' END outcome FROM c_claimresponse_only GROUP BY 1) r USING (claim_id)"""
)
ZERO_SUMS = (
    "total_encounters emergency_visits inpatient_stays ambulatory_visits total_healthcare_cost "
    "total_payer_coverage total_patient_cost avg_encounter_cost total_conditions active_conditions "
    "chronic_conditions total_prescriptions active_prescriptions total_medication_cost "
    "total_procedures total_procedure_cost"
).split()
part(
    "agg_patient_summary",
    "dim_patient",
    "fact_encounter",
    "fact_condition",
    "fact_medication",
    "fact_procedure",
)(f"""
SELECT patient_key, patient_id, age_years, age_group, gender, race, ethnicity, state, is_deceased,
  full_name patient_full_name, {', '.join(f'coalesce({z}, 0) {z}' for z in ZERO_SUMS)},
  CASE WHEN chronic_conditions >= 3 THEN 'High' WHEN chronic_conditions >= 1 THEN 'Medium' ELSE 'Low' END chronic_risk_level,
  CASE WHEN emergency_visits >= 3 THEN 'High' WHEN emergency_visits >= 1 THEN 'Medium' ELSE 'Low' END emergency_utilization_level
FROM dim_patient
LEFT JOIN (SELECT patient_key, count(*) total_encounters, count(*) FILTER (is_emergency) emergency_visits,
    count(*) FILTER (is_inpatient) inpatient_stays, count(*) FILTER (is_ambulatory) ambulatory_visits,
    sum(total_claim_cost) total_healthcare_cost, sum(payer_coverage_amount) total_payer_coverage,
    sum(patient_responsibility) total_patient_cost, {avg6('total_claim_cost')} avg_encounter_cost
  FROM fact_encounter GROUP BY 1) USING (patient_key)
LEFT JOIN (SELECT patient_key, count(*) total_conditions, count(*) FILTER (is_active) active_conditions,
    count(*) FILTER (is_chronic) chronic_conditions FROM fact_condition GROUP BY 1) USING (patient_key)
LEFT JOIN (SELECT patient_key, count(*) total_prescriptions, count(*) FILTER (is_active) active_prescriptions,
    sum(total_cost) total_medication_cost FROM fact_medication GROUP BY 1) USING (patient_key)
LEFT JOIN (SELECT patient_key, count(*) total_procedures, sum(procedure_cost) total_procedure_cost
  FROM fact_procedure GROUP BY 1) USING (patient_key)
""")
part("agg_encounter_type_summary", "fact_encounter")(f"""
SELECT encounter_class, encounter_class_code, count(*) encounter_count, count(DISTINCT patient_key) unique_patients,
  sum(total_claim_cost) total_cost, {avg6('total_claim_cost')} avg_cost, avg(duration_minutes) avg_duration_minutes
FROM fact_encounter GROUP BY 1, 2
""")
part("agg_condition_prevalence", "fact_condition", "dim_patient")("""
SELECT condition_code, condition_description, count(*) total_occurrences, count(DISTINCT patient_key) unique_patients,
  count(*) FILTER (is_active) active_cases, count(*) FILTER (is_chronic) chronic_cases,
  avg(duration_days) avg_duration_days,
  count(DISTINCT patient_key)::DOUBLE / (SELECT count(*) FROM dim_patient)::DOUBLE * 100 prevalence_pct
FROM fact_condition GROUP BY 1, 2
""")
part("agg_provider_performance", "dim_provider", "fact_encounter")(f"""
SELECT provider_key, provider_id, provider_name, specialty, organization_id, state,
  {', '.join(f'coalesce({z}, 0) {z}' for z in ('total_encounters', 'unique_patients', 'emergency_encounters', 'inpatient_encounters', 'ambulatory_encounters', 'total_charges', 'total_payer_payments', 'total_patient_charges', 'avg_charge_per_encounter', 'avg_encounter_duration_minutes'))},
  first_encounter_date, last_encounter_date,
  {per_head('coalesce(total_encounters, 0)', 'unique_patients')} encounters_per_patient,
  {per_head('coalesce(total_charges, 0)', 'unique_patients')} revenue_per_patient,
  CASE WHEN total_encounters >= 1000 THEN 'High Volume' WHEN total_encounters >= 100 THEN 'Medium Volume' ELSE 'Low Volume' END volume_tier
FROM dim_provider LEFT JOIN (SELECT provider_key, count(*) total_encounters, count(DISTINCT patient_key) unique_patients,
    count(*) FILTER (is_emergency) emergency_encounters, count(*) FILTER (is_inpatient) inpatient_encounters,
    count(*) FILTER (is_ambulatory) ambulatory_encounters, sum(total_claim_cost) total_charges,
    sum(payer_coverage_amount) total_payer_payments, sum(patient_responsibility) total_patient_charges,
    {avg6('total_claim_cost')} avg_charge_per_encounter, avg(duration_minutes) avg_encounter_duration_minutes,
    min(start_date) first_encounter_date, max(start_date) last_encounter_date FROM fact_encounter GROUP BY 1)
  USING (provider_key)
""")
part("agg_medication_utilization", "fact_medication")(f"""
SELECT medication_code, medication_description, count(*) total_prescriptions, count(DISTINCT patient_key) unique_patients,
  count(*) FILTER (is_active) active_prescriptions, sum(total_cost) total_medication_cost, sum(base_cost) total_base_cost,
  sum(payer_coverage) total_payer_coverage, sum(patient_cost) total_patient_cost, {avg6('total_cost')} avg_prescription_cost,
  {avg6('patient_cost')} avg_patient_cost, avg(refills_allowed) avg_refills_allowed, min(start_date) first_prescription_date,
  max(start_date) last_prescription_date, {pct('sum(payer_coverage)', 'sum(total_cost)')} payer_coverage_rate_pct,
  CASE WHEN count(*) >= 1000 THEN 'High Utilization' WHEN count(*) >= 100 THEN 'Medium Utilization' ELSE 'Low Utilization' END utilization_tier
FROM fact_medication GROUP BY 1, 2
""")
part("agg_payer_statistics", "dim_payer", "fact_claim")(f"""
SELECT payer_key, payer_id, payer_name, ownership_type, payer_tier, member_count, quality_of_life_score_avg,
  coverage_ratio profile_coverage_ratio,
  {', '.join(f'coalesce({z}, 0) {z}' for z in ('total_claims', 'unique_patients', 'total_submitted', 'total_approved', 'total_paid', 'total_outstanding', 'avg_claim_amount', 'avg_payment_amount', 'fully_paid_claims', 'partially_paid_claims', 'claims_with_balance'))},
  avg_days_to_payment, {pct('total_paid', 'total_submitted')} payment_rate_pct,
  {pct('total_approved', 'total_submitted')} approval_rate_pct
FROM dim_payer LEFT JOIN (SELECT coverage_key payer_key, count(*) total_claims, count(DISTINCT patient_key) unique_patients,
    sum(submitted_amount) total_submitted, sum(approved_amount) total_approved, sum(paid_amount) total_paid,
    sum(outstanding_amount) total_outstanding, {avg6('submitted_amount')} avg_claim_amount,
    {avg6('paid_amount')} avg_payment_amount, count(*) FILTER (is_fully_paid) fully_paid_claims,
    count(*) FILTER (is_partially_paid) partially_paid_claims,
    count(*) FILTER (has_outstanding_balance) claims_with_balance,
    avg(date_diff('day', service_date, payment_date)) avg_days_to_payment FROM fact_claim GROUP BY 1) USING (payer_key)
""")
part("agg_financial_summary", "fact_encounter", "dim_date")(f"""
SELECT "year", "quarter", "month", "year" || '-Q' || "quarter" year_quarter, strftime("date", '%Y-%m') year_month,
  count(*) total_encounters, count(DISTINCT patient_key) unique_patients, count(DISTINCT provider_key) unique_providers,
  count(DISTINCT organization_key) unique_organizations, count(*) FILTER (is_emergency) emergency_encounters,
  count(*) FILTER (is_inpatient) inpatient_encounters, count(*) FILTER (is_ambulatory) ambulatory_encounters,
  sum(base_encounter_cost) total_base_cost, sum(total_claim_cost) total_claim_cost,
  sum(payer_coverage_amount) total_payer_coverage, sum(patient_responsibility) total_patient_responsibility,
  {avg6('total_claim_cost')} avg_claim_cost, {avg6('payer_coverage_amount')} avg_payer_coverage,
  {avg6('patient_responsibility')} avg_patient_responsibility, sum(duration_minutes)::BIGINT total_duration_minutes,
  avg(duration_minutes) avg_duration_minutes, {pct('sum(payer_coverage_amount)', 'sum(fact_encounter.total_claim_cost)')} payer_coverage_rate_pct,
  {pct('count(*) FILTER (is_emergency)', 'count(*)')} emergency_rate_pct,
  {per_head('count(*)', 'count(DISTINCT patient_key)')} avg_encounters_per_patient
FROM fact_encounter JOIN dim_date ON start_date_key = date_key GROUP BY 1, 2, 3, 4, 5
""")
part("dim_date_of_encounters", "c_encounter")(
    PARTS["dim_date"][1].replace(
        "DATE '2000-01-01', DATE '2031-01-01'",
        """
  (SELECT make_date(least(2000, year(min(start_datetime)), year(min(end_datetime))), 1, 1) FROM c_encounter),
  (SELECT make_date(greatest(2030, year(max(start_datetime)), year(max(end_datetime))) + 1, 1, 1) FROM c_encounter)""",
    )
)
part("agg_financial_summary_of_encounters", "fact_encounter", "dim_date_of_encounters")(
    PARTS["agg_financial_summary"][1].replace("JOIN dim_date ", "JOIN dim_date_of_encounters ")
)
READMIT = f"""
SELECT year(start_date)::INT "year", quarter(start_date)::INT "quarter", month(start_date)::INT "month",
  count(*) total_admissions, count(DISTINCT patient_key) unique_patients,
  {', '.join(f'count(*) FILTER (gap <= {d}) readmissions_{d}_day' for d in (30, 60, 90))},
  {', '.join(f'avg(gap) FILTER (gap <= {d}) avg_days_to_{d}_day_readmit' for d in (30, 90))},
  {', '.join(f"{pct(f'count(*) FILTER (gap <= {d})', 'count(*)')} readmission_rate_{d}_day_pct" for d in (30, 60, 90))}
"""
part("agg_readmission_rates", "fact_encounter")(f"""{READMIT}
FROM (SELECT patient_key, start_date, date_diff('day', lag(start_date) OVER (PARTITION BY patient_key ORDER BY start_date), start_date) gap
  FROM fact_encounter WHERE is_inpatient OR is_emergency) WHERE gap IS NOT NULL GROUP BY 1, 2, 3
""")
part("agg_readmission_from_discharge", "fact_encounter")(f"""{READMIT}
FROM (SELECT a.patient_key, a.start_date, greatest(date_diff('day', b.left_on, a.start_date), CASE WHEN b.left_on IS NOT NULL THEN 0 END) gap
  FROM (SELECT *, row_number() OVER () id FROM fact_encounter WHERE is_inpatient) a
  LEFT JOIN LATERAL (SELECT max(end_date)::DATE left_on FROM fact_encounter f
    WHERE f.is_inpatient AND f.patient_key = a.patient_key AND f.start_date::DATE < a.start_date::DATE) b ON true) GROUP BY 1, 2, 3
""")

# --- mart ------------------------------------------------------------------------------

CODE_SETS = {
    "alzheimers": ("sp_alzhdmta", "'26929004','230270009','12348006','421529006'"),
    "chf": ("sp_chf", "'42343007','407596008','194767001','194779001'"),
    "ckd": ("sp_chrnkidn", "'709044004','46177005','236425005','236426006'"),
    "cancer": ("sp_cncr", "'363346000','93870000','109838007','254837009'"),
    "copd": ("sp_copd", "'13645005','185086009','68328006'"),
    "depression": ("sp_depressn", "'35489007','370143000','33078009','192080009'"),
    "diabetes": ("sp_diabetes", "'44054006','73211009','46635009','11530004'"),
    "ihd": ("sp_ischmcht", "'414545008','413439005','194828000','233838004'"),
    "osteoporosis": ("sp_osteoprs", "'64859006','203438003','240165008'"),
    "ra_oa": ("sp_ra_oa", "'69896004','239873007','396275006','201834006'"),
    "stroke": ("sp_strketia", "'230690007','422504002','195189005','230706003'"),
    "esrd": ("", "'90688005','236435004','236436003'"),
}
FLAGS = [flag for flag, _ in CODE_SETS.values() if flag]
part("detect_chronic_conditions", "c_condition_only")(
    "SELECT patient_id, "
    + ", ".join(
        f"max(CASE WHEN condition_code IN ({codes}) THEN 1 ELSE 0 END) has_{name}"
        for name, (_, codes) in CODE_SETS.items()
    )
    + " FROM c_condition_only GROUP BY 1"
)
COST_NAMES = [f"{w}_{k}" for k in ("ip", "op", "car") for w in ("medreimb", "benres", "pppymt")]
part("dim_cms_beneficiary", "c_patient", "detect_chronic_conditions")(f"""
SELECT {key_of('patient_id', 'beneficiary_key')}, source_system, patient_id desynpuf_id, birth_date bene_birth_dt,
  death_date bene_death_dt, CASE gender WHEN 'm' THEN 1 ELSE 2 END bene_sex_ident_cd,
  CASE race WHEN 'White' THEN 1 WHEN 'Black' THEN 2 WHEN 'Asian' THEN 4
    ELSE CASE WHEN ethnicity = 'Hispanic or Latino' THEN 5 ELSE 3 END END bene_race_cd,
  CASE WHEN has_esrd = 1 THEN 'Y' ELSE '0' END bene_esrd_ind, state sp_state_code, county bene_county_cd,
  12 bene_hi_cvrage_tot_mons, 12 bene_smi_cvrage_tot_mons, 0 bene_hmo_cvrage_tot_mons, 0 plan_cvrg_mos_num,
  {', '.join(f'CASE WHEN has_{n} = 1 THEN 1 ELSE 2 END {flag}' for n, (flag, _) in CODE_SETS.items() if flag)},
  NULL::VARCHAR bene_zip_cd, {', '.join(f'NULL::DOUBLE {n}' for n in COST_NAMES)}
FROM c_patient LEFT JOIN detect_chronic_conditions USING (patient_id)
""")
part("dim_cms_provider", "c_practitioner")(f"""
SELECT {key_of('practitioner_id', 'provider_key')}, {key_of('organization_id', 'organization_key')}, specialty_code,
  gender, state, city, organization_id, active, source_system, practitioner_id provider_id, practitioner_id prvdr_num,
  "name" provider_name, specialty provider_specialty, postal_code zip_code, NULL::VARCHAR npi FROM c_practitioner
""")
part("dx_slots", "c_condition")(
    "SELECT encounter_id, "
    + ", ".join(f"max(code) FILTER (n = {i}) icd_dgns_cd{i}" for i in range(1, 11))
    + """ FROM (SELECT encounter_id, coalesce(icd10cm_code, condition_code) code, row_number() OVER
  (PARTITION BY encounter_id ORDER BY onset_date, coalesce(icd10cm_code, condition_code), condition_id) n
  FROM c_condition) GROUP BY 1"""
)
part("pr_slots", "c_procedure")(
    "SELECT encounter_id, "
    + ", ".join(
        f"max(hcpcs_code) FILTER (n = {i}) icd_prcdr_cd{i}, max(performed_date) FILTER (n = {i}) prcdr_dt{i}"
        for i in range(1, 7)
    )
    + """ FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id
  ORDER BY performed_date, hcpcs_code NULLS FIRST, procedure_id) n FROM c_procedure) GROUP BY 1"""
)
SHARED = f"""{key_of('encounter_id', 'claim_key')}, {key_of('patient_id', 'beneficiary_key')},
  {key_of('provider_id', 'provider_key')}, {key_of('organization_id', 'organization_key')}, source_system,
  encounter_id clm_id, patient_id desynpuf_id, start_datetime::DATE clm_from_dt, end_datetime::DATE clm_thru_dt,
  provider_id at_physn_npi, provider_id op_physn_npi, organization_id provider_id_cms,
  coalesce(total_cost, 0) clm_pmt_amt, coalesce(payer_coverage, 0) nch_prmry_pyr_clm_pd_amt,
  patient_responsibility nch_bene_blood_ddctbl_lblty_am, {day_key('start_datetime')} service_date_key,
  {', '.join(f'icd_dgns_cd{i}' for i in range(1, 11))},
  {', '.join(f'icd_prcdr_cd{i}, prcdr_dt{i}' for i in range(1, 7))}"""
SLOT_JOINS = (
    "FROM c_encounter LEFT JOIN dx_slots USING (encounter_id) LEFT JOIN pr_slots USING (encounter_id)"
)
part("fact_cms_inpatient_claims", "c_encounter", "dx_slots", "pr_slots")(f"""
SELECT {SHARED}, start_datetime::DATE clm_admsn_dt, end_datetime::DATE nch_bene_dschrg_dt, icd_dgns_cd1 admtng_icd_dgns_cd,
  coalesce(base_cost, 0) nch_bene_ip_ddctbl_amt, patient_responsibility nch_bene_pta_coinsrnc_lblty_amt,
  coalesce(date_diff('day', start_datetime, end_datetime), 0)::INT clm_utlztn_day_cnt,
  NULL::VARCHAR ot_physn_npi, NULL::VARCHAR clm_drg_cd, NULL::INT clm_pass_thru_per_diem_amt,
  NULL::DOUBLE nch_ip_ncvrd_chrg_amt, NULL::DOUBLE nch_ip_tot_ddctn_amt
{SLOT_JOINS} WHERE encounter_class = 'inpatient'
""")
part("fact_cms_outpatient_claims", "c_encounter", "dx_slots", "pr_slots")(f"""
SELECT {SHARED}, is_emergency, 1 clm_line_cnt, NULL::DOUBLE nch_profnl_cmpnt_chrg_amt
{SLOT_JOINS} WHERE encounter_class IN ('ambulatory','outpatient','emergency','urgentcare')
""")
part("fact_cms_prescription_drug_events", "c_medication")(f"""
SELECT {key_of('medication_id', 'pde_key')}, {key_of('patient_id', 'beneficiary_key')}, medication_description, rxnorm_name,
  dosage_form, route, manufacturer, source_system, medication_id pde_id, patient_id desynpuf_id, prescribed_date srvc_dt,
  {day_key('prescribed_date')} service_date_key, coalesce(ndc_code, medication_code) prod_srvc_id,
  medication_code rxnorm_code, ndc_proprietary_name brand_name, ndc_nonproprietary_name generic_name,
  refills_allowed::DOUBLE qty_dspnsd_num,
  CASE WHEN end_datetime IS NULL THEN 30 ELSE greatest(1, date_diff('day', start_datetime, end_datetime)) END::INT days_suply_num,
  patient_cost ptnt_pay_amt, total_cost cvrd_d_plan_pd_amt, payer_coverage ncvrd_plan_pd_amt, total_cost tot_rx_cst_amt,
  'C' drug_cvrg_stus_cd, NULL::DOUBLE othtroop_amt, NULL::DOUBLE lics_amt, NULL::DOUBLE plro_amt, NULL::VARCHAR daw_prod_slctn_cd
FROM c_medication
""")
LINE_AMOUNTS = (
    "line_nch_pmt_amt line_bene_pmt_amt line_prvdr_pmt_amt line_bene_ptb_ddctbl_amt "
    "line_bene_prmry_pyr_pd_amt line_coinsrnc_amt line_sbmtd_chrg_amt line_alowd_chrg_amt"
).split()
part("fact_cms_carrier_claims", "c_encounter", "c_procedure")(f"""
SELECT {key_of('e.encounter_id', 'claim_key')}, {key_of('e.patient_id', 'beneficiary_key')},
  {key_of('provider_id', 'provider_key')}, hcpcs_description, e.source_system, e.encounter_id clm_id,
  e.patient_id desynpuf_id, coalesce(n, 1)::INT clm_line_num, e.start_datetime::DATE clm_from_dt,
  e.end_datetime::DATE clm_thru_dt, provider_id prf_physn_npi, hcpcs_code hcpcs_cd, betos_code betos_cd,
  procedure_description line_srvc_desc, 1::DOUBLE line_service_cnt, {day_key('e.start_datetime')} service_date_key,
  {', '.join(f'coalesce(procedure_cost, 0) {a}' for a in LINE_AMOUNTS)},
  NULL::VARCHAR carr_clm_rfrng_pin_num, NULL::VARCHAR carr_clm_cash_ddctbl_apld_amt, NULL::VARCHAR line_place_of_srvc_cd,
  NULL::VARCHAR line_pmt_80_100_cd, NULL::VARCHAR line_icd_dgns_cd, NULL::DOUBLE line_prcsg_ind_cd
FROM c_encounter e LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY encounter_id
    ORDER BY performed_date, {sha('procedure_id', 'procedure_cost')}) n FROM c_procedure) p ON e.encounter_id = p.encounter_id
WHERE encounter_class IN ('wellness','outpatient')
""")
part(
    "agg_cms_beneficiary_summary_yearly",
    "dim_cms_beneficiary",
    "fact_cms_inpatient_claims",
    "fact_cms_outpatient_claims",
    "fact_cms_carrier_claims",
)(f"""
SELECT b.*, y."year",
  {', '.join(f'coalesce({n}, 0)::DOUBLE {n}' for n in COST_NAMES)}
FROM (SELECT desynpuf_id, year(clm_from_dt)::INT "year" FROM fact_cms_inpatient_claims
  UNION SELECT desynpuf_id, year(clm_from_dt)::INT FROM fact_cms_outpatient_claims
  UNION SELECT desynpuf_id, year(clm_from_dt)::INT FROM fact_cms_carrier_claims) y
JOIN (SELECT * EXCLUDE ({', '.join(COST_NAMES)}, bene_zip_cd, source_system) FROM dim_cms_beneficiary) b USING (desynpuf_id)
LEFT JOIN (SELECT desynpuf_id, year(clm_from_dt)::INT "year", sum(clm_pmt_amt) medreimb_ip,
  sum(nch_bene_pta_coinsrnc_lblty_amt) benres_ip, sum(nch_prmry_pyr_clm_pd_amt) pppymt_ip
  FROM fact_cms_inpatient_claims GROUP BY 1, 2) i USING (desynpuf_id, "year")
LEFT JOIN (SELECT desynpuf_id, year(clm_from_dt)::INT "year", sum(clm_pmt_amt) medreimb_op,
  sum(nch_bene_blood_ddctbl_lblty_am) benres_op, sum(nch_prmry_pyr_clm_pd_amt) pppymt_op
  FROM fact_cms_outpatient_claims GROUP BY 1, 2) o USING (desynpuf_id, "year")
LEFT JOIN (SELECT desynpuf_id, year(clm_from_dt)::INT "year", sum(line_nch_pmt_amt) medreimb_car,
  sum(line_bene_ptb_ddctbl_amt) benres_car, sum(line_bene_prmry_pyr_pd_amt) pppymt_car
  FROM fact_cms_carrier_claims GROUP BY 1, 2) c USING (desynpuf_id, "year")
""")

# --- analyst views ---------------------------------------------------------------------

SEX = "CASE bene_sex_ident_cd WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE 'U' END"
part("view_dim_beneficiary", "dim_cms_beneficiary")(f"""
SELECT beneficiary_key, bene_esrd_ind, {', '.join(FLAGS)}, source_system, {SEX} gender, bene_race_cd race_cd,
  bene_county_cd county_cd, desynpuf_id beneficiary_code, bene_birth_dt date_of_birth, bene_death_dt death_date,
  sp_state_code state FROM dim_cms_beneficiary
""")
part("view_dim_provider", "dim_cms_provider")("SELECT * FROM dim_cms_provider")
part("view_dim_date", "dim_date")("SELECT * FROM dim_date")
CLAIM_VIEW = """SELECT beneficiary_key, service_date_key, source_system, claim_key claim_id, desynpuf_id beneficiary_code,
  provider_key attending_physician_provider_key, at_physn_npi attending_physician_npi, clm_from_dt claim_start_date,
  clm_thru_dt claim_end_date, clm_pmt_amt claim_payment_amount, nch_prmry_pyr_clm_pd_amt primary_payer_claim_paid_amount,"""
part("view_fact_patient_claims", "fact_cms_outpatient_claims", "fact_cms_inpatient_claims")(f"""
{CLAIM_VIEW} 'Outpatient' claim_type, NULL::DATE inpatient_admission_date FROM fact_cms_outpatient_claims
UNION ALL {CLAIM_VIEW} 'Inpatient', clm_admsn_dt FROM fact_cms_inpatient_claims
""")
part(
    "view_rprt_patient_claims",
    "view_fact_patient_claims",
    "dim_cms_beneficiary",
    "dim_cms_provider",
)(f"""
SELECT b.beneficiary_key, desynpuf_id beneficiary_code, bene_birth_dt date_of_birth, bene_death_dt death_date, {SEX} gender,
  sp_state_code state, p.provider_key, provider_id, provider_name, p.state provider_state, claim_id, claim_type,
  claim_start_date, claim_end_date, inpatient_admission_date, claim_payment_amount, primary_payer_claim_paid_amount
FROM view_fact_patient_claims c JOIN dim_cms_beneficiary b USING (beneficiary_key)
LEFT JOIN dim_cms_provider p ON attending_physician_provider_key = p.provider_key
""")
part("view_dim_diagnosis", "c_condition")(f"""
SELECT DISTINCT condition_code diagnosis_code, condition_description description, icd10cm_code, source_system,
  {key_of('condition_code', 'diagnosis_key')} FROM c_condition
""")
BOTH = (
    "(SELECT clm_pmt_amt, clm_from_dt, beneficiary_key, claim_key, 'O' kind FROM fact_cms_outpatient_claims "
    "UNION ALL SELECT clm_pmt_amt, clm_from_dt, beneficiary_key, claim_key, 'I' FROM fact_cms_inpatient_claims)"
)
PAIR = ("fact_cms_outpatient_claims", "fact_cms_inpatient_claims")
PEOPLE = ("view_fact_patient_claims", "view_dim_beneficiary")
TOTALS = "sum(claim_payment_amount)::DOUBLE total_claim_amount, count(*) claim_count"


def running(threshold: int) -> str:
    return with_parts(
        f"SELECT coalesce((SELECT min_by(run, n) FROM r WHERE run >= {threshold}), (SELECT sum(clm_pmt_amt) FROM r), 0)"
        f"::DOUBLE total_until_threshold, {threshold}::DOUBLE threshold",
        "running_total",
    ).replace("running_total AS", "r AS")


part("running_total", PAIR[0])("""
SELECT clm_pmt_amt, row_number() OVER o n, sum(clm_pmt_amt) OVER (o ROWS UNBOUNDED PRECEDING) run
FROM fact_cms_outpatient_claims WINDOW o AS (ORDER BY clm_from_dt, claim_key, clm_pmt_amt)
""")


def claim_summary(where: str) -> str:
    return with_parts(
        "SELECT sp_state_code state, count(*) claim_count, sum(clm_pmt_amt)::DOUBLE total_amount "
        f"FROM {BOTH} JOIN dim_cms_beneficiary USING (beneficiary_key) {where} GROUP BY 1",
        *PAIR,
        "dim_cms_beneficiary",
    )


def claim_total(count: str, total: str) -> str:
    return with_parts(
        f"SELECT count(*) {count}, coalesce(sum(clm_pmt_amt), 0)::DOUBLE {total} FROM {BOTH}", *PAIR
    )


# --- columns that hold decimals, to be compared as doubles -----------------------------

DECIMALS = {
    "cleaned_encounter": "base_cost total_cost payer_coverage patient_responsibility",
    "cleaned_procedure": "procedure_cost",
    "cleaned_medication": "base_cost total_cost payer_coverage patient_cost",
    "cleaned_medication_without_lookups": "base_cost total_cost payer_coverage patient_cost",
    "cleaned_organization": "revenue",
    "cleaned_payer": "amount_covered amount_uncovered revenue quality_of_life_score_avg",
    "cleaned_immunization": "cost",
    "cleaned_claim": "total_amount",
    "cleaned_claimresponse": "submitted_amount payment_amount outstanding_amount benefit_amount",
    "dim_organization": "revenue",
    "dim_payer": "amount_covered amount_uncovered revenue quality_of_life_score_avg",
    "fact_encounter": "base_encounter_cost total_claim_cost payer_coverage_amount patient_responsibility",
    "fact_medication": "base_cost total_cost payer_coverage patient_cost",
    "fact_procedure": "procedure_cost",
    "fact_claim": "submitted_amount patient_liability approved_amount paid_amount outstanding_amount",
    "fact_claim_per_claim": "submitted_amount patient_liability approved_amount paid_amount outstanding_amount",
    "agg_patient_summary": "total_healthcare_cost total_payer_coverage total_patient_cost "
    "total_medication_cost total_procedure_cost",
    "agg_encounter_type_summary": "total_cost",
    "agg_provider_performance": "total_charges total_payer_payments total_patient_charges",
    "agg_medication_utilization": "total_medication_cost total_base_cost total_payer_coverage total_patient_cost",
    "agg_payer_statistics": "total_submitted total_approved total_paid total_outstanding quality_of_life_score_avg",
    "agg_financial_summary": "total_base_cost total_claim_cost total_payer_coverage total_patient_responsibility",
    "agg_financial_summary_of_encounters": "total_base_cost total_claim_cost "
    "total_payer_coverage total_patient_responsibility",
    "fact_cms_inpatient_claims": "clm_pmt_amt nch_prmry_pyr_clm_pd_amt nch_bene_blood_ddctbl_lblty_am "
    "nch_bene_ip_ddctbl_amt nch_bene_pta_coinsrnc_lblty_amt",
    "fact_cms_outpatient_claims": "clm_pmt_amt nch_prmry_pyr_clm_pd_amt nch_bene_blood_ddctbl_lblty_am",
    "fact_cms_prescription_drug_events": "ptnt_pay_amt cvrd_d_plan_pd_amt ncvrd_plan_pd_amt tot_rx_cst_amt",
    "fact_cms_carrier_claims": " ".join(LINE_AMOUNTS),
    "view_fact_patient_claims": "claim_payment_amount primary_payer_claim_paid_amount",
    "view_rprt_patient_claims": "claim_payment_amount primary_payer_claim_paid_amount",
}


def whole(name: str, source: str | None = None) -> str:
    """All columns of one named part, its decimals as doubles."""
    casts = [f'"{d}"::DOUBLE AS "{d}"' for d in DECIMALS.get(name, "").split()]
    shown = f"* REPLACE ({', '.join(casts)})" if casts else "*"
    return with_parts(f"SELECT {shown} FROM {source or name}", source or name)


NULL_DRUG = ", ".join(
    f"NULL::VARCHAR {n}"
    for n in (
        "rxnorm_name rxnorm_term_type ndc_code ndc_proprietary_name ndc_nonproprietary_name "
        "dosage_form route manufacturer"
    ).split()
)

# --- scalar operators ------------------------------------------------------------------

TEXTS = f"""(SELECT p_partkey p,
  ([p_partkey::VARCHAR, '-' || p_partkey || '.5', p_partkey || '.', '.' || p_partkey, p_partkey || 'e5', '+' || p_partkey,
    ' ' || p_partkey || ' ', 'N/A', '', NULL, p_partkey || '99999999999999999999'])[(p_partkey % 11 + 1)::INT] number_text,
  (['2020-02-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0'), '2020-13-45',
    ' 2021-01-' || lpad((p_partkey % 31 + 1)::VARCHAR, 2, '0') || ' ', '2020-01-01 10:30:00', '2020-01-01 10:30',
    '2020/01/01', '', NULL, '1999-12-31 23:' || lpad((p_partkey % 60)::VARCHAR, 2, '0') || ':59'])[(p_partkey % 9 + 1)::INT] date_text
FROM part)"""
NUMERIC = r"regexp_matches(trim(number_text), '^-?\d+\.?\d*$')"
SAFE_CASTS = rf"""
SELECT p, number_text, date_text,
  CASE WHEN regexp_matches(trim(date_text), '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN TRY_CAST(trim(date_text) AS DATE) END as_date,
  CASE WHEN regexp_matches(trim(date_text), '^\d{{4}}-\d{{2}}-\d{{2}}') THEN TRY_CAST(left(trim(date_text), 10) AS DATE) END as_date_lenient,
  CASE WHEN regexp_matches(trim(date_text), '^\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}') THEN
    TRY_CAST(rpad(trim(date_text), 19, ':00') AS TIMESTAMP) END as_timestamp,
  CASE WHEN {NUMERIC} THEN TRY_CAST(trim(number_text) AS DOUBLE) END as_double,
  CASE WHEN {NUMERIC} THEN TRY_CAST(rtrim(trim(number_text), '.') AS DECIMAL(18,2)) END::DOUBLE as_decimal,
  CASE WHEN {NUMERIC} THEN TRY_CAST(rtrim(trim(number_text), '.') AS DECIMAL(10,1)) END::DOUBLE as_decimal_10_1,
  CASE WHEN regexp_matches(trim(number_text), '^-?\d+$') THEN TRY_CAST(trim(number_text) AS BIGINT) END as_long
FROM {TEXTS}"""
MEASURED = r"regexp_matches(number_text, '^-?[0-9]*\.?[0-9]+$')"

UUID = "'00000000-0000-4000-8000-' || lpad(lower(hex({0})), 12, '0')"


def raw_medication_text() -> str:
    stop = "CASE WHEN l_linestatus <> 'O' THEN strftime(l_shipdate + to_days(l_quantity::INT), '%Y-%m-%d %H:%M:%S') END"
    return f"""
SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') "START", {stop} "STOP", o_custkey::VARCHAR PATIENT,
  (l_orderkey % 5)::VARCHAR PAYER, l_orderkey::VARCHAR ENCOUNTER, l_partkey::VARCHAR CODE,
  'Medication ' || l_partkey DESCRIPTION, l_quantity::INT || '.25' BASE_COST, (l_linenumber * 10) || '.00' PAYER_COVERAGE,
  CASE WHEN l_linenumber = 7 THEN '3.0' ELSE l_linenumber::VARCHAR END DISPENSES,
  l_extendedprice::{MONEY}::VARCHAR TOTALCOST, NULL::VARCHAR REASONCODE,
  CASE WHEN l_linenumber % 2 > 0 THEN 'Reason ' || l_linenumber END REASONDESCRIPTION,
  'SYNTHEA.MEDICATIONS' _rec_src, 'EAST' _state
FROM {LINES}"""


def counted(names: list[str], sources: list[str], missing: str | None = None) -> str:
    rows = [
        f"SELECT '{n}' table_name, count(*) row_count, 'OK' status FROM {s}"
        for n, s in zip(names, sources)
    ]
    if missing:
        rows.append(f"SELECT '{missing}', NULL::BIGINT, 'MISSING'")
    return with_parts(" UNION ALL ".join(rows), *sources)


def no_code(parts: str) -> str:
    return f"SELECT NULL::VARCHAR hcpcs_code, NULL::VARCHAR betos_code, count(*) procedure_count FROM {parts}"


LOOKUP_NAMES = [n for n in QUERIES if n.startswith("lookup_")]
CLEANED_NAMES = [n.removeprefix("cleaned_") for n in QUERIES if n.startswith("cleaned_")]
CLEANED_NAMES.remove("medication_without_lookups")
def chunks_of(view: str, source: str, keys: str, value: str, where: str = "true") -> str:
    """Distinct values of each key, as chunks of three would hold them."""
    return (
        f"SELECT '{view}' view_name, concat_ws('|', {keys}) entry, ceil(count(DISTINCT {value}) / 3)::BIGINT chunks, "
        f"least(count(DISTINCT {value}), 3) largest, array_to_string(list_sort(list_distinct(list({value}))), ',') codes "
        f"FROM {source} WHERE {where} GROUP BY {keys}"
    )


CHUNKS = " UNION ALL ".join(
    [
        chunks_of("v_hcpcs_by_betos", "lookup_hcpcs_codes", "betos_code", "hcpcs_code", "betos_code <> ''"),
        chunks_of("v_snomed_icd10cm_all", "lookup_snomed_icd10cm_map", "snomed_concept_id, snomed_concept_name", "icd10cm_code", "has_target = 'true'"),
        chunks_of("v_icd10cm_snomed_reverse", "lookup_snomed_icd10cm_map", "icd10cm_code, icd10cm_name", "snomed_concept_id", "has_target = 'true'"),
        chunks_of("v_rxcui_ndc_all", "lookup_rxnorm_ndc_crosswalk", "rxcui, rxnorm_name, tty", "ndc_11_digit"),
        chunks_of("v_rxnorm_prescribe_drug_ndc_all", "lookup_rxnorm_prescribe_ndc", "rxcui, drug_name, drug_type", "ndc_11_digit"),
        chunks_of("v_rxnorm_prescribe_drugs_expanded", "lookup_rxnorm_prescribe_drug_ingredients", "drug_rxcui, drug_name", "ingredient_name"),
    ]
)
CHUNK_PARTS = (
    "lookup_hcpcs_codes",
    "lookup_snomed_icd10cm_map",
    "lookup_rxnorm_ndc_crosswalk",
    "lookup_rxnorm_prescribe_ndc",
    "lookup_rxnorm_prescribe_drug_ingredients",
)

ORACLE: dict[str, str] = {
    **{f"cleaned_{n}": whole(f"cleaned_{n}", f"c_{n}") for n in CLEANED_NAMES},
    **{n: whole(n) for n in QUERIES if n in PARTS},
    "cleaned_medication_without_lookups": with_parts(
        "SELECT * REPLACE (base_cost::DOUBLE AS base_cost, total_cost::DOUBLE AS total_cost, "
        "payer_coverage::DOUBLE AS payer_coverage, patient_cost::DOUBLE AS patient_cost), "
        f"{NULL_DRUG} FROM c_medication_only",
        "c_medication_only",
    ),
    "lookup_snomed_icd10cm_map": with_parts(
        "SELECT * EXCLUDE (advice, target) FROM lookup_snomed_icd10cm_map", "lookup_snomed_icd10cm_map"
    ),
    "condition_all_targets": with_parts(
        "SELECT condition_code, icd10cm_code, count(*) occurrences FROM c_condition_only "
        "LEFT JOIN lookup_snomed_icd10cm_map ON condition_code = snomed_concept_id GROUP BY 1, 2",
        "c_condition_only",
        "lookup_snomed_icd10cm_map",
    ),
    "src1_csv_scan": raw_medication_text(),
    "src2_symptoms_scan": "SELECT c_custkey::VARCHAR PATIENT, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END GENDER, "
    + pick("['white','black','asian','native','other']", "c_custkey % 5")
    + " RACE, CASE WHEN c_custkey % 4 = 0 THEN 'hispanic' ELSE 'nonhispanic' END ETHNICITY, "
    + ", ".join(
        f"'{n}:' || c_custkey {n}"
        for n in ("AGE_BEGIN", "AGE_END", "PATHOLOGY", "NUM_SYMPTOMS", "SYMPTOMS")
    )
    + ", 'SYNTHEA.SYMPTOMS' _rec_src, 'WEST' _state FROM customer",
    "src3_notes": f"SELECT {UUID.format('doc_id')} patient_id, 'Person' || doc_id patient_name, text note_content, "
    "lang _state, 'SYNTHEA.NOTES' _rec_src FROM documents WHERE text <> ''",
    "src4_encounter_notes": f"SELECT {UUID.format('conv_id')} patient_id, turn::VARCHAR encounter_number, "
    "text encounter_content, role _state, 'SYNTHEA.TEXT_ENCOUNTERS' _rec_src FROM conversations WHERE text <> ''",
    "src5_tab_scan": with_parts(
        "SELECT product_id, product_ndc, ndc_package_code, package_description, start_marketing_date, "
        "nullif(end_marketing_date, '') end_marketing_date, ndc_exclude_flag, sample_package FROM lookup_ndc_package",
        "lookup_ndc_package",
    ),
    "src6_pipe_scan": with_parts(
        """SELECT * REPLACE ('"' || "name" AS "name") FROM atom_rows""", "atom_rows"
    ),
    "src7_short_pipe_scan": "SELECT p_partkey::VARCHAR cui1, '20AA' ver_start, "
    "CASE WHEN p_partkey % 2 = 0 THEN '21AB' END ver_end, "
    "CASE WHEN p_partkey % 2 = 0 THEN p_size::VARCHAR END cardinality FROM part",
    "src8_fixed_width_scan": with_parts(
        f"SELECT hcpcs_code, {', '.join(HCPCS_FIELDS)} FROM hcpcs_fields",
        "hcpcs_fields",
    ),
    "src8_fixed_width_icd": with_parts("SELECT * EXCLUDE (p_partkey) FROM icd_fields", "icd_fields"),
    "src10_optional_lookup": with_parts(no_code("c_procedure_only"), "c_procedure_only"),
    "src13_state_folders": "SELECT DISTINCT n_name state FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "WHERE c_custkey % 5 > 0",
    "snk2_write_and_count": with_parts(
        "SELECT 'silver' stage, 'v_encounter_flattened' table_name, count(*) row_count, true success FROM c_encounter",
        "c_encounter",
    ),
    "snk4_live_views": with_parts(
        "SELECT 'v_hcpcs_active' view_name, hcpcs_code code, short_description \"label\" FROM v_hcpcs_active UNION ALL "
        "SELECT 'v_icd10cm_billable', icd10cm_code, short_description FROM v_icd10cm_billable UNION ALL "
        "SELECT 'v_ndc_active', ndc_package_code, proprietary_name FROM v_ndc_active",
        "v_hcpcs_active",
        "v_icd10cm_billable",
        "v_ndc_active",
    ),
    "scl_safe_casts": SAFE_CASTS,
    "scl_observation_split": f"SELECT p, number_text, CASE WHEN {MEASURED} THEN "
    "TRY_CAST(number_text AS DECIMAL(18,6)) END::DOUBLE numeric_value, "
    f"CASE WHEN NOT {MEASURED} THEN number_text END string_value FROM {TEXTS}",
    "scl_keys": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, "
    f"{sha('CASE WHEN l_linenumber > 1 THEN l_returnflag END')} single_key, "
    f"{sha('l_orderkey', 'CASE WHEN l_linenumber > 2 THEN l_partkey END')} pair_key, "
    f"{day_key('l_shipdate')} ship_date_key, {sha('l_returnflag', 'l_linestatus')} id FROM lineitem",
    "scl_code_formats": f"SELECT ndc_package_code, ndc11, ndc9, "
    "CASE WHEN length(u) IN (10, 11) THEN lpad(u, 11, '0') END crosswalk, u undashed, "
    "left(u, 3) || '.' || substr(u, 4) dotted, "
    "CASE length(product_ndc) - 3 WHEN 6 THEN 'SUBCATEGORY_3' WHEN 7 THEN 'FULL_CODE' ELSE 'UNKNOWN' END \"level\", "
    "'CPT' family, left(u, 4) || '-' || substr(u, 5, 2) || '-' || substr(u, 7, 2) dashed_date FROM "
    f"(SELECT {NDC} ndc_package_code, {PRODUCT_NDC} product_ndc, {NDC11} ndc11, {NDC9} ndc9, replace({NDC}, '-', '') u FROM part)",
    "scl_measures": "SELECT k o_orderkey, floor(date_diff('day', DATE '1950-06-15', o_orderdate::DATE) / 365.25)::INT \"years\", "
    f"{pct('(k % 7)', '(k % 4)')} rate, "
    f"{per_head('o_totalprice::DECIMAL(18,2)', 'CASE WHEN k % 3 > 0 THEN k % 5 END')} per_head, "
    "CASE WHEN o_totalprice >= 5000 THEN 'High Cost' WHEN o_totalprice >= 1000 THEN 'Medium Cost' ELSE 'Low Cost' END tier, "
    "CASE WHEN k % 40 >= 35 THEN 'Adult (35-49)' WHEN k % 40 >= 18 THEN 'Young Adult (18-34)' ELSE 'Young' END \"group\", "
    "CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'other' END status, "
    "CASE WHEN k % 3 = 2 THEN 'closed' ELSE 'active' END open_status, "
    "((k % 2 > 0)::INT + (k % 3 > 0)::INT + (k % 4 > 0)::INT + (k % 5 > 0)::INT) slots, "
    "CASE WHEN k % 2 = 0 AND o_orderstatus = 'F' THEN 'true' ELSE 'false' END flag, "
    "CASE WHEN k % 3 > 0 THEN (k % 5)::DOUBLE / (k % 3)::DOUBLE END ratio FROM (SELECT *, o_orderkey k FROM orders)",
    "rows_first_n_as_columns": "SELECT l_orderkey, "
    + ", ".join(f"max(l_partkey) FILTER (n = {i}) part{i}" for i in range(1, 11))
    + " FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, "
    "l_shipdate) n FROM lineitem) GROUP BY 1",
    "rows_best_row": "SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem QUALIFY "
    "row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) = 1",
    "rows_numbered": "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate::DATE \"day\", row_number() OVER "
    f"(PARTITION BY l_suppkey ORDER BY l_shipdate::DATE, {sha('l_orderkey', 'l_linenumber', 'l_partkey')})::INT line_num FROM lineitem",
    "rows_left_join_hot_right": "SELECT c_custkey \"key\", c_name, o_orderkey FROM customer LEFT JOIN orders "
    "ON o_custkey = c_custkey",
    "q1_totals_by_year_state_gender": with_parts(
        f"SELECT year(claim_start_date)::INT \"year\", state, gender, {TOTALS} FROM view_fact_patient_claims "
        "JOIN view_dim_beneficiary USING (beneficiary_key) GROUP BY 1, 2, 3",
        *PEOPLE,
    ),
    "q2_totals_by_state": with_parts(
        f"SELECT state, {TOTALS} FROM view_fact_patient_claims JOIN view_dim_beneficiary USING (beneficiary_key) GROUP BY 1",
        *PEOPLE,
    ),
    "q3_totals_in_year": with_parts(
        f"SELECT state, gender, {TOTALS} FROM view_fact_patient_claims JOIN view_dim_beneficiary USING (beneficiary_key) "
        f"WHERE year(claim_start_date) = {YEAR} GROUP BY 1, 2",
        *PEOPLE,
    ),
    "q4_report_by_year_gender": with_parts(
        f"SELECT year(claim_start_date)::INT \"year\", gender, {TOTALS} FROM view_rprt_patient_claims GROUP BY 1, 2",
        "view_rprt_patient_claims",
    ),
    "q5_report_by_state": with_parts(
        f"SELECT state, {TOTALS} FROM view_rprt_patient_claims GROUP BY 1", "view_rprt_patient_claims"
    ),
    "q6_row_counts": counted(
        [n.removeprefix("view_") for n in QUERIES if n.startswith("view_")],
        [n for n in QUERIES if n.startswith("view_")],
    ),
    "q7_local_provider": with_parts(
        "SELECT * REPLACE (claim_payment_amount::DOUBLE AS claim_payment_amount, "
        "primary_payer_claim_paid_amount::DOUBLE AS primary_payer_claim_paid_amount) "
        f"FROM view_rprt_patient_claims WHERE provider_state = '{LOCAL_STATE}'",
        "view_rprt_patient_claims",
    ),
    "q8_state_and_year": with_parts(
        "SELECT count(*) claim_count FROM view_rprt_patient_claims "
        f"WHERE state = '{HOME_STATE}' AND year(claim_start_date) = {YEAR}",
        "view_rprt_patient_claims",
    ),
    "q9_top_claim_diagnoses": with_parts(
        "SELECT DISTINCT claim_key claim_id, clm_pmt_amt::DOUBLE claim_payment_amount, code, diagnosis_code, description FROM "
        "(SELECT claim_key, clm_pmt_amt, unnest(["
        + ", ".join(f"icd_dgns_cd{i}" for i in range(1, 11))
        + "]) code FROM (SELECT * FROM (SELECT claim_key, clm_pmt_amt, COLUMNS('icd_dgns_cd.*') FROM fact_cms_outpatient_claims "
        "UNION ALL SELECT claim_key, clm_pmt_amt, COLUMNS('icd_dgns_cd.*') FROM fact_cms_inpatient_claims) "
        "ORDER BY clm_pmt_amt DESC, claim_key LIMIT 10)) JOIN view_dim_diagnosis ON code = coalesce(icd10cm_code, diagnosis_code)",
        *PAIR,
        "view_dim_diagnosis",
    ).replace("COLUMNS('icd_dgns_cd.*')", ", ".join(f"icd_dgns_cd{i}" for i in range(1, 11))),
    "udf1_predicted_amounts": with_parts(
        "SELECT DISTINCT b.beneficiary_code, state, gender, predicted_amount FROM view_fact_patient_claims "
        "JOIN view_dim_beneficiary b USING (beneficiary_key) JOIN (SELECT state, gender, "
        + avg6("claim_payment_amount")
        + " predicted_amount FROM view_fact_patient_claims JOIN view_dim_beneficiary USING (beneficiary_key) GROUP BY 1, 2) "
        "USING (state, gender)",
        *PEOPLE,
    ),
    "scp1_claim_totals": claim_total("num_claims", "total_payment"),
    "scp2_year_range": with_parts(
        f"SELECT min(year(clm_from_dt))::INT min_year, max(year(clm_from_dt))::INT max_year FROM {BOTH}", *PAIR
    ),
    "scp3_claim_profile": with_parts(
        "SELECT n claim_count, t::DOUBLE total, CASE WHEN i > 0 THEN 'Inpatient claims' ELSE 'Outpatient claims' END description, "
        "CASE WHEN t < 1000 THEN 'Low' WHEN t < 100000 THEN 'Medium' WHEN t < 1000000 THEN 'High' ELSE 'Very high' END tier, "
        "CASE WHEN n = 0 THEN 'No claims' WHEN n < 1000 THEN 'Small dataset' WHEN n < 100000 THEN 'Medium dataset' "
        "ELSE 'Large dataset' END message, CASE WHEN i > 0 AND n > i THEN 'Both claim types present' WHEN i > 0 THEN "
        "'Inpatient only' WHEN n > 0 THEN 'Outpatient only' ELSE 'No claims' END result FROM (SELECT count(*) n, "
        f"count(*) FILTER (kind = 'I') i, coalesce(sum(clm_pmt_amt), 0) t FROM {BOTH})",
        *PAIR,
    ),
    "scp4_total_until": running(50000),
    "scp4_total_until_far": running(98765432),
    "scp4_total_until_never": running(10**14),
    "scp5_positive_payments": with_parts(
        "SELECT count(*) nonzero_count, coalesce(sum(clm_pmt_amt), 0)::DOUBLE total_amt "
        "FROM fact_cms_outpatient_claims WHERE clm_pmt_amt > 0",
        PAIR[0],
    ),
    "scp6_states_seen": with_parts(
        "SELECT string_agg(s, ', ' ORDER BY s) states_seen FROM (SELECT DISTINCT sp_state_code s FROM dim_cms_beneficiary "
        "ORDER BY 1 LIMIT 5)",
        "dim_cms_beneficiary",
    ),
    "scp7_loop_bounds": with_parts(
        f"SELECT least(count(*), 10) target_count, (SELECT count(DISTINCT sp_state_code) FROM dim_cms_beneficiary) distinct_states FROM {BOTH}",
        *PAIR,
        "dim_cms_beneficiary",
    ),
    "scp8_claim_summary_all": claim_summary(""),
    "scp8_claim_summary_state": claim_summary(f"WHERE sp_state_code = '{HOME_STATE}'"),
    "scp9_claim_totals_out": claim_total("total_count", "total_amount"),
    "scp10_safe_ratio": "SELECT o_orderkey, o_orderkey % 9 part, o_orderkey % 4 whole, "
    "CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 9)::DOUBLE / (o_orderkey % 4)::DOUBLE END ratio, "
    "CASE WHEN o_orderkey % 4 = 0 THEN 'DIVIDE_BY_ZERO' END \"error\" FROM orders",
    "scp11_rejects": "SELECT *, 'CAST_INVALID_INPUT' error_condition FROM (SELECT c_custkey::VARCHAR record_key, "
    "'BIRTHDATE' source_column, '2020-13-45' source_value, 'The value ''2020-13-45'' cannot be read as DATE.' error_message "
    "FROM customer WHERE c_custkey % 97 = 5 UNION ALL SELECT c_custkey::VARCHAR, 'INCOME', 'N/A', "
    "'The value ''N/A'' cannot be read as DOUBLE.' FROM customer WHERE c_custkey % 13 = 0)",
    "scp12_data_checks": with_parts(
        f"SELECT 'claims_present' check_name, count(*) observed, true passed, NULL::VARCHAR message, s state FROM {BOTH}, "
        f"(SELECT unnest(['{HOME_STATE}', 'XX']) s) GROUP BY s UNION ALL SELECT 'state_known', count(*), true, NULL, '{HOME_STATE}' "
        f"FROM dim_cms_beneficiary WHERE sp_state_code = '{HOME_STATE}' UNION ALL SELECT 'state_known', count(*), false, "
        "'No beneficiaries found for the given state.', 'XX' FROM dim_cms_beneficiary WHERE sp_state_code = 'XX'",
        *PAIR,
        "dim_cms_beneficiary",
    ),
    "run1_table_check": counted(LOOKUP_NAMES, LOOKUP_NAMES, "lookup_absent"),
    "run2_stage_summary": with_parts(
        "SELECT 'silver' stage, 2::BIGINT tables_processed, 2::BIGINT tables_successful, "
        "((SELECT count(*) FROM c_patient) + (SELECT count(*) FROM c_encounter))::BIGINT total_rows, true elapsed_seconds, "
        "true success, '' errors UNION ALL SELECT 'gold', 2, 1, (SELECT count(*) FROM c_payer), true, false, "
        "'needs v_absent, which failed in this run'",
        "c_patient",
        "c_encounter",
        "c_payer",
    ),
    "src14_catalog": with_parts(
        "SELECT t table_name, k column_name, want data_type, got found_type, s status, "
        "CASE t WHEN 'lookup_hcpcs_codes' THEN (SELECT count(*) FROM lookup_hcpcs_codes) "
        "WHEN 'v_hcpcs_pricing_summary' THEN (SELECT count(*) FROM v_hcpcs_pricing_summary) END row_count FROM (VALUES "
        "('lookup_hcpcs_codes', 'hcpcs_code', 'string', 'string', 'OK'), "
        "('lookup_hcpcs_codes', 'is_active', 'string', 'boolean', 'OTHER TYPE'), "
        "('lookup_hcpcs_codes', 'retired_on', 'date', NULL, 'MISSING'), "
        "('v_hcpcs_pricing_summary', 'pricing_indicator', 'string', 'string', 'OK'), "
        "('v_hcpcs_pricing_summary', 'coverage_code', 'string', 'string', 'OK'), "
        "('v_hcpcs_pricing_summary', 'code_count', 'bigint', 'bigint', 'OK'), "
        "('lookup_absent', 'code', 'string', NULL, 'TABLE MISSING')) v(t, k, want, got, s)",
        "lookup_hcpcs_codes",
        "v_hcpcs_pricing_summary",
    ),
    "prj2_lineage": "SELECT 'R' || n_regionkey _state, 'SYNTHEA.ORGANIZATIONS' _rec_src, count(*) \"rows\", count(*) loaded, "
    "count(*) \"lines\", true every_file_matches FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey",
    "agg9_code_chunks": with_parts(CHUNKS, *CHUNK_PARTS),
    "agg9_hot_key_chunks": "SELECT l_returnflag, ceil(count(DISTINCT l_orderkey) / 500)::BIGINT chunks, "
    "least(count(DISTINCT l_orderkey), 500) largest, count(DISTINCT l_orderkey) orders, count(DISTINCT l_orderkey) distinct_orders, "
    "sum(DISTINCT l_orderkey)::BIGINT key_sum FROM lineitem GROUP BY 1",
    "jn7_interval_join": "SELECT s_suppkey, count(*) \"lines\", sum(price)::BIGINT cents, sum(l_quantity)::BIGINT quantity FROM "
    "(SELECT round(l_extendedprice * 100)::BIGINT price, l_quantity FROM lineitem) JOIN (SELECT s_suppkey, lo, "
    "lo + (10 ** (s_suppkey % 5))::BIGINT * 10 - CASE WHEN s_suppkey % 11 = 0 THEN 200000 ELSE 0 END hi "
    "FROM (SELECT s_suppkey, s_suppkey * 7919 % 9000000 lo FROM supplier)) ON price BETWEEN lo AND hi GROUP BY 1",
    "jn7_days_in_orders": "SELECT person, count(*) hits, count(DISTINCT event_id) events, sum(o_orderkey)::BIGINT order_sum FROM "
    "(SELECT user_id + 1 person, event_id, DATE '1995-01-01' + (event_id * 7 % 2400)::INT seen FROM events) e JOIN "
    "(SELECT o_custkey person, o_orderkey, o_orderdate::DATE opened FROM orders) o USING (person) "
    "WHERE seen BETWEEN opened AND opened + 30 GROUP BY 1",
    "udf1_fitted_weights": "WITH m AS (SELECT l_quantity::DOUBLE a, l_discount::DOUBLE b, l_extendedprice::DOUBLE y FROM lineitem), "
    "s AS (SELECT count(*) n, avg(a) ma, avg(b) mb, avg(y) my, var_pop(a) aa, var_pop(b) bb, covar_pop(a, b) ab, "
    "covar_pop(a, y) ay, covar_pop(b, y) by_ FROM m), "
    "w AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) wb FROM s) "
    "SELECT 'intercept' term, round(my - wa * ma - wb * mb, 4) weight, n \"rows\" FROM w UNION ALL "
    "SELECT 'quantity', round(wa, 4), n FROM w UNION ALL SELECT 'discount', round(wb, 4), n FROM w UNION ALL "
    "SELECT 'mean score', round(my, 4), n FROM w",
    "udf1_fitted_by_state": with_parts(
        "SELECT state, count(*) claims, round(avg(k.b0 + k.b1 * year(claim_start_date)), 3) mean_score FROM view_rprt_patient_claims, "
        "(SELECT regr_slope(claim_payment_amount::DOUBLE, year(claim_start_date)::DOUBLE) b1, "
        "regr_intercept(claim_payment_amount::DOUBLE, year(claim_start_date)::DOUBLE) b0 FROM view_rprt_patient_claims) k "
        "WHERE claim_start_date IS NOT NULL GROUP BY state",
        "view_rprt_patient_claims",
    ),
    "ord1_in_order": with_parts(
        "SELECT 'agg_readmission_rates' result, count(*) row_count, true in_order FROM agg_readmission_rates UNION ALL "
        "SELECT 'agg_financial_summary_of_encounters', count(*), true FROM agg_financial_summary_of_encounters UNION ALL "
        "SELECT 'orders by price', count(*), true FROM orders UNION ALL "
        "SELECT 'first orders by price', least(count(*), 100), true FROM orders UNION ALL "
        "SELECT 'orders shuffled', count(*), false FROM orders",
        "agg_readmission_rates",
        "agg_financial_summary_of_encounters",
    ),
}
