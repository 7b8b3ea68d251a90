"""DuckDB statements of the derived tables, written from the given tables directly.

Each entry of ``PARTS`` is a named query with the names it builds on; ``with_parts`` puts
the needed ones in front of a final query. Money is decimal here and becomes double in
the final select, as in the Spark results.
"""

from __future__ import annotations

CHRONIC = (
    "['26929004','42343007','709044004','363346000','13645005','35489007',"
    "'44054006','414545008','64859006','69896004','230690007','90688005']"
)


def condition_code(p: str) -> str:
    return f"CASE WHEN {p} % 40 < 12 THEN {CHRONIC}[({p} % 40 + 1)::INT] ELSE {p}::VARCHAR END"


def icd_raw(p: str) -> str:
    return (
        f"(chr((65 + {p} % 26)::INT) || CASE WHEN {p} < 1000000 THEN "
        f"lpad({p}::VARCHAR, greatest(2 + {p} % 5, length({p}::VARCHAR))::INT, '0') "
        f"ELSE to_base({p} + {10 * 36**5 - 1_000_000}, 36, 6) END)"
    )


def dotted(raw: str) -> str:
    return f"CASE WHEN length({raw}) > 3 THEN left({raw}, 3) || '.' || substr({raw}, 4) ELSE {raw} END"


def hcpcs(p: str) -> str:
    rest, span = f"({p} - 20000)", 36**4
    return (
        f"CASE WHEN {p} >= 20000 THEN chr((70 + {rest} // {span})::INT) || to_base({rest} % {span}, 36, 4) "
        f"WHEN {p} % 2 = 0 THEN lpad({p}::VARCHAR, 5, '0') "
        f"ELSE chr((65 + {p} % 5)::INT) || lpad(({p} // 2)::VARCHAR, 4, '0') END"
    )


A8, B9 = "lpad(p_partkey::VARCHAR, 8, '0')", "lpad(p_partkey::VARCHAR, 9, '0')"
NDC = (
    f"CASE p_partkey % 4 WHEN 0 THEN left({A8},4) || '-' || right({A8},4) || '-10' "
    f"WHEN 1 THEN left({A8},5) || '-' || right({A8},3) || '-20' "
    f"WHEN 2 THEN left({B9},5) || '-' || right({B9},4) || '-3' "
    f"ELSE left({B9},5) || '-' || right({B9},4) || '-40' END"
)
PRODUCT_NDC = (
    f"CASE p_partkey % 4 WHEN 0 THEN left({A8},4) || '-' || right({A8},4) "
    f"WHEN 1 THEN left({A8},5) || '-' || right({A8},3) "
    f"ELSE left({B9},5) || '-' || right({B9},4) END"
)
NDC11 = (
    f"CASE p_partkey % 4 WHEN 0 THEN '0' || {A8} || '10' "
    f"WHEN 1 THEN left({A8},5) || '0' || right({A8},3) || '20' "
    f"WHEN 2 THEN {B9} || '03' ELSE {B9} || '40' END"
)
NDC9 = (
    f"CASE p_partkey % 4 WHEN 0 THEN '0' || {A8} "
    f"WHEN 1 THEN left({A8},5) || '0' || right({A8},3) ELSE {B9} END"
)


def sha(*parts: str) -> str:
    """Digest of the parts, absent ones read as empty."""
    filled = ", ".join(f"coalesce(({p})::VARCHAR, '')" for p in parts)
    return f"sha256(concat_ws('|', {filled}))"


def day_key(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))::INT"


def avg6(x: str) -> str:
    """Mean of two-place decimals rounded half up at six places, by whole numbers."""
    s, n = f"sum(({x} * 100)::HUGEINT)", f"count({x})"
    return (
        f"(CASE WHEN {n} > 0 THEN sign({s}) * ((2 * abs({s}) * 10000 + {n}) // (2 * {n})) END)"
        "::DOUBLE / 1000000"
    )


def _cents(x: str) -> str:
    return f"(({x}) * 100)::HUGEINT"


def _half_up(top: str, bottom: str) -> str:
    """Whole quotient rounded half away from zero."""
    return f"(sign({top}) * ((2 * abs({top}) + {bottom}) // (2 * {bottom})))"


def pct(part: str, whole: str) -> str:
    """Percentage rounded half up at two places, by whole numbers."""
    rounded = _half_up(f"({_cents(part)} * 10000)", _cents(whole))
    return f"CASE WHEN {whole} > 0 THEN {rounded}::DOUBLE / 100 ELSE 0.0::DOUBLE END"


def per_head(amount: str, heads: str) -> str:
    """Amount per head at two places, with at least one head."""
    return f"({_half_up(_cents(amount), f'greatest(coalesce({heads}, 0), 1)::HUGEINT')}::DOUBLE / 100)"


AS_OF = "DATE '2002-01-01'"
MONEY = "DECIMAL(18,2)"
STOP = "CASE WHEN l_linestatus <> 'O' THEN l_shipdate + to_days(l_quantity::INT) END"
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def pick(values: str, index: str) -> str:
    return f"({values})[({index} + 1)::INT]"


PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, *needs: str):
    def add(sql: str) -> None:
        PARTS[name] = (needs, sql)

    return add


def with_parts(sql: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in PARTS[name][0]:
            visit(needed)
        ordered.append(name)

    for need in needs:
        visit(need)
    if not ordered:
        return sql
    listed = ", ".join(f"{n} AS ({PARTS[n][1]})" for n in ordered)
    return f"WITH {listed} {sql}"


# --- cleaned layer ---------------------------------------------------------------------

part("c_patient")(f"""
SELECT c_custkey::VARCHAR patient_id, split_part(c_name,'#',1) first_name,
  CASE WHEN c_custkey % 4 = 0 THEN 'Q' END middle_name, split_part(c_name,'#',2) last_name,
  CASE WHEN c_custkey % 3 > 0 THEN 'Mx.' END name_prefix,
  CASE WHEN c_custkey % 10 = 0 THEN 'PhD' END name_suffix,
  c_name address_line, n_name || ' City' city, n_name state,
  lpad((c_custkey % 100000)::VARCHAR, 5, '0') postal_code, n_name || ' County' county,
  {pick("['M','S','D','W',NULL]", "c_custkey % 5")} marital_status_code,
  c_custkey::VARCHAR medical_record_number, '999-' || c_custkey ssn_last_four,
  birth birth_date, death death_date,
  ((c_custkey % 180 - 90)::VARCHAR || '.25')::DOUBLE latitude,
  ((c_custkey % 360 - 180)::VARCHAR || '.5')::DOUBLE longitude,
  c_acctbal::{MONEY}::DOUBLE healthcare_expenses, (c_custkey || '.75')::DOUBLE healthcare_coverage,
  CASE WHEN c_custkey % 13 > 0 THEN c_acctbal::{MONEY}::DOUBLE END income,
  'US' country, 'SYNTHEA.PATIENTS' source_system, n_name source_state,
  CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END gender, death IS NOT NULL is_deceased,
  floor(date_diff('day', birth, coalesce(death, {AS_OF})) / 365.25)::INT age_years,
  {pick("['Married','Never Married','Divorced','Widowed',NULL]", "c_custkey % 5")} marital_status,
  {pick("['White','Black','Asian','Native','Other']", "c_custkey % 5")} race,
  CASE WHEN c_custkey % 4 = 0 THEN 'Hispanic or Latino' ELSE 'Not Hispanic or Latino' END ethnicity
FROM (SELECT *, CASE WHEN c_custkey % 97 <> 5 THEN DATE '1940-01-01' + (c_custkey * 37 % 22000)::INT END birth,
        CASE WHEN c_custkey % 11 = 0 THEN DATE '2001-01-01' + (c_custkey % 300)::INT END death
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
""")

part("c_encounter")(f"""
SELECT *, coalesce(total_cost, 0) - coalesce(payer_coverage, 0) patient_responsibility,
  CASE encounter_class WHEN 'inpatient' THEN 'IMP' WHEN 'emergency' THEN 'EMER' ELSE 'AMB' END encounter_class_code,
  date_diff('second', start_datetime, end_datetime) // 60 duration_minutes,
  encounter_class = 'emergency' is_emergency, encounter_class = 'inpatient' is_inpatient,
  encounter_class IN ('ambulatory','outpatient','wellness','urgentcare') is_ambulatory
FROM (SELECT o_orderkey::VARCHAR encounter_id, o_custkey::VARCHAR patient_id,
  CASE WHEN o_orderkey % 41 > 0 THEN (o_orderkey % 10)::VARCHAR END provider_id,
  (o_orderkey % 25)::VARCHAR organization_id, (o_orderkey % 5)::VARCHAR payer_id,
  CASE left(o_orderpriority,1) WHEN '1' THEN 'emergency' WHEN '2' THEN 'inpatient' WHEN '3' THEN 'ambulatory'
    WHEN '4' THEN 'outpatient' ELSE CASE WHEN o_orderkey % 31 = 0 THEN 'hospice'
      WHEN o_orderkey % 3 = 0 THEN 'urgentcare' ELSE 'wellness' END END encounter_class,
  o_orderstatus encounter_type_code, 'Encounter ' || o_orderstatus encounter_type,
  CASE WHEN o_orderkey % 3 > 0 THEN 'R' || (o_orderkey % 10) END reason_code,
  CASE WHEN o_orderkey % 3 > 0 THEN 'Reason ' || (o_orderkey % 10) END reason_description,
  o_orderdate start_datetime,
  CASE WHEN o_orderkey % 17 > 0 THEN o_orderdate + to_hours((o_orderkey % 72)::INT) END end_datetime,
  ((o_orderkey % 1000) || '.50')::{MONEY} base_cost, o_totalprice::{MONEY} total_cost,
  CASE WHEN o_orderkey % 19 > 0 THEN ((o_orderkey % 50 * 1000) || '.25')::{MONEY} END payer_coverage,
  'finished' encounter_status, 'SYNTHEA.ENCOUNTERS' source_system, 'ALL' source_state FROM orders)
""")

CONDITION_BASE = f"""
SELECT o_custkey::VARCHAR patient_id, l_orderkey::VARCHAR encounter_id, code condition_code,
  'Condition ' || code condition_description, l_shipdate::DATE onset_date, stop::DATE abatement_date,
  {sha("o_custkey", "code", "l_shipdate::DATE")} condition_id, 'http://snomed.info/sct' code_system,
  'encounter-diagnosis' category_code, 'Encounter Diagnosis' category_display,
  'confirmed' verification_status, 'SYNTHEA.CONDITIONS' source_system,
  CASE WHEN stop IS NULL THEN 'active' ELSE 'resolved' END clinical_status,
  l_shipdate::DATE recorded_date, date_diff('day', l_shipdate, stop)::INT duration_days,
  stop IS NULL is_active, stop IS NOT NULL is_resolved
FROM (SELECT *, {STOP} stop, {condition_code('l_partkey')} code FROM {LINES})
"""
part("c_condition_only")(CONDITION_BASE)
part("c_condition", "c_condition_only", "v_snomed_icd10cm_simple")("""
SELECT b.*, m.icd10cm_code, m.icd10cm_name FROM c_condition_only b
LEFT JOIN v_snomed_icd10cm_simple m ON condition_code = snomed_concept_id
""")

part("c_observation")("""
SELECT user_id::VARCHAR patient_id, event_id::VARCHAR encounter_id, event_type observation_code,
  'Observed ' || event_type observation_description, units value_unit, units unit_code,
  ts effective_datetime, ts::DATE effective_date,
  sha256(concat_ws('|', user_id::VARCHAR, event_type, ts::VARCHAR, event_id::VARCHAR)) observation_id,
  'http://loinc.org' code_system, 'final' observation_status, 'SYNTHEA.OBSERVATIONS' source_system,
  coalesce(lower(category), 'laboratory') category_code,
  coalesce(upper(left(category,1)) || lower(substr(category,2)), 'Laboratory') category_display,
  num::DOUBLE numeric_value, txt string_value,
  coalesce(num::VARCHAR || ' ' || units, txt) display_value,
  category = 'vital-signs' is_vital_sign, category = 'laboratory' is_lab_result, category = 'survey' is_survey
FROM (SELECT *, CASE WHEN event_id % 3 > 0 THEN 'mg' END units,
    CASE event_type WHEN 'view' THEN 'vital-signs' WHEN 'click' THEN 'laboratory'
      WHEN 'signup' THEN 'survey' WHEN 'purchase' THEN 'Procedure' END category,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 0.5::DECIMAL(18,6)
      WHEN event_id % 5 = 0 THEN NULL ELSE value::DECIMAL(18,2)::DECIMAL(18,6) END num,
    CASE WHEN event_id % 23 = 0 OR event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN event_type END txt
  FROM events)
""")

part("c_procedure_only")(f"""
SELECT o_custkey::VARCHAR patient_id, l_orderkey::VARCHAR encounter_id, code procedure_code,
  'Procedure ' || l_partkey procedure_description,
  CASE WHEN l_linenumber % 2 > 0 THEN 'R' || l_linenumber END reason_code,
  CASE WHEN l_linenumber % 2 > 0 THEN 'Reason ' || l_linenumber END reason_description,
  l_shipdate start_datetime, stop end_datetime,
  CASE WHEN l_linenumber <> 7 THEN ((l_quantity::INT * 150) || '.50')::{MONEY} END procedure_cost,
  {sha("o_custkey", "code", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')", "l_orderkey")} procedure_id,
  'http://snomed.info/sct' code_system, 'completed' procedure_status, 'SYNTHEA.PROCEDURES' source_system,
  l_shipdate::DATE performed_date
FROM (SELECT *, {STOP} stop, {hcpcs('l_partkey')} code FROM {LINES})
""")
part("c_procedure", "c_procedure_only", "lookup_hcpcs_codes")("""
SELECT p.*, h.hcpcs_code, h.short_description hcpcs_description, h.code_type hcpcs_code_type, h.betos_code
FROM c_procedure_only p LEFT JOIN lookup_hcpcs_codes h ON procedure_code = hcpcs_code AND h.is_active
""")

part("c_medication_only")(f"""
SELECT o_custkey::VARCHAR patient_id, l_orderkey::VARCHAR encounter_id, (l_orderkey % 5)::VARCHAR payer_id,
  l_partkey::VARCHAR medication_code, 'Medication ' || l_partkey medication_description,
  CASE WHEN l_linenumber % 2 > 0 THEN 'Reason ' || l_linenumber END reason_description,
  l_shipdate start_datetime, stop end_datetime, (l_quantity::INT || '.25')::{MONEY} base_cost,
  l_extendedprice::{MONEY} total_cost, (l_linenumber * 10)::{MONEY} payer_coverage,
  {sha("o_custkey", "l_partkey", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')")} medication_id,
  'http://www.nlm.nih.gov/research/umls/rxnorm' code_system, 'order' rx_intent,
  'SYNTHEA.MEDICATIONS' source_system, CASE WHEN stop IS NULL THEN 'active' ELSE 'completed' END rx_status,
  l_shipdate::DATE prescribed_date,
  CASE WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber - 1 END::BIGINT refills_allowed,
  (l_extendedprice::{MONEY} - l_linenumber * 10)::{MONEY} patient_cost, stop IS NULL is_active
FROM (SELECT *, {STOP} stop FROM {LINES})
""")
part(
    "c_medication",
    "c_medication_only",
    "lookup_rxnorm_concepts",
    "lookup_rxnorm_ndc_crosswalk",
    "lookup_ndc_product",
)(f"""
SELECT m.*, c.rxnorm_name, c.tty rxnorm_term_type, x.ndc_code,
  p.proprietary_name ndc_proprietary_name, p.nonproprietary_name ndc_nonproprietary_name,
  p.dosage_form_name dosage_form, p.route_name route, p.labeler_name manufacturer
FROM c_medication_only m LEFT JOIN lookup_rxnorm_concepts c ON medication_code = c.rxcui
LEFT JOIN (SELECT rxcui, min(ndc_11_digit) ndc_code FROM lookup_rxnorm_ndc_crosswalk GROUP BY 1) x
  ON medication_code = x.rxcui
LEFT JOIN (SELECT l.*, {NDC9} key9 FROM lookup_ndc_product l JOIN part ON product_id = p_partkey || '_prod') p
  ON left(ndc_code, 9) = key9
""")

part("c_organization")(f"""
SELECT n_nationkey::VARCHAR organization_id, 'Hospital ' || n_name "name", n_nationkey || ' Main St' address_line,
  n_name || ' City' city, n_name state, lpad(n_nationkey::VARCHAR, 5, '0') postal_code,
  '555-' || n_nationkey phone, n_nationkey::DOUBLE latitude, ('-' || n_nationkey || '.5')::DOUBLE longitude,
  (n_nationkey * 1000 + 0.5)::{MONEY} revenue, (n_nationkey * n_nationkey * 50)::BIGINT utilization, true active,
  'prov' type_code, 'Healthcare Provider' type_display, 'US' country, 'SYNTHEA.ORGANIZATIONS' source_system
FROM nation
""")
part("c_practitioner")("""
SELECT s_suppkey::VARCHAR practitioner_id, s_nationkey::VARCHAR organization_id, s_name "name",
  (['GENERAL PRACTICE','CARDIOLOGY','ONCOLOGY'])[(s_suppkey % 3 + 1)::INT] specialty,
  (['GENERAL PRACTICE','CARDIOLOGY','ONCOLOGY'])[(s_suppkey % 3 + 1)::INT] specialty_code,
  s_suppkey || ' Side St' address_line, n_name || ' City' city, n_name state,
  lpad(s_suppkey::VARCHAR, 5, '0') postal_code, NULL::DOUBLE latitude,
  ((s_suppkey % 90) || '.5')::DOUBLE longitude, s_suppkey * 3 encounter_count, NULL::BIGINT procedure_count,
  true active, 'US' country, 'SYNTHEA.PROVIDERS' source_system,
  CASE WHEN s_suppkey % 2 = 0 THEN 'f' ELSE 'm' END gender
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
part("c_payer")(f"""
SELECT r_regionkey::VARCHAR payer_id, 'Payer ' || r_name payer_name,
  CASE WHEN r_regionkey % 2 = 0 THEN 'GOVERNMENT' ELSE 'PRIVATE' END ownership_type, '800-' || r_regionkey phone,
  r_name || ' City' city, r_name state, lpad(r_regionkey::VARCHAR, 5, '0') postal_code,
  (r_regionkey * 1000)::{MONEY} amount_covered, (r_regionkey * (r_regionkey - 1) * 300)::{MONEY} amount_uncovered,
  revenue::{MONEY} revenue, covered covered_encounters, n - covered uncovered_encounters,
  n // 2 covered_medications, n // 3 uncovered_medications, n // 4 covered_procedures,
  n // 5 uncovered_procedures, n // 6 covered_immunizations, n // 7 uncovered_immunizations,
  members unique_customers, members * 12 * r_regionkey member_months, true is_active,
  'SYNTHEA.PAYERS' source_system, ('0.' || (r_regionkey + 5))::DECIMAL(10,2) quality_of_life_score_avg,
  CASE WHEN r_regionkey > 0 THEN (r_regionkey * 1000)::DOUBLE
    / (r_regionkey * 1000 + r_regionkey * (r_regionkey - 1) * 300)::DOUBLE END coverage_ratio
FROM region LEFT JOIN (SELECT o_orderkey % 5 payer, count(*) n, count(*) FILTER (o_orderstatus = 'F') covered,
    count(DISTINCT o_custkey) members, sum(o_totalprice::{MONEY}) revenue FROM orders GROUP BY 1)
  ON r_regionkey = payer
""")
part("c_allergy_only")(f"""
SELECT user_id::VARCHAR patient_id, event_id::VARCHAR encounter_id, (event_id % 200)::VARCHAR allergy_code,
  'Allergy ' || (event_id % 200) allergy_description, 'RX' || (event_id % 9) primary_reaction_code,
  'Reaction ' || (event_id % 9) primary_reaction, ts::DATE onset_date,
  CASE WHEN event_id % 3 > 0 THEN ts::DATE + 20 END resolution_date,
  {sha("user_id", "event_id % 200", "ts::DATE")} allergy_id, 'confirmed' verification_status,
  'SYNTHEA.ALLERGIES' source_system,
  CASE WHEN event_id % 2 = 0 THEN 'http://snomed.info/sct' ELSE 'RxNorm' END code_system,
  CASE WHEN event_id % 3 = 0 THEN 'active' ELSE 'resolved' END clinical_status, 'allergy' allergy_type,
  CASE WHEN event_id % 7 = 0 THEN 'environment' ELSE 'drug' END category,
  CASE WHEN event_id % 4 = 2 OR event_id // 4 % 4 = 2 THEN 'high' ELSE 'low' END criticality,
  ts::DATE recorded_date,
  CASE event_id % 4 WHEN 1 THEN 'moderate' WHEN 2 THEN 'severe' ELSE 'mild' END reaction_severity,
  event_id % 3 = 0 is_active, event_id % 4 = 2 OR event_id // 4 % 4 = 2 is_high_criticality
FROM events
""")
part("c_allergy", "c_allergy_only", "lookup_rxnorm_concepts")("""
SELECT a.*, c.rxnorm_name, c.tty rxnorm_term_type FROM c_allergy_only a
LEFT JOIN lookup_rxnorm_concepts c ON allergy_code = rxcui
""")
part("c_careplan")(f"""
SELECT 'plan-' || event_id careplan_id, user_id::VARCHAR patient_id, event_id::VARCHAR encounter_id,
  (event_id % 50)::VARCHAR careplan_code, 'Plan ' || (event_id % 50) careplan_description,
  (event_id % 11)::VARCHAR reason_code, 'Reason ' || (event_id % 11) reason_description, ts::DATE start_date,
  stop end_date, 'order' careplan_intent, 'SYNTHEA.CAREPLANS' source_system,
  CASE WHEN stop IS NULL THEN 'active' ELSE 'completed' END careplan_status,
  date_diff('day', ts::DATE, coalesce(stop, {AS_OF}))::INT duration_days,
  CASE WHEN stop IS NULL THEN 'in-progress' ELSE 'completed' END activity_status, stop IS NULL is_active
FROM (SELECT *, CASE WHEN event_id % 4 > 0 THEN ts::DATE + 45 END stop FROM events)
""")
part("c_device")("""
SELECT user_id::VARCHAR patient_id, event_id::VARCHAR encounter_id, udi, code device_code,
  'Device ' || (event_id % 30) device_description, 'Device ' || (event_id % 30) device_name,
  ts::DATE association_start, stop association_end, 'SYNTHEA.DEVICES' source_system,
  coalesce(udi, sha256(concat_ws('|', user_id::VARCHAR, code, ts::DATE::VARCHAR))) device_id,
  CASE WHEN stop IS NULL THEN 'active' ELSE 'inactive' END device_status, stop IS NULL is_active,
  udi IS NOT NULL has_udi
FROM (SELECT *, CASE WHEN event_id % 2 > 0 THEN ts::DATE + 10 END stop,
    CASE WHEN event_id % 3 = 0 THEN 'UDI' || event_id END udi,
    CASE WHEN event_id % 6 > 0 THEN (event_id % 30)::VARCHAR END code FROM events)
""")
part("c_imagingstudy")("""
SELECT 'study-' || event_id study_id, user_id::VARCHAR patient_id, event_id::VARCHAR encounter_id,
  '1.2.' || event_id series_uid, CASE WHEN event_id % 2 = 0 THEN 'CT' ELSE 'MR' END modality_code,
  CASE WHEN event_id % 2 = 0 THEN 'Computed tomography' ELSE 'Magnetic resonance' END modality_description,
  (event_id % 13)::VARCHAR bodysite_code, 'Site ' || (event_id % 13) bodysite_description,
  '1.3.' || event_id instance_uid, (event_id % 4)::VARCHAR sop_code, 'Sop ' || (event_id % 4) sop_description,
  (event_id % 90)::VARCHAR procedure_code, CASE WHEN event_id % 8 > 0 THEN ts::DATE END study_date,
  'available' study_status, 'SYNTHEA.IMAGING_STUDIES' source_system
FROM events
""")
part("c_immunization")(f"""
SELECT user_id::VARCHAR patient_id, event_id::VARCHAR encounter_id, (event_id % 20)::VARCHAR vaccine_code,
  'Vaccine ' || (event_id % 20) vaccine_description, ts::DATE administration_date, ts::DATE recorded_date,
  value::{MONEY} "cost", {sha("user_id", "event_id % 20", "ts::DATE")} immunization_id,
  'http://hl7.org/fhir/sid/cvx' code_system, 'completed' immunization_status, true is_primary_source,
  'SYNTHEA.IMMUNIZATIONS' source_system
FROM events
""")
part("c_supply")(f"""
SELECT user_id::VARCHAR patient_id, enc encounter_id, (event_id % 25)::VARCHAR supply_code,
  'Supply ' || (event_id % 25) supply_description, ts::DATE delivery_date,
  {sha("user_id", "event_id % 25", "ts::DATE", "enc")} supply_id, 'unit' unit, 'completed' delivery_status,
  'device' supply_type_code, 'Device' supply_type, 'SYNTHEA.SUPPLIES' source_system,
  CASE WHEN event_id % 5 = 0 THEN 1 ELSE event_id % 12 END::BIGINT quantity, enc IS NOT NULL has_encounter
FROM (SELECT *, CASE WHEN event_id % 4 > 0 THEN event_id::VARCHAR END enc FROM events)
""")
part("c_coverage")(f"""
SELECT o_custkey::VARCHAR patient_id, (o_orderkey % 5)::VARCHAR payer_id, (o_orderkey % 5)::VARCHAR payer_name,
  'M' || o_custkey member_id, 'Owner ' || o_custkey owner_name, o_orderdate::DATE start_date, stop end_date,
  {sha("o_custkey", "o_orderkey % 5", "o_orderdate::DATE")} coverage_id, 'EHCPOL' coverage_type_code,
  'Extended healthcare' coverage_type, 'SYNTHEA.PAYER_TRANSITIONS' source_system,
  CASE WHEN stop IS NULL OR stop >= {AS_OF} THEN 'active' ELSE 'cancelled' END coverage_status,
  date_diff('day', o_orderdate::DATE, coalesce(stop, {AS_OF}))::INT coverage_duration_days,
  CASE o_orderkey % 5 WHEN 1 THEN 'spouse' WHEN 2 THEN 'parent' ELSE 'self' END relationship_code,
  CASE o_orderkey % 5 WHEN 1 THEN 'Spouse' WHEN 2 THEN 'Parent' ELSE 'Self' END relationship,
  stop IS NULL OR stop >= {AS_OF} is_active
FROM (SELECT *, CASE WHEN o_orderkey % 6 > 0 THEN (o_orderdate + to_days((o_orderkey % 900)::INT))::DATE END stop FROM orders)
""")
part("claim_codes")(f"""
SELECT l_orderkey, count(*) FILTER (n <= 8) filled, max(code) FILTER (n = 1) d1, max(code) FILTER (n = 2) d2
FROM (SELECT l_orderkey, {dotted(icd_raw('l_partkey'))} code,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) n FROM lineitem) GROUP BY 1
""")
part("c_claim", "claim_codes", "lookup_icd10cm_codes")(f"""
SELECT o_orderkey::VARCHAR claim_id, o_custkey::VARCHAR patient_id, (o_orderkey % 10)::VARCHAR provider_id,
  (o_orderkey % 5)::VARCHAR primary_coverage_id,
  CASE WHEN o_orderkey % 2 > 0 THEN ((o_orderkey + 1) % 5)::VARCHAR END secondary_coverage_id,
  d1 primary_diagnosis_code, d2 secondary_diagnosis_code, o_orderkey::VARCHAR encounter_id,
  'professional' claim_type_code, 'Professional' claim_type, 'active' claim_status, 'claim' claim_use,
  'SYNTHEA.CLAIMS' source_system, o_orderdate::DATE service_date, o_orderdate::DATE created_date,
  coalesce(filled, 0)::INT diagnosis_count,
  (CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice::{MONEY} END
    + CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 100 END)::{MONEY} total_amount,
  a.short_description primary_diagnosis_desc, b.short_description secondary_diagnosis_desc
FROM orders LEFT JOIN claim_codes ON o_orderkey = l_orderkey
LEFT JOIN lookup_icd10cm_codes a ON d1 = a.icd10cm_code LEFT JOIN lookup_icd10cm_codes b ON d2 = b.icd10cm_code
""")
part("c_claimresponse_only")(f"""
SELECT *, CASE WHEN outstanding_amount = 0 THEN 'complete' WHEN coalesce(payment_amount, 0) > 0 THEN 'partial'
    ELSE 'queued' END outcome, payment_amount benefit_amount
FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) claimresponse_id,
  l_orderkey::VARCHAR claim_id, o_custkey::VARCHAR patient_id, {hcpcs('l_partkey')} procedure_code,
  l_shipdate::DATE created_date, (l_shipdate + to_days(l_quantity::INT))::DATE payment_date,
  l_extendedprice::{MONEY} submitted_amount,
  CASE WHEN l_returnflag = 'N' AND l_linenumber > 4 THEN NULL
    ELSE (l_extendedprice::{MONEY} * (1 - l_discount::DECIMAL(4,2)))::{MONEY} END payment_amount,
  CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_extendedprice::{MONEY} END outstanding_amount,
  'active' response_status, 'SYNTHEA.CLAIMS_TRANSACTIONS' source_system FROM {LINES})
""")
part("c_claimresponse", "c_claimresponse_only", "lookup_hcpcs_codes")("""
SELECT r.*, outcome = 'complete' is_complete, outcome = 'partial' is_partial,
  h.short_description procedure_description, h.code_type procedure_code_type
FROM c_claimresponse_only r LEFT JOIN lookup_hcpcs_codes h ON procedure_code = hcpcs_code AND h.is_active
""")

# --- lookups ---------------------------------------------------------------------------

HCPCS_FIELDS = (
    "sequence_num record_type long_description short_description pricing_indicator_1 "
    "pricing_indicator_2 pricing_indicator_3 pricing_indicator_4 multiple_pricing_indicator "
    "cim_reference_1 cim_reference_2 cim_reference_3 mcm_reference_1 mcm_reference_2 "
    "mcm_reference_3 statute_number lab_cert_code_1 lab_cert_code_2 lab_cert_code_3 "
    "lab_cert_code_4 lab_cert_code_5 lab_cert_code_6 lab_cert_code_7 lab_cert_code_8 "
    "xref_code_1 xref_code_2 xref_code_3 xref_code_4 xref_code_5 coverage_code "
    "asc_payment_group asc_effective_date mog_payment_group mog_payment_indicator "
    "mog_effective_date processing_note_number betos_code type_of_service_1 type_of_service_2 "
    "type_of_service_3 type_of_service_4 type_of_service_5 anesthesia_base_units "
    "code_added_date action_effective_date termination_date action_code"
).split()
HCPCS_FILLED = {
    "sequence_num": "'00100'",
    "record_type": pick("['3','7','4']", "p_partkey % 7 % 3"),
    "long_description": "'Long ' || p_name",
    "short_description": "'Short ' || p_name",
    "pricing_indicator_1": "CASE WHEN p_size % 5 = 0 THEN '' ELSE lpad((p_size % 5)::VARCHAR, 2, '0') END",
    "coverage_code": pick("['C','D','I']", "p_size % 3"),
    "betos_code": "CASE WHEN p_partkey % 6 = 0 THEN '' ELSE 'P' || (p_size % 4) || 'A' END",
    "code_added_date": "'20000101'",
    "termination_date": "CASE p_partkey % 5 WHEN 0 THEN '20011231' WHEN 1 THEN '20301231' ELSE '' END",
    "action_code": "'N'",
}
part("hcpcs_fields")(
    f"SELECT {hcpcs('p_partkey')} hcpcs_code, p_partkey, "
    + ", ".join(f"{HCPCS_FILLED.get(f, chr(39) * 2)} {f}" for f in HCPCS_FIELDS)
    + " FROM part"
)
part("lookup_hcpcs_codes", "hcpcs_fields")("""
SELECT * EXCLUDE (p_partkey), CASE record_type WHEN '3' THEN 'PROCEDURE' ELSE 'MODIFIER' END code_type,
  CASE WHEN p_partkey % 2 = 0 AND p_partkey < 20000 THEN 'CPT' ELSE 'HCPCS_LEVEL_II' END code_category,
  termination_date <> '20011231' is_active
FROM hcpcs_fields WHERE record_type <> '4'
""")
part("icd_fields")(f"""
SELECT CASE WHEN p_partkey < 100000 THEN lpad(p_partkey::VARCHAR, 5, '0')
    ELSE to_base(p_partkey + {10 * 36**4 - 100_000}, 36, 5) END order_number, {icd_raw('p_partkey')} icd10cm_code_raw,
  CASE WHEN p_size % 3 = 0 THEN '0' ELSE '1' END is_billable_flag, 'Diagnosis ' || p_partkey short_description,
  'Long diagnosis ' || p_partkey || ' ' || p_name long_description, p_partkey FROM part
""")
TITLES = (
    "MAP {'01':'Certain infectious and parasitic diseases','02':'Neoplasms',"
    "'03':'Diseases of the blood and blood-forming organs',"
    "'04':'Endocrine, nutritional and metabolic diseases',"
    "'05':'Mental, Behavioral and Neurodevelopmental disorders',"
    "'06':'Diseases of the nervous system','07':'Diseases of the eye and adnexa',"
    "'08':'Diseases of the ear and mastoid process','09':'Diseases of the circulatory system',"
    "'10':'Diseases of the respiratory system','11':'Diseases of the digestive system',"
    "'12':'Diseases of the skin and subcutaneous tissue',"
    "'13':'Diseases of the musculoskeletal system and connective tissue',"
    "'14':'Diseases of the genitourinary system','15':'Pregnancy, childbirth and the puerperium',"
    "'16':'Certain conditions originating in the perinatal period',"
    "'17':'Congenital malformations, deformations and chromosomal abnormalities',"
    "'18':'Symptoms, signs and abnormal clinical and laboratory findings',"
    "'19':'Injury, poisoning and certain other consequences of external causes',"
    "'20':'External causes of morbidity',"
    "'21':'Factors influencing health status and contact with health services',"
    "'22':'Codes for special purposes'}"
)
part("lookup_icd10cm_codes", "icd_fields")(f"""
SELECT *, {TITLES}[chapter_num] chapter_description FROM (
SELECT order_number, short_description, long_description, {dotted('icd10cm_code_raw')} icd10cm_code,
  CASE is_billable_flag WHEN '1' THEN 'true' ELSE 'false' END is_billable, left(icd10cm_code_raw, 1) chapter_letter,
  CASE length(icd10cm_code_raw) WHEN 3 THEN 'CATEGORY' WHEN 4 THEN 'SUBCATEGORY' WHEN 5 THEN 'SUBCATEGORY_2'
    WHEN 6 THEN 'SUBCATEGORY_3' WHEN 7 THEN 'FULL_CODE' ELSE 'UNKNOWN' END code_level,
  left(icd10cm_code_raw, 3) category_code,
  CASE WHEN icd10cm_code_raw[1] IN ('A','B') THEN '01' WHEN icd10cm_code_raw[1] = 'C' THEN '02'
    WHEN icd10cm_code_raw[1] = 'D' THEN CASE WHEN icd10cm_code_raw[2:3]::INT < 50 THEN '02' ELSE '03' END
    WHEN icd10cm_code_raw[1] BETWEEN 'E' AND 'G' THEN lpad((ascii(icd10cm_code_raw) - 65)::VARCHAR, 2, '0')
    WHEN icd10cm_code_raw[1] = 'H' THEN CASE WHEN icd10cm_code_raw[2:3]::INT < 60 THEN '07' ELSE '08' END
    WHEN icd10cm_code_raw[1] BETWEEN 'I' AND 'R' THEN lpad((ascii(icd10cm_code_raw) - 64)::VARCHAR, 2, '0')
    WHEN icd10cm_code_raw[1] IN ('S','T') THEN '19' WHEN icd10cm_code_raw[1] = 'Z' THEN '21'
    WHEN icd10cm_code_raw[1] = 'U' THEN '22' ELSE '20' END chapter_num
FROM icd_fields)
""")
part("lookup_ndc_product")(f"""
SELECT p_partkey || '_prod' product_id, {PRODUCT_NDC} product_ndc,
  CASE WHEN p_partkey % 4 = 1 THEN 'HUMAN OTC DRUG' ELSE 'HUMAN PRESCRIPTION DRUG' END product_type_name,
  upper(p_name) proprietary_name, NULL::VARCHAR proprietary_name_suffix, p_name nonproprietary_name,
  {pick("['TABLET','CAPSULE','INJECTION']", "p_size % 3")} dosage_form_name,
  CASE WHEN p_size % 3 = 2 THEN 'INTRAVENOUS' ELSE 'ORAL' END route_name, '20100101' start_marketing_date,
  CASE p_size % 7 WHEN 0 THEN '20201231' WHEN 1 THEN ' ' END end_marketing_date, 'NDA' marketing_category_name,
  'NDA' || p_partkey application_number, p_brand labeler_name, upper(p_name) substance_name,
  p_size::VARCHAR active_numerator_strength, 'mg/1' active_ingred_unit, NULL::VARCHAR pharm_classes,
  CASE p_partkey % 10 WHEN 0 THEN 'CII' WHEN 1 THEN ' ' END dea_schedule,
  CASE WHEN p_partkey % 20 = 19 THEN 'y' ELSE 'N' END ndc_exclude_flag, '20251231' listing_certified_date,
  CASE WHEN p_partkey % 20 = 19 THEN 'true' ELSE 'false' END is_excluded,
  CASE WHEN p_size % 7 = 0 THEN 'false' ELSE 'true' END is_active,
  CASE WHEN p_partkey % 4 = 1 THEN 'false' ELSE 'true' END is_prescription,
  CASE WHEN p_partkey % 4 = 1 THEN 'true' ELSE 'false' END is_otc,
  CASE WHEN p_partkey % 10 = 0 THEN 'true' ELSE 'false' END is_controlled,
  replace({PRODUCT_NDC}, '-', '') product_ndc_normalized
FROM part
""")
part("lookup_ndc_package")(f"""
SELECT CASE WHEN p_partkey % 15 = 14 THEN 'none' ELSE p_partkey || '_prod' END product_id, {PRODUCT_NDC} product_ndc,
  {NDC} ndc_package_code, p_size || ' TABLET in 1 BOTTLE' package_description, '20100101' start_marketing_date,
  CASE WHEN p_partkey % 9 = 8 THEN '20191231' ELSE '' END end_marketing_date,
  CASE WHEN p_partkey % 25 = 24 THEN 'Y' ELSE 'N' END ndc_exclude_flag,
  CASE WHEN p_partkey % 6 = 5 THEN 'Y' ELSE 'N' END sample_package,
  CASE WHEN p_partkey % 25 = 24 THEN 'true' ELSE 'false' END is_excluded,
  CASE WHEN p_partkey % 6 = 5 THEN 'true' ELSE 'false' END is_sample,
  CASE WHEN p_partkey % 9 = 8 THEN 'false' ELSE 'true' END is_active, {NDC11} ndc_11_digit,
  left({NDC11}, 5) labeler_code, substr({NDC11}, 6, 4) product_code, right({NDC11}, 2) package_code
FROM part
""")
SNOMED_TARGET = dotted(f"({icd_raw('(p_partkey // 3 + v)')})")
part("lookup_snomed_icd10cm_map")(f"""
SELECT *, target icd10cm_code_clean, target icd10cm_code,
  CASE map_category_name WHEN 'Properly Classified' THEN 'EXACT' WHEN 'Context Dependent' THEN 'CONTEXT_DEPENDENT'
    WHEN 'Cannot Be Classified' THEN 'NO_MAP' ELSE 'OTHER' END map_type,
  CASE WHEN target IS NULL THEN 'false' ELSE 'true' END has_target,
  CASE WHEN advice IN (0, 1) THEN 'true' ELSE 'false' END requires_additional_code,
  CASE WHEN advice = 2 THEN 'true' ELSE 'false' END is_approximate
FROM (SELECT p_partkey || '-' || v id, CASE WHEN p_partkey % 14 > 0 THEN '2023-09-01' END effective_date,
  {condition_code('p_partkey')} snomed_concept_id, 'Concept ' || ({condition_code('p_partkey')}) snomed_concept_name,
  CASE WHEN p_partkey % 5 = 0 THEN v + 1 ELSE 1 END::VARCHAR map_group, (3 - v)::VARCHAR map_priority, 'TRUE' map_rule,
  {pick("['ALWAYS X CONSIDER ADDITIONAL CODE','MAP IS CONTEXT DEPENDENT FOR GENDER','POSSIBLE REQUIREMENT FOR ADDITIONAL CODE',NULL]", "(p_partkey + v) % 4")} map_advice,
  (p_partkey + v) % 4 advice,
  CASE WHEN (p_partkey + v) % 11 <> 10 THEN {SNOMED_TARGET} END target, 'Diagnosis ' || (p_partkey // 3 + v) icd10cm_name,
  {pick("['Properly Classified','Context Dependent','Cannot Be Classified',NULL]", "(p_partkey // 2 + v) % 4")} map_category_name
FROM part, LATERAL (SELECT unnest(range(p_partkey % 3 + 1)) v) WHERE (p_partkey + v) % 12 <> 11)
""")
TERM = (
    "CASE p_type WHEN 'ECONOMY' THEN 'SCD' WHEN 'STANDARD' THEN 'SBD' WHEN 'SMALL' THEN 'IN' "
    "WHEN 'MEDIUM' THEN CASE WHEN p_partkey % 2 = 0 THEN 'GPCK' ELSE 'BPCK' END "
    "WHEN 'LARGE' THEN CASE WHEN p_partkey % 2 = 0 THEN 'PIN' ELSE 'MIN' END ELSE 'BN' END"
)


def nulls(columns: str) -> str:
    return ", ".join(f"NULL::VARCHAR {n}" for n in columns.split())


part("atom_rows")(f"""
SELECT p_partkey::VARCHAR rxcui, CASE WHEN (p_partkey + v) % 29 = 0 THEN 'SPA' ELSE 'ENG' END "language",
  CASE WHEN v = p_partkey % 3 THEN 'Y' ELSE 'N' END is_preferred, (p_partkey * 3 + v)::VARCHAR rxaui,
  CASE WHEN (p_partkey + v) % 17 = 0 THEN 'MTHSPL' ELSE 'RXNORM' END source_abbrev,
  CASE WHEN v = 1 THEN 'SCDC' ELSE {TERM} END term_type, p_partkey::VARCHAR source_code,
  p_name || ' ' || p_partkey || ' v' || v "name", CASE WHEN (p_partkey + v) % 13 = 0 THEN 'O' ELSE 'N' END suppress_flag,
  {nulls("term_status lui string_type sui saui scui sdui source_restriction_level cvf")}
FROM part, (SELECT unnest([0, 1, 2]) v)
""")
part("lookup_rxnorm_atoms", "atom_rows")("""
SELECT *, 'false' is_suppressed, CASE is_preferred WHEN 'Y' THEN 'true' ELSE 'false' END is_preferred_flag
FROM atom_rows WHERE suppress_flag = 'N'
""")
part("lookup_rxnorm_concepts", "atom_rows")("""
SELECT rxcui, rxaui, "name" rxnorm_name, term_type tty, source_code FROM atom_rows
WHERE suppress_flag = 'N' AND source_abbrev = 'RXNORM' AND "language" = 'ENG'
QUALIFY row_number() OVER (PARTITION BY rxcui ORDER BY
  list_position(['SCD','SBD','GPCK','BPCK','IN','PIN','BN','MIN','SCDC','SBDC'], term_type),
  is_preferred DESC, rxaui) = 1
""")
part("attribute_rows")(f"""
SELECT p_partkey::VARCHAR rxcui, (p_partkey * 3)::VARCHAR rxaui,
  CASE WHEN v = 2 AND p_partkey % 3 > 0 THEN 'RXTERM' ELSE 'NDC' END atn,
  CASE WHEN v = 1 THEN 'MTHSPL' ELSE 'RXNORM' END source_abbrev,
  CASE v WHEN 0 THEN {NDC} WHEN 1 THEN replace({NDC}, '-', '') ELSE p_partkey::VARCHAR END atv,
  CASE WHEN (p_partkey + v) % 13 = 0 THEN 'E' ELSE 'N' END suppress_flag,
  {nulls("lui sui stype code atui satui cvf")}
FROM part, (SELECT unnest([0, 1, 2]) v)
""")
part("lookup_rxnorm_attributes", "attribute_rows")(
    "SELECT *, 'false' is_suppressed FROM attribute_rows WHERE suppress_flag = 'N'"
)
CODES = (
    "SELECT DISTINCT rxcui, atv ndc_original, lpad(replace(atv, '-', ''), 11, '0') ndc_11_digit, source_abbrev "
    "FROM attribute_rows WHERE atn = 'NDC' AND length(replace(atv, '-', '')) IN (10, 11)"
)
part("lookup_rxnorm_ndc_crosswalk", "attribute_rows", "lookup_rxnorm_concepts")(f"""
SELECT x.*, rxnorm_name, tty FROM ({CODES} AND suppress_flag = 'N') x LEFT JOIN lookup_rxnorm_concepts USING (rxcui)
""")
part("relationship_rows")(f"""
SELECT p_partkey::VARCHAR rxcui1, CASE WHEN p_partkey % 2 = 0 THEN 'RO' ELSE 'CHD' END rel,
  (p_partkey // 2 + 1)::VARCHAR rxcui2, CASE WHEN p_partkey % 3 > 0 THEN 'has_ingredient' ELSE 'isa' END rela,
  p_partkey::VARCHAR rui, 'RXNORM' source_abbrev, CASE WHEN p_partkey % 10 = 9 THEN 'O' END suppress_flag,
  {nulls("rxaui1 stype1 rxaui2 stype2 srui sl rg dir cvf")}
FROM part
""")
part("lookup_rxnorm_relationships", "relationship_rows")(
    "SELECT *, 'false' is_suppressed FROM relationship_rows WHERE suppress_flag IS NULL"
)
part("lookup_rxnorm_semantic_types")(
    "SELECT CASE WHEN p_partkey % 8 = 0 THEN '-' ELSE '' END || p_partkey rxcui, 'T' || (p_partkey % 5) tui, "
    f"p_type sty, {nulls('stn atui cvf')} FROM part"
)
part("lookup_rxnorm_sources")(
    "SELECT p_partkey::VARCHAR vcui, p_brand rsab, p_name son, 'ENG' lat, p_type ssn, "
    + nulls(
        "rcui vsab sf sver vstart vend imeta rmeta slc scc srl tfr cfr cxty ttyl atnl cenc "
        "curver sabin scit"
    )
    + " FROM part"
)
part("lookup_rxnorm_doc")(
    'SELECT p_type dockey, p_brand "value", \'expanded_form\' "type", p_name expl FROM part'
)
part("lookup_rxnorm_cui_history")(
    "SELECT p_partkey::VARCHAR cui1, '20AA' ver_start, '21AB' ver_end, p_size::VARCHAR cardinality FROM part"
)
part("lookup_rxnorm_cui_changes")(
    "SELECT (p_partkey * 3)::VARCHAR rxaui, p_partkey::VARCHAR code, 'RXNORM' sab, 'SCD' tty, p_name str, "
    "p_partkey::VARCHAR old_rxcui, (p_partkey + 1)::VARCHAR new_rxcui FROM part"
)
part("lookup_rxnorm_atom_archive")(
    "SELECT (p_partkey * 3)::VARCHAR rxaui, p_name str, p_partkey::VARCHAR code, "
    "CASE WHEN p_type = 'PROMO' THEN 'Y' ELSE 'N' END is_brand, p_partkey::VARCHAR rxcui, 'RXNORM' sab, "
    "'SCD' tty, (p_partkey + 1)::VARCHAR merged_to_rxcui, "
    + nulls("aui archive_timestamp created_timestamp updated_timestamp lat last_released saui vsab")
    + " FROM part"
)
part("lookup_rxnorm_prescribe_drugs", "atom_rows")("""
SELECT rxcui, rxaui, "name" drug_name, term_type tty, source_code,
  CASE term_type WHEN 'SCD' THEN 'GENERIC_DRUG' WHEN 'SBD' THEN 'BRANDED_DRUG' WHEN 'GPCK' THEN 'GENERIC_PACK'
    ELSE 'BRANDED_PACK' END drug_type,
  CASE WHEN term_type IN ('SCD','GPCK') THEN 'true' ELSE 'false' END is_generic,
  CASE WHEN term_type IN ('SBD','BPCK') THEN 'true' ELSE 'false' END is_branded,
  CASE WHEN term_type IN ('GPCK','BPCK') THEN 'true' ELSE 'false' END is_pack
FROM atom_rows WHERE source_abbrev = 'RXNORM' AND "language" = 'ENG' AND term_type IN ('SCD','SBD','GPCK','BPCK')
QUALIFY row_number() OVER (PARTITION BY rxcui ORDER BY is_preferred DESC, rxaui) = 1
""")
part("lookup_rxnorm_prescribe_ingredients", "atom_rows")("""
SELECT rxcui, "name" ingredient_name, term_type tty,
  CASE term_type WHEN 'IN' THEN 'BASE_INGREDIENT' WHEN 'PIN' THEN 'PRECISE_INGREDIENT'
    ELSE 'MULTIPLE_INGREDIENTS' END ingredient_type
FROM atom_rows WHERE source_abbrev = 'RXNORM' AND "language" = 'ENG' AND term_type IN ('IN','PIN','MIN')
QUALIFY row_number() OVER (PARTITION BY rxcui ORDER BY is_preferred DESC, "name") = 1
""")
part("lookup_rxnorm_prescribe_ndc", "attribute_rows", "lookup_rxnorm_prescribe_drugs")(
    f"SELECT x.*, drug_name, tty, drug_type FROM ({CODES}) x JOIN lookup_rxnorm_prescribe_drugs USING (rxcui)"
)
part(
    "lookup_rxnorm_prescribe_drug_ingredients",
    "relationship_rows",
    "lookup_rxnorm_prescribe_drugs",
    "lookup_rxnorm_prescribe_ingredients",
)("""
SELECT rxcui1 drug_rxcui, rxcui2 ingredient_rxcui, drug_name, ingredient_name FROM relationship_rows
JOIN lookup_rxnorm_prescribe_drugs d ON rxcui1 = d.rxcui JOIN lookup_rxnorm_prescribe_ingredients i ON rxcui2 = i.rxcui
WHERE rela = 'has_ingredient'
""")

# --- lookup views ----------------------------------------------------------------------


def text_set(x: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_distinct(list({x}))), ','), '')"


part("v_hcpcs_active", "lookup_hcpcs_codes")("SELECT * FROM lookup_hcpcs_codes WHERE is_active")
part("v_hcpcs_by_betos", "lookup_hcpcs_codes")(
    f"SELECT betos_code, count(*) code_count, {text_set('hcpcs_code')} codes FROM lookup_hcpcs_codes "
    "WHERE betos_code <> '' GROUP BY 1"
)
part("v_hcpcs_pricing_summary", "lookup_hcpcs_codes")(
    "SELECT pricing_indicator_1 pricing_indicator, coverage_code, count(*) code_count "
    "FROM lookup_hcpcs_codes WHERE pricing_indicator_1 <> '' GROUP BY 1, 2"
)
part("v_icd10cm_billable", "lookup_icd10cm_codes")(
    "SELECT icd10cm_code, short_description, long_description, category_code, chapter_num, chapter_description "
    "FROM lookup_icd10cm_codes WHERE is_billable = 'true'"
)
part("v_icd10cm_categories", "lookup_icd10cm_codes")(
    "SELECT icd10cm_code category_code, short_description category_description, chapter_num, chapter_description "
    "FROM lookup_icd10cm_codes WHERE code_level = 'CATEGORY'"
)
part("v_icd10cm_chapter_summary", "lookup_icd10cm_codes")(
    "SELECT chapter_num, chapter_description, count(*) total_codes, count(*) FILTER (is_billable = 'true') billable_codes, "
    "count(*) FILTER (is_billable = 'false') header_codes FROM lookup_icd10cm_codes GROUP BY 1, 2"
)
part("v_icd10cm_lookup", "lookup_icd10cm_codes")(
    "SELECT icd10cm_code, replace(icd10cm_code, '.', '') icd10cm_code_nodot, short_description, long_description, "
    "is_billable, chapter_num FROM lookup_icd10cm_codes"
)
part("v_ndc_complete", "lookup_ndc_package", "lookup_ndc_product")("""
SELECT pkg.ndc_package_code, pkg.ndc_11_digit, pkg.labeler_code, pkg.product_code, pkg.package_code,
  pkg.package_description, prd.proprietary_name, prd.proprietary_name_suffix, prd.nonproprietary_name,
  prd.dosage_form_name, prd.route_name, prd.labeler_name, prd.substance_name, prd.active_numerator_strength,
  prd.active_ingred_unit, prd.pharm_classes, prd.dea_schedule, prd.marketing_category_name,
  prd.application_number, prd.product_type_name, prd.is_prescription, prd.is_otc, prd.is_controlled,
  pkg.is_sample,
  CASE WHEN pkg.is_active = 'true' AND prd.is_active = 'true' THEN 'true' ELSE 'false' END is_active,
  pkg.start_marketing_date package_start_date, pkg.end_marketing_date package_end_date,
  prd.start_marketing_date product_start_date, prd.end_marketing_date product_end_date
FROM lookup_ndc_package pkg LEFT JOIN lookup_ndc_product prd USING (product_id)
WHERE pkg.is_excluded = 'false' AND (prd.is_excluded IS NULL OR prd.is_excluded = 'false')
""")
part("v_ndc_active", "v_ndc_complete")(
    "SELECT * FROM v_ndc_complete WHERE is_active = 'true' AND is_sample = 'false'"
)
part("v_ndc_lookup", "v_ndc_complete")(
    "SELECT ndc_11_digit, ndc_package_code ndc_10_digit_dashed, proprietary_name, nonproprietary_name, "
    "dosage_form_name, route_name, labeler_name, substance_name, active_numerator_strength, active_ingred_unit, "
    "is_prescription, is_controlled, dea_schedule FROM v_ndc_complete WHERE is_active = 'true'"
)
part("v_ndc_by_labeler", "v_ndc_complete")(
    "SELECT labeler_name, labeler_code, count(DISTINCT ndc_11_digit) ndc_count, "
    "count(DISTINCT nonproprietary_name) unique_drugs FROM v_ndc_complete WHERE is_active = 'true' GROUP BY 1, 2"
)
part("v_ndc_controlled", "v_ndc_complete")(
    "SELECT * FROM v_ndc_complete WHERE is_controlled = 'true' AND is_active = 'true'"
)
part("v_snomed_icd10cm_simple", "lookup_snomed_icd10cm_map")("""
SELECT snomed_concept_id, snomed_concept_name, icd10cm_code, icd10cm_name, map_category_name, map_type
FROM lookup_snomed_icd10cm_map WHERE has_target = 'true' AND map_type IN ('EXACT','CONTEXT_DEPENDENT')
QUALIFY row_number() OVER (PARTITION BY snomed_concept_id ORDER BY map_group::INT, map_priority::INT,
  snomed_concept_name, icd10cm_code, icd10cm_name, map_category_name) = 1
""")
part("v_snomed_icd10cm_all", "lookup_snomed_icd10cm_map")(f"""
SELECT snomed_concept_id, snomed_concept_name, {text_set('icd10cm_code')} icd10cm_codes,
  count(DISTINCT icd10cm_code) icd10cm_code_count,
  first(map_category_name ORDER BY map_group::INT, map_priority::INT, icd10cm_code, map_category_name NULLS FIRST) primary_map_category
FROM lookup_snomed_icd10cm_map WHERE has_target = 'true' GROUP BY 1, 2
""")
part("v_icd10cm_snomed_reverse", "lookup_snomed_icd10cm_map")(f"""
SELECT icd10cm_code, icd10cm_name, {text_set('snomed_concept_id')} snomed_concept_ids,
  {text_set('snomed_concept_name')} snomed_concept_names, count(DISTINCT snomed_concept_id) snomed_concept_count
FROM lookup_snomed_icd10cm_map WHERE has_target = 'true' GROUP BY 1, 2
""")
part("v_snomed_mapping_complexity", "lookup_snomed_icd10cm_map")("""
SELECT snomed_concept_id, snomed_concept_name, count(*) total_mappings, count(DISTINCT map_group) map_groups,
  max(map_priority::INT) max_priority, count(*) FILTER (map_type = 'EXACT') exact_mappings,
  count(*) FILTER (map_type = 'CONTEXT_DEPENDENT') context_dependent_mappings,
  count(*) FILTER (requires_additional_code = 'true') mappings_needing_additional_code,
  CASE WHEN count(*) = 1 AND max(map_type) = 'EXACT' THEN 'SIMPLE_1_TO_1'
    WHEN count(DISTINCT map_group) > 1 THEN 'COMPLEX_MULTI_GROUP'
    WHEN max(map_type) = 'CONTEXT_DEPENDENT' THEN 'CONTEXT_DEPENDENT' ELSE 'MULTIPLE_OPTIONS' END mapping_complexity
FROM lookup_snomed_icd10cm_map WHERE has_target = 'true' GROUP BY 1, 2
""")
for view, terms in {
    "v_rxnorm_clinical_drugs": "'SCD'",
    "v_rxnorm_branded_drugs": "'SBD'",
    "v_rxnorm_ingredients": "'IN','PIN','MIN'",
}.items():
    part(view, "lookup_rxnorm_concepts")(
        f"SELECT rxcui, rxnorm_name, tty, source_code FROM lookup_rxnorm_concepts WHERE tty IN ({terms})"
    )
part("v_rxnorm_ndc_lookup", "lookup_rxnorm_ndc_crosswalk")(
    "SELECT ndc_11_digit, ndc_original, rxcui, rxnorm_name, tty drug_type FROM lookup_rxnorm_ndc_crosswalk"
)
part("v_rxcui_ndc_all", "lookup_rxnorm_ndc_crosswalk")(
    f"SELECT rxcui, rxnorm_name, tty, {text_set('ndc_11_digit')} ndc_codes, count(DISTINCT ndc_11_digit) ndc_count "
    "FROM lookup_rxnorm_ndc_crosswalk GROUP BY 1, 2, 3"
)
part("v_rxnorm_drug_relationships", "lookup_rxnorm_relationships", "lookup_rxnorm_concepts")("""
SELECT rxcui1, a.rxnorm_name concept1_name, rel, rela, rxcui2, b.rxnorm_name concept2_name
FROM lookup_rxnorm_relationships LEFT JOIN lookup_rxnorm_concepts a ON rxcui1 = a.rxcui
LEFT JOIN lookup_rxnorm_concepts b ON rxcui2 = b.rxcui
""")
part("v_rxnorm_drug_ingredients", "lookup_rxnorm_relationships", "lookup_rxnorm_concepts")("""
SELECT rxcui1 drug_rxcui, a.rxnorm_name drug_name, a.tty drug_type, rxcui2 ingredient_rxcui, b.rxnorm_name ingredient_name
FROM lookup_rxnorm_relationships JOIN lookup_rxnorm_concepts a ON rxcui1 = a.rxcui
JOIN lookup_rxnorm_concepts b ON rxcui2 = b.rxcui
WHERE rela = 'has_ingredient' AND a.tty IN ('SCD','SBD','GPCK','BPCK') AND b.tty IN ('IN','PIN','MIN')
""")
part("v_rxnorm_concepts_with_types", "lookup_rxnorm_concepts", "lookup_rxnorm_semantic_types")(
    "SELECT rxcui, rxnorm_name, tty, tui, sty semantic_type FROM lookup_rxnorm_concepts "
    "LEFT JOIN lookup_rxnorm_semantic_types USING (rxcui)"
)
for view, flag in {
    "v_rxnorm_prescribe_generic": "is_generic",
    "v_rxnorm_prescribe_branded": "is_branded",
}.items():
    part(view, "lookup_rxnorm_prescribe_drugs")(
        f"SELECT rxcui, drug_name, tty, drug_type FROM lookup_rxnorm_prescribe_drugs WHERE {flag} = 'true'"
    )
part("v_rxnorm_prescribe_ndc_lookup", "lookup_rxnorm_prescribe_ndc")(
    "SELECT ndc_11_digit, ndc_original, rxcui, drug_name, drug_type FROM lookup_rxnorm_prescribe_ndc"
)
part("v_rxnorm_prescribe_drug_ndc_all", "lookup_rxnorm_prescribe_ndc")(
    f"SELECT rxcui, drug_name, drug_type, {text_set('ndc_11_digit')} ndc_codes, "
    "count(DISTINCT ndc_11_digit) ndc_count FROM lookup_rxnorm_prescribe_ndc GROUP BY 1, 2, 3"
)
part(
    "v_rxnorm_prescribe_drugs_expanded",
    "lookup_rxnorm_prescribe_drugs",
    "lookup_rxnorm_prescribe_drug_ingredients",
)(f"""
SELECT d.rxcui, d.drug_name, d.drug_type, d.is_generic, d.is_branded, d.is_pack,
  {text_set('i.ingredient_name')} ingredients, count(DISTINCT i.ingredient_rxcui) ingredient_count
FROM lookup_rxnorm_prescribe_drugs d LEFT JOIN lookup_rxnorm_prescribe_drug_ingredients i ON d.rxcui = drug_rxcui
GROUP BY 1, 2, 3, 4, 5, 6
""")
