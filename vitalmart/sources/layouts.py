"""Fixed file layouts: column names, positions and record kinds of every input file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import StringType, StructField, StructType

# Raw CSV columns per table, in file order.
CSV_COLUMNS: dict[str, tuple[str, ...]] = {
    "patients": (
        "Id", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "MIDDLE",
        "LAST", "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE",
        "ADDRESS", "CITY", "STATE", "COUNTY", "FIPS", "ZIP", "LAT", "LON", "HEALTHCARE_EXPENSES",
        "HEALTHCARE_COVERAGE", "INCOME",
    ),
    "encounters": (
        "Id", "START", "STOP", "PATIENT", "ORGANIZATION", "PROVIDER", "PAYER", "ENCOUNTERCLASS",
        "CODE", "DESCRIPTION", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE",
        "REASONCODE", "REASONDESCRIPTION",
    ),
    "conditions": ("START", "STOP", "PATIENT", "ENCOUNTER", "SYSTEM", "CODE", "DESCRIPTION"),
    "observations": (
        "DATE", "PATIENT", "ENCOUNTER", "CATEGORY", "CODE", "DESCRIPTION", "VALUE", "UNITS",
        "TYPE",
    ),
    "procedures": (
        "START", "STOP", "PATIENT", "ENCOUNTER", "SYSTEM", "CODE", "DESCRIPTION", "BASE_COST",
        "REASONCODE", "REASONDESCRIPTION",
    ),
    "medications": (
        "START", "STOP", "PATIENT", "PAYER", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST",
        "PAYER_COVERAGE", "DISPENSES", "TOTALCOST", "REASONCODE", "REASONDESCRIPTION",
    ),
    "immunizations": ("DATE", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST"),
    "allergies": (
        "START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "SYSTEM", "DESCRIPTION", "TYPE",
        "CATEGORY", "REACTION1", "DESCRIPTION1", "SEVERITY1", "REACTION2", "DESCRIPTION2",
        "SEVERITY2",
    ),
    "careplans": (
        "Id", "START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "REASONCODE",
        "REASONDESCRIPTION",
    ),
    "devices": ("START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "UDI"),
    "imaging_studies": (
        "Id", "DATE", "PATIENT", "ENCOUNTER", "SERIES_UID", "BODYSITE_CODE",
        "BODYSITE_DESCRIPTION", "MODALITY_CODE", "MODALITY_DESCRIPTION", "INSTANCE_UID",
        "SOP_CODE", "SOP_DESCRIPTION", "PROCEDURE_CODE",
    ),
    "supplies": ("DATE", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "QUANTITY"),
    "organizations": (
        "Id", "NAME", "ADDRESS", "CITY", "STATE", "ZIP", "LAT", "LON", "PHONE", "REVENUE",
        "UTILIZATION",
    ),
    "providers": (
        "Id", "ORGANIZATION", "NAME", "GENDER", "SPECIALITY", "ADDRESS", "CITY", "STATE", "ZIP",
        "LAT", "LON", "ENCOUNTERS", "PROCEDURES",
    ),
    "payers": (
        "Id", "NAME", "OWNERSHIP", "ADDRESS", "CITY", "STATE_HEADQUARTERED", "ZIP", "PHONE",
        "AMOUNT_COVERED", "AMOUNT_UNCOVERED", "REVENUE", "COVERED_ENCOUNTERS",
        "UNCOVERED_ENCOUNTERS", "COVERED_MEDICATIONS", "UNCOVERED_MEDICATIONS",
        "COVERED_PROCEDURES", "UNCOVERED_PROCEDURES", "COVERED_IMMUNIZATIONS",
        "UNCOVERED_IMMUNIZATIONS", "UNIQUE_CUSTOMERS", "QOLS_AVG", "MEMBER_MONTHS",
    ),
    "claims": (
        "Id", "PATIENTID", "PROVIDERID", "PRIMARYPATIENTINSURANCEID",
        "SECONDARYPATIENTINSURANCEID", "DEPARTMENTID", "PATIENTDEPARTMENTID", "DIAGNOSIS1",
        "DIAGNOSIS2", "DIAGNOSIS3", "DIAGNOSIS4", "DIAGNOSIS5", "DIAGNOSIS6", "DIAGNOSIS7",
        "DIAGNOSIS8", "REFERRINGPROVIDERID", "APPOINTMENTID", "CURRENTILLNESSDATE", "SERVICEDATE",
        "SUPERVISINGPROVIDERID", "STATUS1", "STATUS2", "STATUSP", "OUTSTANDING1", "OUTSTANDING2",
        "OUTSTANDINGP", "LASTBILLEDDATE1", "LASTBILLEDDATE2", "LASTBILLEDDATEP",
        "HEALTHCARECLAIMTYPEID1", "HEALTHCARECLAIMTYPEID2",
    ),
    "claims_transactions": (
        "ID", "CLAIMID", "CHARGEID", "PATIENTID", "TYPE", "AMOUNT", "METHOD", "FROMDATE",
        "TODATE", "PLACEOFSERVICE", "PROCEDURECODE", "MODIFIER1", "MODIFIER2", "DIAGNOSISREF1",
        "DIAGNOSISREF2", "DIAGNOSISREF3", "DIAGNOSISREF4", "UNITS", "DEPARTMENTID", "NOTES",
        "UNITAMOUNT", "TRANSFEROUTID", "TRANSFERTYPE", "PAYMENTS", "ADJUSTMENTS", "TRANSFERS",
        "OUTSTANDING", "APPOINTMENTID", "LINENOTE", "PATIENTINSURANCEID", "FEESCHEDULEID",
        "PROVIDERID", "SUPERVISINGPROVIDERID",
    ),
    "payer_transitions": (
        "PATIENT", "MEMBERID", "START_DATE", "END_DATE", "PAYER", "SECONDARY_PAYER",
        "PLAN_OWNERSHIP", "OWNER_NAME",
    ),
    "symptoms": (
        "PATIENT", "GENDER", "RACE", "ETHNICITY", "AGE_BEGIN", "AGE_END", "PATHOLOGY",
        "NUM_SYMPTOMS", "SYMPTOMS",
    ),
}

# Table categories and the columns documented as keys.
CSV_CATEGORIES: dict[str, tuple[str, ...]] = {
    "clinical": (
        "patients", "encounters", "conditions", "observations", "procedures", "medications",
        "immunizations", "allergies", "careplans", "devices", "imaging_studies", "supplies",
    ),
    "administrative": (
        "organizations", "providers", "payers",
    ),
    "financial": (
        "claims", "claims_transactions", "payer_transitions",
    ),
}
KEYED_BY_ID = (
    "patients", "encounters", "careplans", "organizations", "providers", "payers", "claims",
    "claims_transactions",
)

# Tab-separated code files with a header line.
TAB_COLUMNS: dict[str, tuple[str, ...]] = {
    "ndc_product": (
        "product_id", "product_ndc", "product_type_name", "proprietary_name",
        "proprietary_name_suffix", "nonproprietary_name", "dosage_form_name", "route_name",
        "start_marketing_date", "end_marketing_date", "marketing_category_name",
        "application_number", "labeler_name", "substance_name", "active_numerator_strength",
        "active_ingred_unit", "pharm_classes", "dea_schedule", "ndc_exclude_flag",
        "listing_record_certified_through",
    ),
    "ndc_package": (
        "product_id", "product_ndc", "ndc_package_code", "package_description",
        "start_marketing_date", "end_marketing_date", "ndc_exclude_flag", "sample_package",
    ),
    "snomed_map": (
        "id", "effective_time", "active", "module_id", "refset_id", "snomed_concept_id",
        "snomed_concept_name", "map_group", "map_priority", "map_rule", "map_advice",
        "icd10cm_code", "icd10cm_name", "correlation_id", "map_category_id", "map_category_name",
    ),
}

# Pipe-separated concept files without a header line.
PIPE_COLUMNS: dict[str, tuple[str, ...]] = {
    "atoms": (
        "rxcui", "language", "term_status", "lui", "string_type", "sui", "is_preferred", "rxaui",
        "saui", "scui", "sdui", "source_abbrev", "term_type", "source_code", "name",
        "source_restriction_level", "suppress_flag", "cvf",
    ),
    "attributes": (
        "rxcui", "lui", "sui", "rxaui", "stype", "code", "atui", "satui", "atn", "source_abbrev",
        "atv", "suppress_flag", "cvf",
    ),
    "relationships": (
        "rxcui1", "rxaui1", "stype1", "rel", "rxcui2", "rxaui2", "stype2", "rela", "rui", "srui",
        "source_abbrev", "sl", "rg", "dir", "suppress_flag", "cvf",
    ),
    "semantic_types": ("rxcui", "tui", "stn", "sty", "atui", "cvf"),
    "sources": (
        "vcui", "rcui", "vsab", "rsab", "son", "sf", "sver", "vstart", "vend", "imeta", "rmeta",
        "slc", "scc", "srl", "tfr", "cfr", "cxty", "ttyl", "atnl", "lat", "cenc", "curver",
        "sabin", "ssn", "scit",
    ),
    "doc": ("dockey", "value", "type", "expl"),
    "cui_history": ("cui1", "ver_start", "ver_end", "cardinality"),
    "cui_changes": ("rxaui", "code", "sab", "tty", "str", "old_rxcui", "new_rxcui"),
    "atom_archive": (
        "rxaui", "aui", "str", "archive_timestamp", "created_timestamp", "updated_timestamp",
        "code", "is_brand", "lat", "last_released", "saui", "vsab", "rxcui", "sab", "tty",
        "merged_to_rxcui",
    ),
    "prescribe_atoms": (
        "rxcui", "language", "term_status", "lui", "string_type", "sui", "is_preferred", "rxaui",
        "saui", "scui", "sdui", "source_abbrev", "term_type", "source_code", "name",
        "source_restriction_level", "suppress_flag", "cvf",
    ),
    "prescribe_attributes": (
        "rxcui", "lui", "sui", "rxaui", "stype", "code", "atui", "satui", "atn", "source_abbrev",
        "atv", "suppress_flag",
    ),
    "prescribe_relationships": (
        "rxcui1", "rxaui1", "stype1", "rel", "rxcui2", "rxaui2", "stype2", "rela", "rui", "srui",
        "source_abbrev", "source_rela", "rg", "dir", "suppress_flag",
    ),
}

# File name of each pipe-separated table.
PIPE_FILES = {
    "atoms": "RXNCONSO.RRF",
    "attributes": "RXNSAT.RRF",
    "relationships": "RXNREL.RRF",
    "semantic_types": "RXNSTY.RRF",
    "sources": "RXNSAB.RRF",
    "doc": "RXNDOC.RRF",
    "cui_history": "RXNCUI.RRF",
    "cui_changes": "RXNCUICHANGES.RRF",
    "atom_archive": "RXNATOMARCHIVE.RRF",
}

# Fixed-width records as name, first character (from 1) and width.
PROCEDURE_CODE_RECORD: tuple[tuple[str, int, int], ...] = (
    ("hcpcs_code", 1, 5),
    ("sequence_num", 6, 5),
    ("record_type", 11, 1),
    ("long_description", 12, 80),
    ("short_description", 92, 28),
    ("pricing_indicator_1", 120, 2),
    ("pricing_indicator_2", 122, 2),
    ("pricing_indicator_3", 124, 2),
    ("pricing_indicator_4", 126, 2),
    ("multiple_pricing_indicator", 128, 1),
    ("cim_reference_1", 129, 6),
    ("cim_reference_2", 135, 6),
    ("cim_reference_3", 141, 6),
    ("mcm_reference_1", 147, 8),
    ("mcm_reference_2", 155, 8),
    ("mcm_reference_3", 163, 8),
    ("statute_number", 171, 10),
    ("lab_cert_code_1", 181, 3),
    ("lab_cert_code_2", 184, 3),
    ("lab_cert_code_3", 187, 3),
    ("lab_cert_code_4", 190, 3),
    ("lab_cert_code_5", 193, 3),
    ("lab_cert_code_6", 196, 3),
    ("lab_cert_code_7", 199, 3),
    ("lab_cert_code_8", 202, 3),
    ("xref_code_1", 205, 5),
    ("xref_code_2", 210, 5),
    ("xref_code_3", 215, 5),
    ("xref_code_4", 220, 5),
    ("xref_code_5", 225, 5),
    ("coverage_code", 230, 1),
    ("asc_payment_group", 231, 2),
    ("asc_effective_date", 233, 8),
    ("mog_payment_group", 241, 3),
    ("mog_payment_indicator", 244, 1),
    ("mog_effective_date", 245, 8),
    ("processing_note_number", 253, 4),
    ("betos_code", 257, 3),
    ("type_of_service_1", 261, 1),
    ("type_of_service_2", 262, 1),
    ("type_of_service_3", 263, 1),
    ("type_of_service_4", 264, 1),
    ("type_of_service_5", 265, 1),
    ("anesthesia_base_units", 266, 3),
    ("code_added_date", 269, 8),
    ("action_effective_date", 277, 8),
    ("termination_date", 285, 8),
    ("action_code", 293, 1),
)

DIAGNOSIS_CODE_RECORD: tuple[tuple[str, int, int], ...] = (
    ("order_number", 1, 5),
    ("icd10cm_code_raw", 7, 7),
    ("is_billable_flag", 15, 1),
    ("short_description", 17, 60),
    ("long_description", 77, 200),
)


def names(layout: Sequence[str]) -> list[str]:
    return list(layout)


def text_schema(layout: Sequence[str]) -> StructType:
    """All-string, all-nullable schema, so a reader never infers or rejects."""
    return StructType([StructField(n, StringType(), True) for n in names(layout)])


def tables_in(category: str) -> tuple[str, ...]:
    return CSV_CATEGORIES.get(category, ())
