"""Code lookups: 20 tables out of public code files, and 29 views over them.

Each table function takes file-shaped frames (see ``sources.readers``), each view function
takes lookup tables. Flags are the texts ``true``/``false``, except ``is_active`` of the
procedure codes, which is a boolean. Arrays are sorted, so results do not depend on the
order rows arrive in.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.codes import (
    crosswalk_ndc,
    dashed_date,
    dotted_icd,
    icd_level,
    ndc11,
    procedure_family,
    undashed,
)
from vitalmart.functions.measures import is_blank, recode, true_false
from vitalmart.operators.rows import best_row
from vitalmart.operators.sets import CHUNK, chunked_sets
from vitalmart.sources import layouts
from vitalmart.sources.readers import cut_fields

c = F.col


def _set_of(column: str) -> Column:
    """The distinct values of a group as a sorted array."""
    return F.array_sort(F.collect_set(column))


def _size_of(column: str) -> Column:
    """How many values `_set_of` holds, without a shuffle of its own."""
    return F.size(F.collect_set(column)).cast("bigint")


def _yes(column: str, value: str = "Y") -> Column:
    return true_false(F.upper(c(column)) == value)


# --- procedure codes -------------------------------------------------------------------


def hcpcs_codes(lines: DataFrame, as_of: dt.date) -> DataFrame:
    """Procedures and modifiers from fixed-width lines; other record types are left out."""
    ended = c("termination_date")
    # Record types that start a code.
    kinds = {"3": "PROCEDURE", "7": "MODIFIER"}
    return (
        cut_fields(lines, layouts.PROCEDURE_CODE_RECORD)
        .filter(c("record_type").isin(*kinds))
        .withColumns(
            {
                "code_type": recode("record_type", kinds, "UNKNOWN"),
                "code_category": procedure_family(c("hcpcs_code")),
                "is_active": is_blank(ended) | (ended > F.lit(as_of.strftime("%Y%m%d"))),
            }
        )
    )


def v_hcpcs_active(codes: DataFrame) -> DataFrame:
    return codes.filter("is_active")


def v_hcpcs_by_betos(codes: DataFrame) -> DataFrame:
    return (
        codes.filter("betos_code != ''")
        .groupBy("betos_code")
        .agg(F.count("*").alias("code_count"), _set_of("hcpcs_code").alias("codes"))
    )


def v_hcpcs_pricing_summary(codes: DataFrame) -> DataFrame:
    return (
        codes.filter("pricing_indicator_1 != ''")
        .groupBy(c("pricing_indicator_1").alias("pricing_indicator"), "coverage_code")
        .agg(F.count("*").alias("code_count"))
    )


# --- diagnosis codes -------------------------------------------------------------------

# Diagnosis chapters as first code, last code, number and title. Chapters
# are cut by letter and two digits, so blood diseases follow the neoplasms inside D and
# ear diseases follow the eye diseases inside H.
CHAPTERS = (
    ("A00", "B99", "01", "Certain infectious and parasitic diseases"),
    ("C00", "D49", "02", "Neoplasms"),
    ("D50", "D99", "03", "Diseases of the blood and blood-forming organs"),
    ("E00", "E99", "04", "Endocrine, nutritional and metabolic diseases"),
    ("F00", "F99", "05", "Mental, Behavioral and Neurodevelopmental disorders"),
    ("G00", "G99", "06", "Diseases of the nervous system"),
    ("H00", "H59", "07", "Diseases of the eye and adnexa"),
    ("H60", "H99", "08", "Diseases of the ear and mastoid process"),
    ("I00", "I99", "09", "Diseases of the circulatory system"),
    ("J00", "J99", "10", "Diseases of the respiratory system"),
    ("K00", "K99", "11", "Diseases of the digestive system"),
    ("L00", "L99", "12", "Diseases of the skin and subcutaneous tissue"),
    ("M00", "M99", "13", "Diseases of the musculoskeletal system and connective tissue"),
    ("N00", "N99", "14", "Diseases of the genitourinary system"),
    ("O00", "O99", "15", "Pregnancy, childbirth and the puerperium"),
    ("P00", "P99", "16", "Certain conditions originating in the perinatal period"),
    ("Q00", "Q99", "17", "Congenital malformations, deformations and chromosomal abnormalities"),
    ("R00", "R99", "18", "Symptoms, signs and abnormal clinical and laboratory findings"),
    ("S00", "T99", "19", "Injury, poisoning and certain other consequences of external causes"),
    ("V00", "Y99", "20", "External causes of morbidity"),
    ("Z00", "Z99", "21", "Factors influencing health status and contact with health services"),
    ("U00", "U99", "22", "Codes for special purposes"),
)


def with_chapter(codes: DataFrame) -> DataFrame:
    """Add number and title of the chapter a code falls in.

    The range join becomes an equi-join on the letter against at most one row per letter
    and chapter (28 rows, hence the broadcast), with the digits as a residual condition.
    Digits compare as text with a trailing letter (as in C4A) inside its range.
    """
    spans = [
        (chr(letter), first[1:] if chr(letter) == first[0] else "00",
         last[1:] if chr(letter) == last[0] else "99", number, title)
        for first, last, number, title in CHAPTERS
        for letter in range(ord(first[0]), ord(last[0]) + 1)
    ]
    chapters = codes.sparkSession.createDataFrame(
        spans,
        "letter string, low string, high string, chapter_num string, chapter_description string",
    )
    digits = F.substring("category_code", 2, 2)
    within = (
        (c("chapter_letter") == c("letter"))
        & (digits >= c("low"))
        & (F.substring(digits, 1, 1) <= F.substring("high", 1, 1))
        & ((digits <= c("high")) | digits.rlike("[A-Z]"))
    )
    return codes.join(F.broadcast(chapters), within, "left").drop("letter", "low", "high")


def icd10cm_codes(lines: DataFrame) -> DataFrame:
    raw = c("icd10cm_code_raw")
    coded = cut_fields(lines, layouts.DIAGNOSIS_CODE_RECORD).select(
        "order_number",
        "short_description",
        "long_description",
        dotted_icd(raw).alias("icd10cm_code"),
        true_false(c("is_billable_flag") == "1").alias("is_billable"),
        F.upper(F.left(raw, F.lit(1))).alias("chapter_letter"),
        icd_level(raw).alias("code_level"),
        F.upper(F.left(raw, F.lit(3))).alias("category_code"),
    )
    return with_chapter(coded)


def v_icd10cm_billable(codes: DataFrame) -> DataFrame:
    return codes.filter("is_billable = 'true'").select(
        "icd10cm_code",
        "short_description",
        "long_description",
        "category_code",
        "chapter_num",
        "chapter_description",
    )


def v_icd10cm_categories(codes: DataFrame) -> DataFrame:
    return codes.filter("code_level = 'CATEGORY'").select(
        c("icd10cm_code").alias("category_code"),
        c("short_description").alias("category_description"),
        "chapter_num",
        "chapter_description",
    )


def v_icd10cm_chapter_summary(codes: DataFrame) -> DataFrame:
    return (
        codes.filter("chapter_num is not null")
        .groupBy("chapter_num", "chapter_description")
        .agg(
            F.count("*").alias("total_codes"),
            F.count_if(c("is_billable") == "true").alias("billable_codes"),
            F.count_if(c("is_billable") == "false").alias("header_codes"),
        )
    )


def v_icd10cm_lookup(codes: DataFrame) -> DataFrame:
    return codes.select(
        "icd10cm_code",
        F.replace("icd10cm_code", F.lit("."), F.lit("")).alias("icd10cm_code_nodot"),
        "short_description",
        "long_description",
        "is_billable",
        "chapter_num",
    )


# --- drug packages ---------------------------------------------------------------------


def ndc_product(rows: DataFrame) -> DataFrame:
    certified = "listing_record_certified_through"
    kind = c("product_type_name")
    return rows.withColumnRenamed(certified, "listing_certified_date").withColumns(
        {
            "is_excluded": _yes("ndc_exclude_flag"),
            "is_active": true_false(is_blank("end_marketing_date")),
            "is_prescription": true_false(kind.contains("PRESCRIPTION")),
            "is_otc": true_false(kind.contains("OTC")),
            "is_controlled": true_false(~is_blank("dea_schedule")),
            "product_ndc_normalized": undashed(c("product_ndc")),
        }
    )


def ndc_package(rows: DataFrame) -> DataFrame:
    digits = c("ndc_11_digit")
    return (
        rows.withColumns(
            {
                "is_excluded": _yes("ndc_exclude_flag"),
                "is_sample": _yes("sample_package"),
                "is_active": true_false(is_blank("end_marketing_date")),
                "ndc_11_digit": ndc11(c("ndc_package_code")),
            }
        )
        .withColumn("labeler_code", F.substring(digits, 1, 5))
        .withColumn("product_code", F.substring(digits, 6, 4))
        .withColumn("package_code", F.substring(digits, 10, 2))
    )


# Columns of the package and product view.
PACKAGE_PART = [
    "ndc_package_code", "ndc_11_digit", "labeler_code", "product_code", "package_code",
    "package_description",
]
PRODUCT_PART = [
    "proprietary_name", "proprietary_name_suffix", "nonproprietary_name", "dosage_form_name",
    "route_name", "labeler_name", "substance_name", "active_numerator_strength",
    "active_ingred_unit", "pharm_classes", "dea_schedule", "marketing_category_name",
    "application_number", "product_type_name", "is_prescription", "is_otc", "is_controlled",
]
NDC_LOOKUP_PART = [
    "proprietary_name", "nonproprietary_name", "dosage_form_name", "route_name", "labeler_name",
    "substance_name", "active_numerator_strength", "active_ingred_unit", "is_prescription",
    "is_controlled", "dea_schedule",
]


def v_ndc_complete(packages: DataFrame, products: DataFrame) -> DataFrame:
    """Packages with their product; both must be on sale for the pair to be active.

    An excluded product removes its packages, an unknown product does not.
    """
    product = products.select(
        c("product_id").alias("_product"),
        *PRODUCT_PART,
        c("start_marketing_date").alias("product_start_date"),
        c("end_marketing_date").alias("product_end_date"),
        c("is_active").alias("_on_sale"),
        c("is_excluded").alias("_excluded"),
    )
    joined = packages.filter("is_excluded = 'false'").join(
        product, c("product_id") == c("_product"), "left"
    )
    on_sale = (c("is_active") == "true") & (c("_on_sale") == "true")
    return joined.filter(F.coalesce("_excluded", F.lit("false")) == "false").select(
        *PACKAGE_PART,
        *PRODUCT_PART,
        "is_sample",
        true_false(on_sale).alias("is_active"),
        c("start_marketing_date").alias("package_start_date"),
        c("end_marketing_date").alias("package_end_date"),
        "product_start_date",
        "product_end_date",
    )


def v_ndc_active(complete: DataFrame) -> DataFrame:
    return complete.filter("is_active = 'true' and is_sample = 'false'")


def v_ndc_lookup(complete: DataFrame) -> DataFrame:
    return complete.filter("is_active = 'true'").select(
        "ndc_11_digit", c("ndc_package_code").alias("ndc_10_digit_dashed"), *NDC_LOOKUP_PART
    )


def v_ndc_by_labeler(complete: DataFrame) -> DataFrame:
    return (
        complete.filter("is_active = 'true'")
        .groupBy("labeler_name", "labeler_code")
        .agg(
            F.count_distinct("ndc_11_digit").alias("ndc_count"),
            F.count_distinct("nonproprietary_name").alias("unique_drugs"),
        )
    )


def v_ndc_controlled(complete: DataFrame) -> DataFrame:
    return complete.filter("is_controlled = 'true' and is_active = 'true'")


# --- concept to diagnosis map ----------------------------------------------------------


def snomed_icd10cm_map(rows: DataFrame) -> DataFrame:
    # Map type by category name, and advice phrases.
    types = {
        "Properly Classified": "EXACT",
        "Context Dependent": "CONTEXT_DEPENDENT",
        "Cannot Be Classified": "NO_MAP",
    }
    advice = c("map_advice")
    additional = advice.contains("CONSIDER ADDITIONAL CODE")
    contextual = advice.contains("MAP IS CONTEXT DEPENDENT")
    approximate = advice.contains("POSSIBLE REQUIREMENT FOR ADDITIONAL CODE")
    target = F.when(~is_blank("icd10cm_code"), F.trim("icd10cm_code"))
    return rows.filter("active = '1'").select(
        "id",
        dashed_date(c("effective_time")).alias("effective_date"),
        "snomed_concept_id",
        "snomed_concept_name",
        "map_group",
        "map_priority",
        "map_rule",
        "map_advice",
        target.alias("icd10cm_code_clean"),
        target.alias("icd10cm_code"),
        "icd10cm_name",
        "map_category_name",
        recode("map_category_name", types, "OTHER").alias("map_type"),
        true_false(target.isNotNull()).alias("has_target"),
        true_false(additional | contextual).alias("requires_additional_code"),
        true_false(approximate).alias("is_approximate"),
    )


def _whole(column: str) -> Column:
    return c(column).try_cast("int")


def v_snomed_icd10cm_simple(mapping: DataFrame) -> DataFrame:
    """One target per concept: lowest group, then lowest priority."""
    usable = mapping.filter("has_target = 'true'").filter(
        c("map_type").isin("EXACT", "CONTEXT_DEPENDENT")
    )
    shown = [
        "snomed_concept_id",
        "snomed_concept_name",
        "icd10cm_code",
        "icd10cm_name",
        "map_category_name",
        "map_type",
    ]
    ordered = usable.select(
        *shown, _whole("map_group").alias("group"), _whole("map_priority").alias("priority")
    )
    best = best_row(ordered, ["snomed_concept_id"], [c("group"), c("priority")])
    return best.select(*shown)


def v_snomed_icd10cm_all(mapping: DataFrame) -> DataFrame:
    by_priority = F.struct(
        _whole("map_group"), _whole("map_priority"), "icd10cm_code", "map_category_name"
    )
    return (
        mapping.filter("has_target = 'true'")
        .groupBy("snomed_concept_id", "snomed_concept_name")
        .agg(
            _set_of("icd10cm_code").alias("icd10cm_codes"),
            _size_of("icd10cm_code").alias("icd10cm_code_count"),
            F.min_by("map_category_name", by_priority).alias("primary_map_category"),
        )
    )


def v_icd10cm_snomed_reverse(mapping: DataFrame) -> DataFrame:
    return (
        mapping.filter("has_target = 'true'")
        .groupBy("icd10cm_code", "icd10cm_name")
        .agg(
            _set_of("snomed_concept_id").alias("snomed_concept_ids"),
            _set_of("snomed_concept_name").alias("snomed_concept_names"),
            _size_of("snomed_concept_id").alias("snomed_concept_count"),
        )
    )


def v_snomed_mapping_complexity(mapping: DataFrame) -> DataFrame:
    highest = F.max("map_type")
    groups = F.count_distinct("map_group")
    complexity = (
        F.when((F.count("*") == 1) & (highest == "EXACT"), "SIMPLE_1_TO_1")
        .when(groups > 1, "COMPLEX_MULTI_GROUP")
        .when(highest == "CONTEXT_DEPENDENT", "CONTEXT_DEPENDENT")
        .otherwise("MULTIPLE_OPTIONS")
    )
    return (
        mapping.filter("has_target = 'true'")
        .groupBy("snomed_concept_id", "snomed_concept_name")
        .agg(
            F.count("*").alias("total_mappings"),
            groups.alias("map_groups"),
            F.max(_whole("map_priority")).alias("max_priority"),
            F.count_if(c("map_type") == "EXACT").alias("exact_mappings"),
            F.count_if(c("map_type") == "CONTEXT_DEPENDENT").alias("context_dependent_mappings"),
            F.count_if(c("requires_additional_code") == "true").alias(
                "mappings_needing_additional_code"
            ),
            complexity.alias("mapping_complexity"),
        )
    )


# --- drug concepts ---------------------------------------------------------------------

# Term types from most to least preferred, and their roles.
PREFERRED_TERMS = ("SCD", "SBD", "GPCK", "BPCK", "IN", "PIN", "BN", "MIN", "SCDC", "SBDC")
DRUG_TERMS = {
    "SCD": "GENERIC_DRUG",
    "SBD": "BRANDED_DRUG",
    "GPCK": "GENERIC_PACK",
    "BPCK": "BRANDED_PACK",
}
INGREDIENT_TERMS = {
    "IN": "BASE_INGREDIENT",
    "PIN": "PRECISE_INGREDIENT",
    "MIN": "MULTIPLE_INGREDIENTS",
}
SUPPRESSED = ("O", "Y", "E")


def with_suppression(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_suppressed", true_false(c("suppress_flag").isin(*SUPPRESSED)))


def unsuppressed(rows: DataFrame) -> DataFrame:
    """Drop suppressed rows, where the file has the flag at all."""
    if "suppress_flag" not in rows.columns:
        return rows
    return with_suppression(rows).filter("is_suppressed = 'false'")


def atoms(rows: DataFrame) -> DataFrame:
    return unsuppressed(rows).withColumn(
        "is_preferred_flag", true_false(c("is_preferred") == "Y")
    )


def _english_terms(rows: DataFrame) -> DataFrame:
    return rows.filter((c("source_abbrev") == "RXNORM") & (c("language") == "ENG"))


def concepts(raw_atoms: DataFrame) -> DataFrame:
    """One name per concept: best term type first, then the preferred atom."""
    term_rank = recode(
        "term_type", {t: i for i, t in enumerate(PREFERRED_TERMS, 1)}, 99
    )
    candidates = _english_terms(unsuppressed(raw_atoms)).select(
        "rxcui",
        "rxaui",
        c("name").alias("rxnorm_name"),
        c("term_type").alias("tty"),
        "source_code",
        term_rank.alias("rank"),
        (~c("is_preferred").eqNullSafe("Y")).alias("not_preferred"),
    )
    return best_row(candidates, ["rxcui"], [c("rank"), c("not_preferred")]).select(
        "rxcui", "rxaui", "rxnorm_name", "tty", "source_code"
    )


def _package_codes(attributes: DataFrame) -> DataFrame:
    return (
        attributes.filter("atn = 'NDC'")
        .select(
            "rxcui",
            c("atv").alias("ndc_original"),
            crosswalk_ndc(c("atv")).alias("ndc_11_digit"),
            "source_abbrev",
        )
        .filter("ndc_11_digit is not null")
        .distinct()
    )


def ndc_crosswalk(raw_attributes: DataFrame, concept_names: DataFrame) -> DataFrame:
    """Package codes per drug; codes are made distinct before the name is joined on."""
    names = concept_names.select("rxcui", "rxnorm_name", "tty")
    return (
        _package_codes(unsuppressed(raw_attributes))
        .join(names, "rxcui", "left")
        .select("rxcui", "rxnorm_name", "tty", "ndc_original", "ndc_11_digit", "source_abbrev")
    )


def _of_terms(*terms: str) -> Callable[[DataFrame], DataFrame]:
    def view(concept_names: DataFrame) -> DataFrame:
        kept = concept_names.filter(c("tty").isin(*terms))
        return kept.select("rxcui", "rxnorm_name", "tty", "source_code")

    return view


v_rxnorm_clinical_drugs = _of_terms("SCD")
v_rxnorm_branded_drugs = _of_terms("SBD")
v_rxnorm_ingredients = _of_terms(*INGREDIENT_TERMS)


def v_rxnorm_ndc_lookup(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.select(
        "ndc_11_digit", "ndc_original", "rxcui", "rxnorm_name", c("tty").alias("drug_type")
    )


def _codes_per(*keys: str) -> Callable[[DataFrame], DataFrame]:
    def view(crosswalk: DataFrame) -> DataFrame:
        return crosswalk.groupBy(*keys).agg(
            _set_of("ndc_11_digit").alias("ndc_codes"),
            _size_of("ndc_11_digit").alias("ndc_count"),
        )

    return view


v_rxcui_ndc_all = _codes_per("rxcui", "rxnorm_name", "tty")


def _end(concept_names: DataFrame, number: int, *shown: str) -> DataFrame:
    """Concepts renamed to be joined to one end of a relationship."""
    return concept_names.select(
        c("rxcui").alias(f"rxcui{number}"), *[c(s).alias(f"{s}{number}") for s in shown]
    )


def v_rxnorm_drug_relationships(edges: DataFrame, concept_names: DataFrame) -> DataFrame:
    return (
        edges.join(_end(concept_names, 1, "rxnorm_name"), "rxcui1", "left")
        .join(_end(concept_names, 2, "rxnorm_name"), "rxcui2", "left")
        .select(
            "rxcui1",
            c("rxnorm_name1").alias("concept1_name"),
            "rel",
            "rela",
            "rxcui2",
            c("rxnorm_name2").alias("concept2_name"),
        )
    )


def v_rxnorm_drug_ingredients(edges: DataFrame, concept_names: DataFrame) -> DataFrame:
    drugs = concept_names.filter(c("tty").isin(*DRUG_TERMS))
    ingredients = concept_names.filter(c("tty").isin(*INGREDIENT_TERMS))
    return (
        edges.filter("rela = 'has_ingredient'")
        .join(_end(drugs, 1, "rxnorm_name", "tty"), "rxcui1")
        .join(_end(ingredients, 2, "rxnorm_name"), "rxcui2")
        .select(
            c("rxcui1").alias("drug_rxcui"),
            c("rxnorm_name1").alias("drug_name"),
            c("tty1").alias("drug_type"),
            c("rxcui2").alias("ingredient_rxcui"),
            c("rxnorm_name2").alias("ingredient_name"),
        )
    )


def v_rxnorm_concepts_with_types(concept_names: DataFrame, types: DataFrame) -> DataFrame:
    kinds = types.select("rxcui", "tui", c("sty").alias("semantic_type"))
    return concept_names.select("rxcui", "rxnorm_name", "tty").join(kinds, "rxcui", "left")


# --- prescribable subset ---------------------------------------------------------------


def _preferred_first(candidates: DataFrame) -> DataFrame:
    first = (~c("is_preferred").eqNullSafe("Y")).alias("not_preferred")
    return best_row(candidates.withColumn("not_preferred", first), ["rxcui"], [c("not_preferred")])


def prescribe_drugs(raw_atoms: DataFrame) -> DataFrame:
    kept = _english_terms(raw_atoms).filter(c("term_type").isin(*DRUG_TERMS)).select(
        "rxcui",
        "rxaui",
        c("name").alias("drug_name"),
        c("term_type").alias("tty"),
        "source_code",
        "is_preferred",
    )
    kind = recode("tty", DRUG_TERMS)
    return _preferred_first(kept).select(
        "rxcui",
        "rxaui",
        "drug_name",
        "tty",
        kind.alias("drug_type"),
        true_false(kind.startswith("GENERIC")).alias("is_generic"),
        true_false(kind.startswith("BRANDED")).alias("is_branded"),
        true_false(kind.endswith("PACK")).alias("is_pack"),
        "source_code",
    )


def prescribe_ingredients(raw_atoms: DataFrame) -> DataFrame:
    kept = _english_terms(raw_atoms).filter(c("term_type").isin(*INGREDIENT_TERMS)).select(
        "rxcui",
        c("name").alias("ingredient_name"),
        c("term_type").alias("tty"),
        "rxaui",
        "is_preferred",
    )
    return _preferred_first(kept).select(
        "rxcui",
        "ingredient_name",
        "tty",
        recode("tty", INGREDIENT_TERMS).alias("ingredient_type"),
    )


def prescribe_ndc(raw_attributes: DataFrame, drugs: DataFrame) -> DataFrame:
    names = drugs.select("rxcui", "drug_name", "tty", "drug_type")
    return (
        _package_codes(raw_attributes)
        .join(names, "rxcui")
        .select(
            "rxcui",
            "drug_name",
            "tty",
            "drug_type",
            "ndc_original",
            "ndc_11_digit",
            "source_abbrev",
        )
    )


def prescribe_drug_ingredients(
    raw_edges: DataFrame, drugs: DataFrame, ingredients: DataFrame
) -> DataFrame:
    return (
        raw_edges.filter("rela = 'has_ingredient'")
        .select(c("rxcui1").alias("drug_rxcui"), c("rxcui2").alias("ingredient_rxcui"))
        .join(drugs.select(c("rxcui").alias("drug_rxcui"), "drug_name"), "drug_rxcui")
        .join(
            ingredients.select(c("rxcui").alias("ingredient_rxcui"), "ingredient_name"),
            "ingredient_rxcui",
        )
    )


def _drugs_flagged(flag: str) -> Callable[[DataFrame], DataFrame]:
    def view(drugs: DataFrame) -> DataFrame:
        return drugs.filter(c(flag) == "true").select("rxcui", "drug_name", "tty", "drug_type")

    return view


v_rxnorm_prescribe_generic = _drugs_flagged("is_generic")
v_rxnorm_prescribe_branded = _drugs_flagged("is_branded")


def v_rxnorm_prescribe_ndc_lookup(codes: DataFrame) -> DataFrame:
    return codes.select("ndc_11_digit", "ndc_original", "rxcui", "drug_name", "drug_type")


v_rxnorm_prescribe_drug_ndc_all = _codes_per("rxcui", "drug_name", "drug_type")


def v_rxnorm_prescribe_drugs_expanded(drugs: DataFrame, parts: DataFrame) -> DataFrame:
    """Drugs with their ingredients, grouped by drug id before the join."""
    per_drug = parts.groupBy(c("drug_rxcui").alias("rxcui")).agg(
        _set_of("ingredient_name").alias("ingredients"),
        _size_of("ingredient_rxcui").alias("ingredient_count"),
    )
    none = F.array().cast("array<string>")
    return drugs.join(per_drug, "rxcui", "left").select(
        "rxcui",
        "drug_name",
        "drug_type",
        "is_generic",
        "is_branded",
        "is_pack",
        F.coalesce("ingredients", none).alias("ingredients"),
        F.coalesce("ingredient_count", F.lit(0)).alias("ingredient_count"),
    )


# --- what is built from what -----------------------------------------------------------

Builder = Callable[..., DataFrame]

# Lookup tables: builder and inputs. An input is a file table or an earlier lookup.
TABLES: dict[str, tuple[Builder, Sequence[str]]] = {
    "lookup_hcpcs_codes": (hcpcs_codes, ("hcpcs_lines", "as_of")),
    "lookup_icd10cm_codes": (icd10cm_codes, ("icd_lines",)),
    "lookup_ndc_product": (ndc_product, ("ndc_product",)),
    "lookup_ndc_package": (ndc_package, ("ndc_package",)),
    "lookup_snomed_icd10cm_map": (snomed_icd10cm_map, ("snomed_map",)),
    "lookup_rxnorm_atoms": (atoms, ("atoms",)),
    "lookup_rxnorm_attributes": (unsuppressed, ("attributes",)),
    "lookup_rxnorm_relationships": (unsuppressed, ("relationships",)),
    "lookup_rxnorm_concepts": (concepts, ("atoms",)),
    "lookup_rxnorm_ndc_crosswalk": (ndc_crosswalk, ("attributes", "lookup_rxnorm_concepts")),
    "lookup_rxnorm_semantic_types": (unsuppressed, ("semantic_types",)),
    "lookup_rxnorm_sources": (unsuppressed, ("sources",)),
    "lookup_rxnorm_doc": (unsuppressed, ("doc",)),
    "lookup_rxnorm_cui_history": (unsuppressed, ("cui_history",)),
    "lookup_rxnorm_cui_changes": (unsuppressed, ("cui_changes",)),
    "lookup_rxnorm_atom_archive": (unsuppressed, ("atom_archive",)),
    "lookup_rxnorm_prescribe_drugs": (prescribe_drugs, ("prescribe_atoms",)),
    "lookup_rxnorm_prescribe_ingredients": (prescribe_ingredients, ("prescribe_atoms",)),
    "lookup_rxnorm_prescribe_ndc": (
        prescribe_ndc,
        ("prescribe_attributes", "lookup_rxnorm_prescribe_drugs"),
    ),
    "lookup_rxnorm_prescribe_drug_ingredients": (
        prescribe_drug_ingredients,
        (
            "prescribe_relationships",
            "lookup_rxnorm_prescribe_drugs",
            "lookup_rxnorm_prescribe_ingredients",
        ),
    ),
}

VIEWS: dict[str, tuple[Builder, Sequence[str]]] = {
    "v_hcpcs_active": (v_hcpcs_active, ("lookup_hcpcs_codes",)),
    "v_hcpcs_by_betos": (v_hcpcs_by_betos, ("lookup_hcpcs_codes",)),
    "v_hcpcs_pricing_summary": (v_hcpcs_pricing_summary, ("lookup_hcpcs_codes",)),
    "v_icd10cm_billable": (v_icd10cm_billable, ("lookup_icd10cm_codes",)),
    "v_icd10cm_categories": (v_icd10cm_categories, ("lookup_icd10cm_codes",)),
    "v_icd10cm_chapter_summary": (v_icd10cm_chapter_summary, ("lookup_icd10cm_codes",)),
    "v_icd10cm_lookup": (v_icd10cm_lookup, ("lookup_icd10cm_codes",)),
    "v_ndc_complete": (v_ndc_complete, ("lookup_ndc_package", "lookup_ndc_product")),
    "v_ndc_active": (v_ndc_active, ("v_ndc_complete",)),
    "v_ndc_lookup": (v_ndc_lookup, ("v_ndc_complete",)),
    "v_ndc_by_labeler": (v_ndc_by_labeler, ("v_ndc_complete",)),
    "v_ndc_controlled": (v_ndc_controlled, ("v_ndc_complete",)),
    "v_snomed_icd10cm_simple": (v_snomed_icd10cm_simple, ("lookup_snomed_icd10cm_map",)),
    "v_snomed_icd10cm_all": (v_snomed_icd10cm_all, ("lookup_snomed_icd10cm_map",)),
    "v_icd10cm_snomed_reverse": (v_icd10cm_snomed_reverse, ("lookup_snomed_icd10cm_map",)),
    "v_snomed_mapping_complexity": (
        v_snomed_mapping_complexity,
        ("lookup_snomed_icd10cm_map",),
    ),
    "v_rxnorm_clinical_drugs": (v_rxnorm_clinical_drugs, ("lookup_rxnorm_concepts",)),
    "v_rxnorm_branded_drugs": (v_rxnorm_branded_drugs, ("lookup_rxnorm_concepts",)),
    "v_rxnorm_ingredients": (v_rxnorm_ingredients, ("lookup_rxnorm_concepts",)),
    "v_rxnorm_ndc_lookup": (v_rxnorm_ndc_lookup, ("lookup_rxnorm_ndc_crosswalk",)),
    "v_rxcui_ndc_all": (v_rxcui_ndc_all, ("lookup_rxnorm_ndc_crosswalk",)),
    "v_rxnorm_drug_relationships": (
        v_rxnorm_drug_relationships,
        ("lookup_rxnorm_relationships", "lookup_rxnorm_concepts"),
    ),
    "v_rxnorm_drug_ingredients": (
        v_rxnorm_drug_ingredients,
        ("lookup_rxnorm_relationships", "lookup_rxnorm_concepts"),
    ),
    "v_rxnorm_concepts_with_types": (
        v_rxnorm_concepts_with_types,
        ("lookup_rxnorm_concepts", "lookup_rxnorm_semantic_types"),
    ),
    "v_rxnorm_prescribe_generic": (
        v_rxnorm_prescribe_generic,
        ("lookup_rxnorm_prescribe_drugs",),
    ),
    "v_rxnorm_prescribe_branded": (
        v_rxnorm_prescribe_branded,
        ("lookup_rxnorm_prescribe_drugs",),
    ),
    "v_rxnorm_prescribe_ndc_lookup": (
        v_rxnorm_prescribe_ndc_lookup,
        ("lookup_rxnorm_prescribe_ndc",),
    ),
    "v_rxnorm_prescribe_drug_ndc_all": (
        v_rxnorm_prescribe_drug_ndc_all,
        ("lookup_rxnorm_prescribe_ndc",),
    ),
    "v_rxnorm_prescribe_drugs_expanded": (
        v_rxnorm_prescribe_drugs_expanded,
        ("lookup_rxnorm_prescribe_drugs", "lookup_rxnorm_prescribe_drug_ingredients"),
    ),
}

# Views that hold a key's values as one array: what the values are, for ``code_chunks``.
CHUNKED: dict[str, tuple[str, str | None, Sequence[str], str]] = {
    "v_hcpcs_by_betos": ("lookup_hcpcs_codes", "betos_code != ''", ("betos_code",), "hcpcs_code"),
    "v_snomed_icd10cm_all": (
        "lookup_snomed_icd10cm_map",
        "has_target = 'true'",
        ("snomed_concept_id", "snomed_concept_name"),
        "icd10cm_code",
    ),
    "v_icd10cm_snomed_reverse": (
        "lookup_snomed_icd10cm_map",
        "has_target = 'true'",
        ("icd10cm_code", "icd10cm_name"),
        "snomed_concept_id",
    ),
    "v_rxcui_ndc_all": (
        "lookup_rxnorm_ndc_crosswalk",
        None,
        ("rxcui", "rxnorm_name", "tty"),
        "ndc_11_digit",
    ),
    "v_rxnorm_prescribe_drug_ndc_all": (
        "lookup_rxnorm_prescribe_ndc",
        None,
        ("rxcui", "drug_name", "drug_type"),
        "ndc_11_digit",
    ),
    "v_rxnorm_prescribe_drugs_expanded": (
        "lookup_rxnorm_prescribe_drug_ingredients",
        None,
        ("drug_rxcui", "drug_name"),
        "ingredient_name",
    ),
}


def code_chunks(view: str, find: Callable[[str], DataFrame], size: int = CHUNK) -> DataFrame:
    """The rows of an array view in chunks of at most ``size`` values (see ``chunked_sets``):
    for keys whose values do not fit one row. ``find`` gives a lookup table by its name."""
    table, condition, keys, value = CHUNKED[view]
    source = find(table) if condition is None else find(table).filter(condition)
    return chunked_sets(source, keys, value, size)


# Record source written into the audit column of each lookup table.
RECORD_SOURCES = {
    "lookup_hcpcs_codes": "HCPCS",
    "lookup_icd10cm_codes": "ICD10CM",
    "lookup_ndc_product": "NDC_PRODUCT",
    "lookup_ndc_package": "NDC_PACKAGE",
    "lookup_snomed_icd10cm_map": "SNOMED_ICD10CM",
    "lookup_rxnorm_atoms": "RXNORM_ATOMS",
    "lookup_rxnorm_attributes": "RXNORM_ATTRIBUTES",
    "lookup_rxnorm_relationships": "RXNORM_REL",
    "lookup_rxnorm_concepts": "RXNORM_CONCEPTS",
    "lookup_rxnorm_ndc_crosswalk": "RXNORM_NDC",
    "lookup_rxnorm_semantic_types": "RXNORM_STY",
    "lookup_rxnorm_sources": "RXNORM_SAB",
    "lookup_rxnorm_doc": "RXNORM_DOC",
    "lookup_rxnorm_cui_history": "RXNORM_CUI",
    "lookup_rxnorm_cui_changes": "RXNORM_CUICHANGES",
    "lookup_rxnorm_atom_archive": "RXNORM_ARCHIVE",
    "lookup_rxnorm_prescribe_drugs": "RXNORM_PRESCRIBE_DRUGS",
    "lookup_rxnorm_prescribe_ingredients": "RXNORM_PRESCRIBE_INGREDIENTS",
    "lookup_rxnorm_prescribe_ndc": "RXNORM_PRESCRIBE_NDC",
    "lookup_rxnorm_prescribe_drug_ingredients": "RXNORM_PRESCRIBE_DRUG_INGREDIENTS",
}
