"""The 29 lookup views as catalog views: SQL kept under a name, resolved when it is read.

A view holds no rows. After a lookup table is overwritten, all views over it show the new
rows at once, and their filters and columns reach the scan of that table. Names in braces
stand for tables and views of the same schema. The builders in ``lookups.VIEWS`` give the
same rows for frames that are in no catalog; a test holds one against the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import SparkSession

from vitalmart.plans import lookups
from vitalmart.sources.tables import Layers


def _columns(names: Iterable[str], owner: str = "") -> str:
    return ", ".join(f"{owner}.{n}" if owner else n for n in names)


def _terms(terms: Sequence[str]) -> str:
    return f"({', '.join(repr(t) for t in terms)})"


def _concepts_of(*terms: str) -> str:
    return f"SELECT rxcui, rxnorm_name, tty, source_code FROM {{lookup_rxnorm_concepts}} WHERE tty IN {_terms(terms)}"


def _codes_per(keys: str, table: str) -> str:
    codes = "array_sort(collect_set(ndc_11_digit))"
    return f"SELECT {keys}, {codes} AS ndc_codes, CAST(size({codes}) AS BIGINT) AS ndc_count FROM {{{table}}} GROUP BY {keys}"


def _drugs_where(flag: str) -> str:
    return f"SELECT rxcui, drug_name, tty, drug_type FROM {{lookup_rxnorm_prescribe_drugs}} WHERE {flag} = 'true'"


def _distinct(column: str) -> str:
    return f"array_sort(collect_set({column}))"


def _how_many(column: str) -> str:
    return f"CAST(size(collect_set({column})) AS BIGINT)"


_MAPPED = "FROM {lookup_snomed_icd10cm_map} WHERE has_target = 'true'"
_GROUP, _PRIORITY = "try_cast(map_group AS INT)", "try_cast(map_priority AS INT)"
_TARGET = "snomed_concept_name, icd10cm_code, icd10cm_name, map_category_name, map_type"

VIEW_SQL: dict[str, str] = {
    "v_hcpcs_active": "SELECT * FROM {lookup_hcpcs_codes} WHERE is_active",
    "v_hcpcs_by_betos": f"""
        SELECT betos_code, count(*) AS code_count, {_distinct('hcpcs_code')} AS codes
        FROM {{lookup_hcpcs_codes}} WHERE betos_code <> '' GROUP BY betos_code""",
    "v_hcpcs_pricing_summary": """
        SELECT pricing_indicator_1 AS pricing_indicator, coverage_code, count(*) AS code_count
        FROM {lookup_hcpcs_codes} WHERE pricing_indicator_1 <> ''
        GROUP BY pricing_indicator_1, coverage_code""",
    "v_icd10cm_billable": """
        SELECT icd10cm_code, short_description, long_description, category_code, chapter_num, chapter_description
        FROM {lookup_icd10cm_codes} WHERE is_billable = 'true'""",
    "v_icd10cm_categories": """
        SELECT icd10cm_code AS category_code, short_description AS category_description, chapter_num, chapter_description
        FROM {lookup_icd10cm_codes} WHERE code_level = 'CATEGORY'""",
    "v_icd10cm_chapter_summary": """
        SELECT chapter_num, chapter_description, count(*) AS total_codes,
               count_if(is_billable = 'true') AS billable_codes, count_if(is_billable = 'false') AS header_codes
        FROM {lookup_icd10cm_codes} WHERE chapter_num IS NOT NULL
        GROUP BY chapter_num, chapter_description""",
    "v_icd10cm_lookup": """
        SELECT icd10cm_code, replace(icd10cm_code, '.', '') AS icd10cm_code_nodot,
               short_description, long_description, is_billable, chapter_num
        FROM {lookup_icd10cm_codes}""",
    "v_ndc_complete": f"""
        SELECT {_columns(lookups.PACKAGE_PART, 'k')}, {_columns(lookups.PRODUCT_PART, 'd')}, k.is_sample,
               if(k.is_active = 'true' AND d.is_active = 'true', 'true', 'false') AS is_active,
               k.start_marketing_date AS package_start_date, k.end_marketing_date AS package_end_date,
               d.start_marketing_date AS product_start_date, d.end_marketing_date AS product_end_date
        FROM {{lookup_ndc_package}} k LEFT JOIN {{lookup_ndc_product}} d ON d.product_id = k.product_id
        WHERE k.is_excluded = 'false' AND coalesce(d.is_excluded, 'false') = 'false'""",
    "v_ndc_active": "SELECT * FROM {v_ndc_complete} WHERE is_active = 'true' AND is_sample = 'false'",
    "v_ndc_lookup": f"""
        SELECT ndc_11_digit, ndc_package_code AS ndc_10_digit_dashed, {_columns(lookups.NDC_LOOKUP_PART)}
        FROM {{v_ndc_complete}} WHERE is_active = 'true'""",
    "v_ndc_by_labeler": """
        SELECT labeler_name, labeler_code, count(DISTINCT ndc_11_digit) AS ndc_count,
               count(DISTINCT nonproprietary_name) AS unique_drugs
        FROM {v_ndc_complete} WHERE is_active = 'true' GROUP BY labeler_name, labeler_code""",
    "v_ndc_controlled": "SELECT * FROM {v_ndc_complete} WHERE is_controlled = 'true' AND is_active = 'true'",
    "v_snomed_icd10cm_simple": f"""
        SELECT snomed_concept_id, best.* FROM (
          SELECT snomed_concept_id, min_by(struct({_TARGET}), struct({_GROUP}, {_PRIORITY}, {_TARGET})) AS best
          {_MAPPED} AND map_type IN ('EXACT', 'CONTEXT_DEPENDENT') GROUP BY snomed_concept_id)""",
    "v_snomed_icd10cm_all": f"""
        SELECT snomed_concept_id, snomed_concept_name, {_distinct('icd10cm_code')} AS icd10cm_codes,
               {_how_many('icd10cm_code')} AS icd10cm_code_count,
               min_by(map_category_name, struct({_GROUP}, {_PRIORITY}, icd10cm_code, map_category_name)) AS primary_map_category
        {_MAPPED} GROUP BY snomed_concept_id, snomed_concept_name""",
    "v_icd10cm_snomed_reverse": f"""
        SELECT icd10cm_code, icd10cm_name, {_distinct('snomed_concept_id')} AS snomed_concept_ids,
               {_distinct('snomed_concept_name')} AS snomed_concept_names,
               {_how_many('snomed_concept_id')} AS snomed_concept_count
        {_MAPPED} GROUP BY icd10cm_code, icd10cm_name""",
    "v_snomed_mapping_complexity": f"""
        SELECT snomed_concept_id, snomed_concept_name, count(*) AS total_mappings,
               count(DISTINCT map_group) AS map_groups, max({_PRIORITY}) AS max_priority,
               count_if(map_type = 'EXACT') AS exact_mappings,
               count_if(map_type = 'CONTEXT_DEPENDENT') AS context_dependent_mappings,
               count_if(requires_additional_code = 'true') AS mappings_needing_additional_code,
               CASE WHEN count(*) = 1 AND max(map_type) = 'EXACT' THEN 'SIMPLE_1_TO_1'
                    WHEN count(DISTINCT map_group) > 1 THEN 'COMPLEX_MULTI_GROUP'
                    WHEN max(map_type) = 'CONTEXT_DEPENDENT' THEN 'CONTEXT_DEPENDENT'
                    ELSE 'MULTIPLE_OPTIONS' END AS mapping_complexity
        {_MAPPED} GROUP BY snomed_concept_id, snomed_concept_name""",
    "v_rxnorm_clinical_drugs": _concepts_of("SCD"),
    "v_rxnorm_branded_drugs": _concepts_of("SBD"),
    "v_rxnorm_ingredients": _concepts_of(*lookups.INGREDIENT_TERMS),
    "v_rxnorm_ndc_lookup": """
        SELECT ndc_11_digit, ndc_original, rxcui, rxnorm_name, tty AS drug_type FROM {lookup_rxnorm_ndc_crosswalk}""",
    "v_rxcui_ndc_all": _codes_per("rxcui, rxnorm_name, tty", "lookup_rxnorm_ndc_crosswalk"),
    "v_rxnorm_drug_relationships": """
        SELECT e.rxcui1, a.rxnorm_name AS concept1_name, e.rel, e.rela, e.rxcui2, b.rxnorm_name AS concept2_name
        FROM {lookup_rxnorm_relationships} e
        LEFT JOIN {lookup_rxnorm_concepts} a ON a.rxcui = e.rxcui1
        LEFT JOIN {lookup_rxnorm_concepts} b ON b.rxcui = e.rxcui2""",
    "v_rxnorm_drug_ingredients": f"""
        SELECT d.rxcui AS drug_rxcui, d.rxnorm_name AS drug_name, d.tty AS drug_type,
               i.rxcui AS ingredient_rxcui, i.rxnorm_name AS ingredient_name
        FROM {{lookup_rxnorm_relationships}} e
        JOIN {{lookup_rxnorm_concepts}} d ON d.rxcui = e.rxcui1 AND d.tty IN {_terms([*lookups.DRUG_TERMS])}
        JOIN {{lookup_rxnorm_concepts}} i ON i.rxcui = e.rxcui2 AND i.tty IN {_terms([*lookups.INGREDIENT_TERMS])}
        WHERE e.rela = 'has_ingredient'""",
    "v_rxnorm_concepts_with_types": """
        SELECT c.rxcui, c.rxnorm_name, c.tty, s.tui, s.sty AS semantic_type
        FROM {lookup_rxnorm_concepts} c LEFT JOIN {lookup_rxnorm_semantic_types} s ON s.rxcui = c.rxcui""",
    "v_rxnorm_prescribe_generic": _drugs_where("is_generic"),
    "v_rxnorm_prescribe_branded": _drugs_where("is_branded"),
    "v_rxnorm_prescribe_ndc_lookup": """
        SELECT ndc_11_digit, ndc_original, rxcui, drug_name, drug_type FROM {lookup_rxnorm_prescribe_ndc}""",
    "v_rxnorm_prescribe_drug_ndc_all": _codes_per("rxcui, drug_name, drug_type", "lookup_rxnorm_prescribe_ndc"),
    "v_rxnorm_prescribe_drugs_expanded": f"""
        SELECT d.rxcui, d.drug_name, d.drug_type, d.is_generic, d.is_branded, d.is_pack,
               coalesce(p.ingredients, CAST(array() AS ARRAY<STRING>)) AS ingredients,
               coalesce(p.ingredient_count, 0) AS ingredient_count
        FROM {{lookup_rxnorm_prescribe_drugs}} d LEFT JOIN (
          SELECT drug_rxcui, {_distinct('ingredient_name')} AS ingredients, {_how_many('ingredient_rxcui')} AS ingredient_count
          FROM {{lookup_rxnorm_prescribe_drug_ingredients}} GROUP BY drug_rxcui) p ON p.drug_rxcui = d.rxcui""",
}


def needs_of(view: str) -> list[str]:
    """Tables and views that a view reads, in the order of their names."""
    return sorted(set(re.findall(r"\{(\w+)\}", VIEW_SQL[view])))


def in_order(views: Iterable[str]) -> list[str]:
    """The views and all views they read, each behind those."""
    graph, open_ = {}, list(views)
    while open_:
        view = open_.pop()
        if view not in graph:
            graph[view] = [n for n in needs_of(view) if n in VIEW_SQL]
            open_ += graph[view]
    return list(TopologicalSorter({v: graph[v] for v in sorted(graph)}).static_order())


def create_view(spark: SparkSession, view: str, layers: Layers, layer: str = "bronze") -> str:
    """Create or replace one view; answers its full name.

    Its tables must exist, their rows are not read. A table of the view's name, as earlier
    builds stored one, gives way to it.
    """
    name = layers.table(layer, view)
    catalog = spark.catalog
    if catalog.tableExists(name) and catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    body = VIEW_SQL[view].format_map({n: layers.table(layer, n) for n in needs_of(view)})
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
    return name


def create_views(spark: SparkSession, layers: Layers, views: Iterable[str] = tuple(VIEW_SQL), layer: str = "bronze") -> list[str]:
    """Create or replace views with those they read; answers the full names in that order."""
    return [create_view(spark, v, layers, layer) for v in in_order(views)]
