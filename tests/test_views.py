"""Catalog views over stored lookup tables: live, and equal to the builders over frames."""

import datetime as dt

import pytest

from checks.queries import Clinic, plain
from vitalmart.plans import lookups, views
from vitalmart.sources.tables import Layers, write_table

LAYERS = Layers(bronze="live_views")


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """All lookup tables as stored ones, and all views over them."""
    spark.sql(f"CREATE SCHEMA {LAYERS.bronze}")
    clinic = Clinic(spark, sf_dir)
    for name in lookups.TABLES:
        write_table(clinic[name], LAYERS.table("bronze", name))
    views.create_views(spark, LAYERS)
    return clinic


def test_every_view_has_its_sql():
    assert set(views.VIEW_SQL) == set(lookups.VIEWS)
    for name, (_, needs) in lookups.VIEWS.items():
        assert views.needs_of(name) == sorted(needs)
    order = views.in_order(["v_ndc_lookup", "v_ndc_active"])
    assert order[0] == "v_ndc_complete" and sorted(order[1:]) == ["v_ndc_active", "v_ndc_lookup"]


@pytest.mark.parametrize("name", views.VIEW_SQL)
def test_views_equal_the_builders(spark, stored, rows, name):
    live = plain(spark.table(LAYERS.table("bronze", name)))
    built = plain(stored[name])
    assert live.columns == built.columns and live.dtypes == built.dtypes
    assert rows(live) == rows(built) and not live.isEmpty()


def test_views_follow_their_tables(spark, stored):
    table, view = (LAYERS.table("bronze", n) for n in ("lookup_hcpcs_codes", "v_hcpcs_active"))
    assert spark.catalog.getTable(view).tableType == "VIEW"
    raw = stored.raw["hcpcs_lines"]
    was = spark.table(view).count()
    write_table(lookups.hcpcs_codes(raw, dt.date(2050, 1, 1)), table)
    now = spark.table(view).count()
    assert 0 < now < was  # fewer codes are active then, without any rebuild
    write_table(lookups.hcpcs_codes(raw.limit(0), dt.date(2050, 1, 1)), table)
    assert spark.table(view).count() == 0
    write_table(stored["lookup_hcpcs_codes"], table)
    assert spark.table(view).count() == was


def test_views_of_views_follow_too(spark, stored):
    table, view = (LAYERS.table("bronze", n) for n in ("lookup_ndc_package", "v_ndc_by_labeler"))
    assert spark.table(view).count() > 0
    write_table(stored["lookup_ndc_package"].limit(0), table)
    assert spark.table(view).count() == 0
    write_table(stored["lookup_ndc_package"], table)
    assert spark.table(view).count() > 0


def test_filters_and_columns_reach_the_scan(spark, stored):
    found = spark.table(LAYERS.table("bronze", "v_icd10cm_billable")).where("chapter_num = '02'").select("icd10cm_code")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(chapter_num,02)" in plan and "EqualTo(is_billable,true)" in plan
    assert "ReadSchema: struct<icd10cm_code:string,is_billable:string,chapter_num:string>" in plan


def test_a_stored_copy_gives_way(spark, stored):
    name = LAYERS.table("bronze", "v_rxnorm_ingredients")
    spark.sql(f"DROP VIEW {name}")
    spark.range(3).write.saveAsTable(name)
    assert views.create_view(spark, "v_rxnorm_ingredients", LAYERS) == name
    assert spark.catalog.getTable(name).tableType == "VIEW" and "rxcui" in spark.table(name).columns
    views.create_view(spark, "v_rxnorm_ingredients", LAYERS)  # twice is as once


def test_a_view_needs_its_tables(spark):
    spark.sql("CREATE SCHEMA no_tables")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        views.create_views(spark, Layers(bronze="no_tables"), ["v_hcpcs_active"])
