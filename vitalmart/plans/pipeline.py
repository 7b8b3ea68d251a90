"""Building every table from files to mart, in one fixed order, with a run log."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable, Mapping, Set

from pyspark.sql import DataFrame, SparkSession

from vitalmart.plans import cleaned, cms, lookups, reports, star, views
from vitalmart.sources import layouts, readers
from vitalmart.sources.tables import (
    Layers,
    RunLog,
    Written,
    attempt,
    optional_table,
    run_log,
    write_table,
)

Note = Callable[[Written], object] | None
MART = {**star.TABLES, **cms.TABLES}
TEXT_TABLES: dict[str, Callable[..., DataFrame]] = {
    "notes": readers.read_notes,
    "text_encounters": readers.read_encounter_notes,
}


def require(name: str, failed: Set[str]) -> str:
    """The name of a stored table, refused if writing it failed earlier in the same run: what
    is stored then is missing or left over from another run."""
    if name in failed:
        raise RuntimeError(f"needs {name}, which failed in this run")
    return name


def failures(results: Iterable[Written], layers: Layers, layer: str) -> set[str]:
    return {layers.table(layer, r.table_name) for r in results if not r.success}


def arguments(needs, find: Callable[[str], object], spark: SparkSession, as_of: dt.date) -> list:
    """Builder inputs by name: the session, the as-of date, or a table."""
    special = {"spark": spark, "as_of": as_of}
    return [special[n] if n in special else find(n) for n in needs]


def build_raw(
    spark: SparkSession,
    root: str,
    layers: Layers,
    system: str = "SYNTHEA",
    note: Note = None,
    **options,
) -> list[Written]:
    """All CSV and text tables, stored per state."""

    def csv(table: str):
        return lambda: write_table(
            readers.read_raw(spark, root, table, system, **options),
            layers.table("bronze", f"bronze_{table}"),
            "bronze",
            partition_by=("_state",),
        )

    def text(table: str):
        return lambda: write_table(
            TEXT_TABLES[table](spark, root, system),
            layers.table("bronze", f"bronze_{table}"),
            "bronze",
        )

    jobs = {**{t: csv(t) for t in layouts.CSV_COLUMNS}, **{t: text(t) for t in TEXT_TABLES}}
    return [attempt("bronze", f"bronze_{t}", job, note) for t, job in jobs.items()]


def build_lookups(
    spark: SparkSession,
    files: Mapping[str, Callable[[], DataFrame]],
    layers: Layers,
    as_of: dt.date,
    failed: set[str] | None = None,
    note: Note = None,
) -> list[Written]:
    """Lookup tables out of file readers by name, and catalog views over them.

    Views store nothing and show what their tables hold when they are read. Tables that fail
    are added to ``failed``, and tables and views that need them fail too.
    """
    failed = set() if failed is None else failed

    def find(name: str) -> DataFrame:
        if name in files:
            return files[name]()
        return spark.table(require(layers.table("bronze", name), failed))

    def table(name: str):
        maker, needs = lookups.TABLES[name]

        def run() -> Written:
            built = maker(*arguments(needs, find, spark, as_of))
            source = f"REFERENCE.{lookups.RECORD_SOURCES[name]}"
            return write_table(
                built.transform(readers.stamped(source)), layers.table("bronze", name), "lookups"
            )

        return run

    def view(name: str):
        def run() -> Written:
            began = time.monotonic()
            for need in views.needs_of(name):
                require(layers.table("bronze", need), failed)
            made = views.create_view(spark, name, layers)
            return Written("lookup_views", made, None, round(time.monotonic() - began, 3), True)

        return run

    results = []
    for name in lookups.TABLES:
        results.append(attempt("lookups", name, table(name), note))
        failed |= failures(results[-1:], layers, "bronze")
    for name in views.in_order(views.VIEW_SQL):
        results.append(attempt("lookup_views", name, view(name), note))
        failed |= failures(results[-1:], layers, "bronze")
    return results


def build_cleaned(
    spark: SparkSession,
    layers: Layers,
    as_of: dt.date,
    failed: Set[str] = frozenset(),
    note: Note = None,
) -> list[Written]:
    """Cleaned entities. A lookup table that was never there gives typed NULLs; one in
    ``failed`` fails the entity."""

    def lookup(name: str) -> DataFrame | None:
        return optional_table(spark, require(layers.table("bronze", name), failed))

    def job(entity: str):
        def run() -> Written:
            source = layers.table("bronze", f"bronze_{cleaned.SPECS[entity].raw}")
            raw = spark.table(require(source, failed))
            built = cleaned.build(entity, raw, as_of, lookup)
            name = layers.table("silver", cleaned.TABLE_NAMES[entity])
            return write_table(built, name, "silver", "cleaned")

        return run

    return [attempt("silver", cleaned.TABLE_NAMES[e], job(e), note) for e in cleaned.SPECS]


def mart_source(
    spark: SparkSession, layers: Layers, failed: Set[str] = frozenset()
) -> Callable[[str], DataFrame]:
    """Find mart tables in the gold layer and cleaned entities in the silver layer."""

    def find(name: str) -> DataFrame:
        if name in cleaned.TABLE_NAMES:
            return spark.table(require(layers.table("silver", cleaned.TABLE_NAMES[name]), failed))
        return spark.table(require(layers.table("gold", name), failed))

    return find


def build_mart(
    spark: SparkSession,
    layers: Layers,
    as_of: dt.date,
    failed: set[str] | None = None,
    note: Note = None,
) -> list[Written]:
    """Star schema and CMS mart. Facts are not bucketed: a bucket is one task when it is read,
    and one patient may own a large share of them."""
    failed = set() if failed is None else failed
    find = mart_source(spark, layers, failed)

    def job(name: str):
        kind, maker, needs = MART[name]

        def run() -> Written:
            built = maker(*arguments(needs, find, spark, as_of))
            return write_table(built, layers.table("gold", name), "gold", kind)

        return run

    results = []
    for name in MART:
        results.append(attempt("gold", name, job(name), note))
        failed |= failures(results[-1:], layers, "gold")
    return results


def build_all(
    spark: SparkSession,
    root: str,
    files: Mapping[str, Callable[[], DataFrame]],
    layers: Layers,
    as_of: dt.date,
    keep_going: bool = False,
    log_path: str | None = None,
    **raw_options,
) -> DataFrame:
    """Every table once, in dependency order; answers the run log. With ``log_path`` each entry
    is also appended there as soon as its table is written (see ``RunLog``).

    A table that needs a failed one fails too, so nothing is built on missing lookups or on
    tables left over from another run. With ``keep_going`` it takes whatever is stored.
    """
    failed: set[str] = set()
    note = RunLog(spark, log_path).note if log_path else None

    def known() -> set[str]:
        return set() if keep_going else failed

    results = build_raw(spark, root, layers, note=note, **raw_options)
    failed |= failures(results, layers, "bronze")
    results += build_lookups(spark, files, layers, as_of, known(), note)
    entities = build_cleaned(spark, layers, as_of, known(), note)
    failed |= failures(entities, layers, "silver")
    results += entities + build_mart(spark, layers, as_of, known(), note)
    return run_log(spark, results)


def register_report_views(spark: SparkSession, layers: Layers) -> list[str]:
    """Temporary views of the analyst layer; ``dim_diagnosis`` may lack its source."""
    find = mart_source(spark, layers)
    made: dict[str, DataFrame] = {}
    for name, (maker, needs) in reports.VIEWS.items():
        if name == "dim_diagnosis":
            source = optional_table(spark, layers.table("silver", cleaned.TABLE_NAMES["condition"]))
            made[name] = maker(source, spark)
        else:
            made[name] = maker(*[made[n] if n in made and n != name else find(n) for n in needs])
        made[name].createOrReplaceTempView(name)
    return list(made)


def code_files(
    spark: SparkSession, folders: Mapping[str, str]
) -> dict[str, Callable[[], DataFrame]]:
    """Readers of all public code files by name; ``folders`` gives the folder of each
    source: hcpcs, icd10cm, ndc, snomed, rxnorm, rxnorm_prescribe. A missing file then
    fails only the tables that need it."""

    def lines(source: str, pattern: str):
        return lambda: spark.read.text(f"{folders[source]}/{pattern}")

    def tabbed(source: str, pattern: str, layout: str):
        return lambda: readers.read_tabbed(spark, f"{folders[source]}/{pattern}", layout)

    def piped(source: str, file: str, layout: str):
        return lambda: readers.read_piped(spark, f"{folders[source]}/{file}", layout)

    # File patterns inside the folders.
    found = {
        "hcpcs_lines": lines("hcpcs", "HCPC*.txt"),
        "icd_lines": lines("icd10cm", "txt/icd10cm-order-*.txt"),
        "ndc_product": tabbed("ndc", "product.txt", "ndc_product"),
        "ndc_package": tabbed("ndc", "package.txt", "ndc_package"),
        "snomed_map": tabbed(
            "snomed", "tls_Icd10cmHumanReadableMap_US1000124_*.tsv", "snomed_map"
        ),
    }
    for name, file in layouts.PIPE_FILES.items():
        found[name] = piped("rxnorm", file, name)
    for name in ("atoms", "attributes", "relationships"):
        subset = f"prescribe_{name}"
        found[subset] = piped("rxnorm_prescribe", layouts.PIPE_FILES[name], subset)
    return found
