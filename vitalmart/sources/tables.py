"""Table names by layer, optional tables, writes with metrics, and table checks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitalmart.session import remove_path


@dataclass(frozen=True)
class Layers:
    """Schema of each layer; an unknown layer name is used as the schema itself."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer, layer)}.{name}"


def pipe(value, *steps: Callable):
    """Apply steps from left to right."""
    return reduce(lambda done, step: step(done), steps, value)


def compose(*steps: Callable) -> Callable:
    """One function applying steps from right to left."""
    return lambda value: pipe(value, *reversed(steps))


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None where it does not exist; builders then fill typed NULLs."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def typed_nulls(columns: Iterable[str], kind: str = "string") -> list[Column]:
    return [F.lit(None).cast(kind).alias(c) for c in columns]


# --- writing ---------------------------------------------------------------------------

# Refresh columns a table kind receives when it is written.
REFRESH_COLUMNS = {
    "cleaned": ("last_updated",),
    "dimension": ("dim_created_dts", "dim_refresh_dts"),
    "fact": ("fact_created_dts", "fact_refresh_dts"),
    "aggregate": ("agg_refresh_dts",),
}


def with_refresh_times(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumns({c: F.current_timestamp() for c in REFRESH_COLUMNS.get(kind, ())})


@dataclass(frozen=True)
class Written:
    """Outcome of writing one table; a view has no row count of its own."""

    stage: str
    table_name: str
    row_count: int | None
    elapsed_seconds: float
    success: bool
    error: str | None = None


def _parts(name: str) -> tuple[str, str]:
    """Schema (the session's own where none is named) and table of a name."""
    schema, _, table = name.rpartition(".")
    return schema, table


def write_table(
    df: DataFrame,
    name: str,
    stage: str = "",
    kind: str = "",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> Written:
    """Replace a Parquet table in one job; rows are counted while they are written.

    The rows go to a table beside it first. Only when that is complete, and holds as many rows
    as were seen, does it take the table's place (see ``swap_table``): a write that fails half
    way leaves the old table as it was, and a table may be made of its own rows.

    ``bucket_by`` (bucket count, column) stores a table hashed and sorted by its join key,
    so later joins and rollups on that key need no shuffle. A bucket is one task when it is
    read, so this is for tables with few rows per key.
    """
    spark = df.sparkSession
    seen = Observation()
    counted = with_refresh_times(df, kind).observe(seen, F.count(F.lit(1)).alias("rows"))
    if bucket_by:  # a task holds whole buckets, so there is one file per bucket
        counted = counted.repartition(*bucket_by)
    writer = counted.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    draft = f"{name}{DRAFT}{uuid.uuid4().hex}"
    began = time.monotonic()
    try:
        writer.saveAsTable(draft)
        rows = seen.get["rows"]
        held = spark.table(draft).count()  # from the files' footers
        if held != rows:
            raise RuntimeError(f"{name}: {rows} rows written, {held} found")
        swap_table(spark, draft, name)
    except Exception:
        drop_draft(spark, draft)
        raise
    return Written(stage, name, rows, round(time.monotonic() - began, 3), True)


# Marks in the names of tables that are being written and of those that are being replaced.
DRAFT, FORMER = "__draft_", "__former_"


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if any(c.isPartition for c in spark.catalog.listColumns(new)):
        # Some catalogs keep the places of partitions, which move with the table.
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def swap_table(spark: SparkSession, draft: str, name: str) -> None:
    """Let a finished table take the place of another one, or of none.

    The former table stays under another name until the new one has its name, and gets its own
    back if that fails; ``recover_tables`` does so after a driver was lost in between.
    """
    if not spark.catalog.tableExists(name):
        _rename(spark, draft, name)
        return
    former = f"{name}{FORMER}{uuid.uuid4().hex}"
    _rename(spark, name, former)
    try:
        _rename(spark, draft, name)
    except Exception:
        if not spark.catalog.tableExists(name):
            _rename(spark, former, name)
        raise
    spark.sql(f"DROP TABLE {former}")


def drop_draft(spark: SparkSession, draft: str) -> None:
    """Drop a table that was not finished, and the folder a failed write has left of it."""
    spark.sql(f"DROP TABLE IF EXISTS {draft}")
    schema, table = _parts(draft)
    place = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    remove_path(spark, f"{place.rstrip('/')}/{table.lower()}")


def recover_tables(spark: SparkSession, schema: str) -> list[str]:
    """Put right what runs that were cut off have left in a schema; answers the tables restored.

    A replaced table whose successor never got the name gets it back; drafts and replaced
    tables that are no longer needed are dropped. Only for schemas no other run writes to.
    """
    restored = []
    for table in list_tables(spark, schema):
        name, found, _ = table.partition(FORMER)
        if found and spark.catalog.tableExists(f"{schema}.{name}"):
            spark.sql(f"DROP TABLE {schema}.{table}")
        elif found:
            _rename(spark, f"{schema}.{table}", f"{schema}.{name}")
            restored.append(name)
        elif DRAFT in table:
            drop_draft(spark, f"{schema}.{table}")
    return restored


def attempt(
    stage: str,
    name: str,
    write: Callable[[], Written],
    note: Callable[[Written], object] | None = None,
) -> Written:
    """Log entry of one table; a failure becomes an entry instead of ending the run. ``note``
    gets the entry as soon as there is one."""
    began = time.monotonic()
    try:
        entry = replace(write(), table_name=name)
    except Exception as problem:  # noqa: BLE001 - recorded, not hidden
        took = round(time.monotonic() - began, 3)
        entry = Written(stage, name, 0, took, False, str(problem))
    if note is not None:
        note(entry)
    return entry


RUN_LOG_SCHEMA = (
    "stage string, table_name string, row_count bigint, elapsed_seconds double, "
    "success boolean, error string"
)


def run_log(spark: SparkSession, results: Sequence[Written]) -> DataFrame:
    return spark.createDataFrame([asdict(r) for r in results], RUN_LOG_SCHEMA)


def stage_summary(log: DataFrame) -> DataFrame:
    """Tables, successes, rows and seconds per stage."""
    return log.groupBy("stage").agg(
        F.count("*").alias("tables_processed"),
        F.count_if("success").alias("tables_successful"),
        F.sum("row_count").alias("total_rows"),
        F.round(F.sum("elapsed_seconds"), 3).alias("elapsed_seconds"),
        F.bool_and("success").alias("success"),
        F.array_compact(F.array_sort(F.collect_list("error"))).alias("errors"),
    )


class RunLog:
    """Entries of one run or many, appended to a JSON folder one by one as tables are written,
    so that what a run did can be read after it broke off."""

    def __init__(self, spark: SparkSession, path: str, run: str | None = None):
        self.spark, self.path = spark, path
        self.run = run or uuid.uuid4().hex

    def note(self, entry: Written) -> None:
        added = run_log(self.spark, [entry]).select(
            F.lit(self.run).alias("run"), F.current_timestamp().alias("logged_at"), "*"
        )
        added.coalesce(1).write.mode("append").json(self.path)

    def attempt(self, stage: str, name: str, write: Callable[[], Written]) -> Written:
        return attempt(stage, name, write, self.note)

    def read(self, every_run: bool = False) -> DataFrame:
        """Entries of this run, or of all runs that were noted in the folder."""
        schema = f"run string, logged_at timestamp, {RUN_LOG_SCHEMA}"
        found = self.spark.read.schema(schema).json(self.path)
        return found if every_run else found.filter(F.col("run") == self.run)


def write_run_metadata(log: DataFrame, path: str) -> None:
    stage_summary(log).write.mode("overwrite").json(path)


# --- checks ----------------------------------------------------------------------------


def table_counts(frames: dict[str, DataFrame | None]) -> DataFrame:
    """One row per expected table: its rows, or status MISSING where there is none."""

    def row(name: str, df: DataFrame | None, spark: SparkSession) -> DataFrame:
        label = F.lit(name).alias("table_name")
        if df is None:
            absent = F.lit(None).cast("bigint").alias("row_count")
            return spark.range(1).select(label, absent, F.lit("MISSING").alias("status"))
        counted = df.agg(F.count("*").alias("row_count"))
        return counted.select(label, "row_count", F.lit("OK").alias("status"))

    spark = next(df for df in frames.values() if df is not None).sparkSession
    return reduce(DataFrame.unionByName, [row(n, df, spark) for n, df in frames.items()])


def verify_tables(spark: SparkSession, schema: str, expected: Iterable[str]) -> DataFrame:
    return table_counts({t: optional_table(spark, f"{schema}.{t}") for t in expected})


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    """Tables and views of a schema; temporary views are in none."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type")


CATALOG_SCHEMA = (
    "table_name string, table_type string, column_name string, position int, data_type string"
)


def catalog_rows(spark: SparkSession, schema: str) -> DataFrame:
    """One row per column of every table and view of a schema, as the catalog has them now."""
    rows = [
        (table, spark.catalog.getTable(f"{schema}.{table}").tableType, c.name, n, c.dataType)
        for table in list_tables(spark, schema)
        for n, c in enumerate(spark.catalog.listColumns(f"{schema}.{table}"), 1)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def catalog_differences(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected columns beside those of a catalog, one row each with its ``status``.

    ``expected`` has ``table_name``, ``column_name`` and ``data_type`` (NULL where any will do).
    A column is OK, of OTHER TYPE, or MISSING, with its TABLE MISSING altogether; columns of
    expected tables that nobody expects are EXTRA. Names are compared in lower case.
    """
    key = [F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")]
    have = found.select(*key, F.col("data_type").alias("found_type"))
    want = expected.select(*key, "data_type", F.lit(True).alias("wanted"))
    tables = have.select("table_name").distinct().withColumn("there", F.lit(True))
    asked = want.select("table_name").distinct()
    both = have.join(asked, "table_name", "left_semi").join(want, ["table_name", "column_name"], "full")
    status = (
        F.when(F.col("wanted").isNull(), "EXTRA")
        .when(F.col("there").isNull(), "TABLE MISSING")
        .when(F.col("found_type").isNull(), "MISSING")
        .when(F.col("found_type") != F.col("data_type"), "OTHER TYPE")
        .otherwise("OK")
    )
    return both.join(tables, "table_name", "left").select(
        "table_name", "column_name", "data_type", "found_type", status.alias("status")
    )
