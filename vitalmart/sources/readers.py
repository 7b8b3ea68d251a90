"""Readers for raw CSV, whole-file text, tab, pipe and fixed-width inputs.

Every reader declares its schema, so no file is read twice for inference, and returns a
lazy frame. Columns derived from a file's path come from the hidden ``_metadata`` column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.sources import layouts, listing

# Where the generator puts its files below <root>/<state>/output/.
CSV_FOLDER, SYMPTOM_FOLDER = "csv", "symptoms/csv"
NOTE_FOLDER, ENCOUNTER_NOTE_FOLDER = "notes", "text_encounters"
PATIENT_UUID = "[a-f0-9-]{36}"


def glob_path(root: str, folder: str, file_name: str, state: str = "*") -> str:
    return f"{root.rstrip('/')}/{state}/output/{folder}/{file_name}"


def state_in(path: Column, folder: str) -> Column:
    return F.regexp_extract(path, rf"/([^/]+)/output/{folder}/", 1)


def tidy_names(lower: bool = False) -> Callable[[DataFrame], DataFrame]:
    """Spaces and dashes in column names become underscores, optionally in lower case."""

    def rename(df: DataFrame) -> DataFrame:
        plain = [c.translate(str.maketrans(" -", "__")) for c in df.columns]
        return df.toDF(*[c.lower() if lower else c for c in plain])

    return rename


def audit(record_source: str) -> Callable[[DataFrame], DataFrame]:
    """Load time, source file and record source of a frame read straight from files."""
    return lambda df: df.withColumns(
        {
            "_load_dts": F.current_timestamp(),
            "_file_name": F.col("_metadata.file_path"),
            "_rec_src": F.lit(record_source),
        }
    )


def stamped(record_source: str) -> Callable[[DataFrame], DataFrame]:
    """The two audit columns of lookup tables."""
    return lambda df: df.withColumns(
        {"_load_dts": F.current_timestamp(), "_rec_src": F.lit(record_source)}
    )


def drop_header_rows(df: DataFrame) -> DataFrame:
    """Remove header lines that a headerless read took for data."""
    first = df.columns[0]
    return df.filter(~F.col(first).eqNullSafe(F.lit(first)))


def read_raw(
    spark: SparkSession,
    root: str,
    table: str,
    system: str = "SYNTHEA",
    state: str = "*",
    header: bool = False,
    keep_header_rows: bool = False,
) -> DataFrame:
    """One raw CSV table over all states, every column text, with audit columns."""
    folder = SYMPTOM_FOLDER if table == "symptoms" else CSV_FOLDER
    scan = (
        spark.read.schema(layouts.text_schema(layouts.CSV_COLUMNS[table]))
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .csv(glob_path(root, folder, f"{table}.csv", state))
    )
    audited = scan.transform(audit(f"{system}.{table.upper()}")).withColumn(
        "_state", state_in(F.col("_file_name"), folder)
    )
    kept = audited if keep_header_rows or header else drop_header_rows(audited)
    return kept.transform(tidy_names())


def read_whole_files(
    spark: SparkSession, root: str, folder: str, record_source: str, named: str, pattern: str = "*.txt"
) -> DataFrame:
    """One row per file of ``<root>/<state>/output/<folder>`` whose path fits ``named``, its text
    as it is; empty files have no row.

    Tasks list the folders and read the files, so a file costs the driver nothing. Only where
    pyarrow does not know the file system does Spark's own scan list them, on the driver.
    """
    if not listing.reached(root):
        scan = spark.read.option("pathGlobFilter", pattern).text(glob_path(root, folder, ""), wholetext=True)
        return scan.transform(audit(record_source)).filter(F.col("_file_name").rlike(named))
    folders = listing.below(root, f"output/{folder}")
    if not folders:
        raise FileNotFoundError(f"no folder {glob_path(root, folder, '')}")
    names = listing.file_names(spark, root, folders, pattern).filter(F.col("shown").rlike(named))
    return listing.file_texts(names, root).withColumnRenamed("shown", "_file_name").transform(stamped(record_source))


def notes_of(files: DataFrame) -> DataFrame:
    """One note per patient file; the path carries name, patient and state."""
    path = F.col("_file_name")
    return files.select(
        F.regexp_extract(path, rf"({PATIENT_UUID})\.txt$", 1).alias("patient_id"),
        F.regexp_extract(path, rf"/([^/]+)_{PATIENT_UUID}\.txt$", 1).alias("patient_name"),
        F.col("value").alias("note_content"),
        state_in(path, NOTE_FOLDER).alias("_state"),
        "_load_dts",
        "_file_name",
        "_rec_src",
    ).filter(F.col("patient_id") != "")


def encounter_notes_of(files: DataFrame) -> DataFrame:
    """Notes per encounter; digits after the patient id number the encounter."""
    path = F.col("_file_name")
    return files.select(
        F.regexp_extract(path, rf"({PATIENT_UUID})\d*\.txt$", 1).alias("patient_id"),
        F.regexp_extract(path, rf"{PATIENT_UUID}(\d+)\.txt$", 1).alias("encounter_number"),
        F.col("value").alias("encounter_content"),
        state_in(path, ENCOUNTER_NOTE_FOLDER).alias("_state"),
        "_load_dts",
        "_file_name",
        "_rec_src",
    ).filter(F.col("patient_id") != "")


def read_notes(spark: SparkSession, root: str, system: str = "SYNTHEA") -> DataFrame:
    named = rf"{PATIENT_UUID}\.txt$"
    return notes_of(read_whole_files(spark, root, NOTE_FOLDER, f"{system}.NOTES", named))


def read_encounter_notes(spark: SparkSession, root: str, system: str = "SYNTHEA") -> DataFrame:
    named, source = rf"{PATIENT_UUID}\d*\.txt$", f"{system}.TEXT_ENCOUNTERS"
    return encounter_notes_of(read_whole_files(spark, root, ENCOUNTER_NOTE_FOLDER, source, named))


def read_tabbed(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return (
        spark.read.schema(layouts.text_schema(layouts.TAB_COLUMNS[layout]))
        .options(header=True, sep="\t", quote='"')
        .csv(path)
    )


def read_piped(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Concept file: quoting is off, since names may start with a quote, and the field
    after the closing pipe of each line is ignored. A short line leaves NULLs."""
    return (
        spark.read.schema(layouts.text_schema(layouts.PIPE_COLUMNS[layout]))
        .options(header=False, sep="|", quote="")
        .csv(path)
    )


def cut_fields(lines: DataFrame, record: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Fixed-width lines (column ``value``) as trimmed fields, in one projection."""
    return lines.select(
        *[F.trim(F.substring("value", start, width)).alias(name) for name, start, width in record]
    )


def read_fixed_width(
    spark: SparkSession, path: str, record: Sequence[tuple[str, int, int]]
) -> DataFrame:
    return cut_fields(spark.read.text(path), record)


def states_of(files: DataFrame) -> DataFrame:
    """Distinct, visible state folders in file paths (column ``path``), in order."""
    name = F.regexp_extract("path", r"/([^/]+)/output/", 1)
    return (
        files.select(name.alias("state"))
        .filter((F.col("state") != "") & ~F.col("state").startswith("."))
        .distinct()
        .orderBy("state")
    )


def states_under(spark: SparkSession, root: str) -> DataFrame:
    """The state folders below a source root that hold any file, listed by tasks up to the first."""
    if not listing.reached(root):
        return states_of(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root))
    return states_of(listing.first_files(spark, root, "output"))
