"""Files of folders that hold very many, listed and read by tasks.

Spark's file scans list every file on the driver, which keeps an entry for each, so a folder
with a file per note costs the driver memory for each of them. Here the driver sees folders
only: a task lists a folder, file names are dealt out as rows, and tasks read the files.
"""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How much text and how many names a task holds before it hands them on.
READ_BYTES, NAMES = 8 << 20, 10_000
# What a URI's path shows as it is; all else below 128 is written as a percent code.
QUOTED = re.compile(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=/@\u0080-\U0010ffff]")


def reached(root: str) -> bool:
    """Whether pyarrow knows the file system of ``root``, so that tasks can list it."""
    try:
        fs.FileSystem.from_uri(root)
    except (pa.ArrowException, OSError):
        return False
    return True


def is_hidden(name: str) -> bool:
    """Names that Spark's scans leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def entries(system: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """Paths in a folder and whether each is a folder; a local one is never held as a whole."""
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                yield entry.path, entry.is_dir()
    else:
        for info in system.get_file_info(fs.FileSelector(folder)):
            yield info.path, info.type == fs.FileType.Directory


def subfolders(root: str) -> list[str]:
    """Folders right below ``root``."""
    system, top = fs.FileSystem.from_uri(root)
    return sorted(path for path, is_folder in entries(system, top) if is_folder)


def below(root: str, folder: str) -> list[str]:
    """``<root>/*/<folder>``, where that is a folder."""
    system, _ = fs.FileSystem.from_uri(root)
    found = [f"{parent}/{folder}" for parent in subfolders(root)]
    return [info.path for info in system.get_file_info(found) if info.type == fs.FileType.Directory]


def shown_as(root: str, path: str) -> str:
    """A path as Spark's ``_metadata.file_path`` shows it."""
    system, top = fs.FileSystem.from_uri(root)
    start = "file:" if isinstance(system, fs.LocalFileSystem) else root[: -len(top)]
    return start + QUOTED.sub(lambda found: quote(found[0], safe=""), path)


def _per_folder(spark: SparkSession, folders: list[str], run, schema: str) -> DataFrame:
    """Rows that a task makes of each folder, one task a folder."""
    dealt = spark.sparkContext.parallelize([(f,) for f in folders], max(1, len(folders)))
    return spark.createDataFrame(dealt, "folder string").mapInArrow(run, schema)


def file_names(spark: SparkSession, root: str, folders: list[str], pattern: str) -> DataFrame:
    """Files right in ``folders`` whose name fits: ``path``, and ``shown`` as a scan names it."""

    def rows(paths: list[str]) -> pa.RecordBatch:
        shown = pa.array([shown_as(root, p) for p in paths], pa.string())
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), shown], ["path", "shown"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                held: list[str] = []
                for path, is_folder in entries(system, folder):
                    name = path.rsplit("/", 1)[-1]
                    if not is_folder and not is_hidden(name) and fnmatch.fnmatchcase(name, pattern):
                        held.append(path)
                    if len(held) == NAMES:
                        yield rows(held)
                        held = []
                yield rows(held)

    return _per_folder(spark, folders, run, "path string, shown string")


def file_texts(names: DataFrame, root: str) -> DataFrame:
    """Text of each named file, as it is: ``value`` and ``shown``; empty files have no row."""
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(shown: list[str], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(shown, pa.string())], ["value", "shown"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(root)
        shown, texts, held = [], [], 0
        for batch in batches:
            for path, name in zip(batch.column("path").to_pylist(), batch.column("shown").to_pylist()):
                with system.open_input_stream(path, compression=None) as file:
                    text = file.read()
                if text:
                    shown.append(name)
                    texts.append(text)
                    held += len(text) + len(name)
                if held >= READ_BYTES:
                    yield rows(shown, texts)
                    shown, texts, held = [], [], 0
        yield rows(shown, texts)

    # A number of partitions that is named is not merged again: few names may be much text.
    read = names.repartition(parts, "path").mapInArrow(run, "value binary, shown string")
    return read.select(F.col("value").cast("string").alias("value"), "shown")


def first_files(spark: SparkSession, root: str, part: str) -> DataFrame:
    """Of all that lies under ``root``: one file, not empty, below each folder named ``part``.

    Nothing below such a folder is listed beyond its first file, and files elsewhere have no
    row. Hidden files and folders are left out, as scans do.
    """

    def first(system: fs.FileSystem, folder: str) -> str | None:
        inner = []
        for path, is_folder in entries(system, folder):
            if is_hidden(path.rsplit("/", 1)[-1]):
                continue
            if is_folder:
                inner.append(path)
            elif system.get_file_info(path).size:
                return path
        return next(filter(None, (first(system, f) for f in inner)), None)

    def walk(system: fs.FileSystem, folder: str) -> Iterator[str]:
        for path, is_folder in entries(system, folder):
            name = path.rsplit("/", 1)[-1]
            if not is_folder or is_hidden(name):
                continue
            if name != part:
                yield from walk(system, path)
            elif found := first(system, path):
                yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                found = [shown_as(root, p) for p in walk(system, folder)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])

    seen = [f for f in subfolders(root) if not is_hidden(f.rsplit("/", 1)[-1])]
    return _per_folder(spark, seen, run, "path string")
