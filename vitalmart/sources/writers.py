"""Files of their own for rows: one file a row, under a name the row gives.

Spark's writers name their part files themselves. Where a file's name carries data, as those
of patient notes do, tasks write the files, each under a name of its own first and then moved
to its place, so a task that runs twice leaves the same files and a reader never meets half
of one.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_row_files(df: DataFrame, root: str, path: str = "path", value: str = "value") -> int:
    """Write ``value`` of each row to the file ``<root>/<path>``; answers how many were written.

    ``root`` is a folder that all executors reach: a plain path, or a URI of a file system
    pyarrow knows. A value that is text is written as UTF-8, as it is, without a line end; NULL
    gives an empty file. Rows without a path are left out. Paths are taken as distinct; of rows
    that share one, any is left. Nothing but the count comes to the driver. Rows are dealt out by
    path first: a small table in one split may be very many files.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.where(F.col(path).isNotNull()).select(
        F.col(path).alias("path"), F.col(value).cast("binary").alias("value")
    ).repartition(parts, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = fs.FileSystem.from_uri(root)
        made: set[str] = set()
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                target = f"{top}/{name}"
                folder = posixpath.dirname(target)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                draft = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write(content or b"")
                system.move(draft, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["files"])

    return rows.mapInArrow(run, "files bigint").agg(F.sum("files")).first()[0] or 0
