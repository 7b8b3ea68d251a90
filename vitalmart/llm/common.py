"""Helpers the operators share: scratch tables, text columns, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ID = 2**63 - 1


_held: dict[str, Callable[[], None]] = {}


def take_over(operator: str, clear: Callable[[], None] | None = None) -> None:
    """Called by an operator's Python code in a worker process, which Spark uses again for
    other tasks: lets go of what other operators hold there, and notes how to clear its own."""
    others = [name for name in _held if name != operator]
    for name in others:
        _held.pop(name)()
    if others:
        pa.default_memory_pool().release_unused()
    if clear is not None:
        _held[operator] = clear


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor reaches.

    Where the setting is absent (tests), one is set for the session.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = tempfile.mkdtemp(prefix="vitalmart-llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read back: cuts the lineage."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, NULL text as empty: other columns cannot clash."""
    return df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def placed(docs: DataFrame, columns: Sequence[str], text_col: str) -> tuple[DataFrame, str]:
    """The columns named by their places (``c0``, ``c1``, ...), so that none can clash, with
    the text behind them unless it is one of them; and the name the text has."""
    named = [F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(columns)]
    if text_col in columns:
        return docs.select(*named), f"c{list(columns).index(text_col)}"
    return docs.select(*named, F.col(f"`{text_col}`").alias("t")), "t"


def named(columns: Sequence[str], taken: Sequence[str] = ()) -> list[Column]:
    """Back from places to names, without columns whose names are taken."""
    return [F.col(f"c{n}").alias(c) for n, c in enumerate(columns) if c not in taken]


def computed(
    docs: DataFrame,
    columns: Sequence[str],
    text_col: str,
    fields: Sequence[T.StructField],
    compute: Callable[[list[str]], Sequence[pa.Array]],
    most: int = 4 << 20,
) -> DataFrame:
    """Columns by place and behind them ``fields``, which ``compute`` makes of runs of texts.

    NULL texts are empty for ``compute``. A map over Arrow batches: nothing is shuffled.
    """
    frame, text = placed(docs, columns, text_col)
    kept = [f"c{n}" for n in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, most):
                found = compute([x or "" for x in batch.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], [*kept, *[f.name for f in fields]])

    return frame.mapInArrow(run, T.StructType([*frame.select(*kept).schema, *fields]))


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have, upper and lower case alike."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_or_last(column: str | Column = "doc_id") -> Column:
    """The id, with NULL as larger than all."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(MAX_ID))


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts, from one scan of that column."""
    return df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0


def parts_for(total: int, each: int) -> int:
    """How many parts of ``each`` hold ``total``, one at least."""
    return max(1, -(-total // each))


def slices(batch: pa.RecordBatch, text_col: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``most`` bytes, one row at least."""
    column = batch.column(text_col)
    ends = pa.compute.cumulative_sum(
        pa.compute.fill_null(pa.compute.binary_length(column), 0).cast(pa.int64())
    ).to_numpy()
    start, floor = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(ends.searchsorted(floor + most, "right")))
        yield batch.slice(start, stop - start)
        floor = int(ends[stop - 1])
        start = stop
