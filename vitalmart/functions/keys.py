"""Deterministic keys: hashed ids, surrogate keys and integer date keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(part: str | Column) -> Column:
    return F.col(part) if isinstance(part, str) else part


def hashed(*parts: str | Column) -> Column:
    """SHA-256 over the parts joined by ``|``, absent parts counting as empty."""
    filled = [F.coalesce(_column(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *filled), 256)


def surrogate_key(*parts: str | Column) -> Column:
    """Table key. A lone NULL hashes like the empty string, so filter NULLs before joins."""
    return hashed(*parts)


def generate_id(*key_cols: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("id", hashed(*key_cols))


def date_key(moment: str | Column) -> Column:
    """``yyyymmdd`` as an integer, by arithmetic instead of text formatting."""
    day = _column(moment)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
