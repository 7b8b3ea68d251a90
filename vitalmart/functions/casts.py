"""Typed conversions that answer NULL instead of failing on bad text.

Spark runs with ANSI casts, so a bare cast stops the job on the first malformed value.
Each conversion here trims, checks the accepted shape and then uses ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted text shapes.
NUMBER_SHAPE = r"^-?\d+\.?\d*$"
INTEGER_SHAPE = r"^-?\d+$"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"
MEASURED_SHAPE = r"^-?[0-9]*\.?[0-9]+$"


def _typed(value: Column, shape: str, target: str) -> Column:
    text = F.trim(value)
    return F.when(text.rlike(shape), text.try_cast(target))


def as_date(value: Column, accept_timestamp: bool = False) -> Column:
    """``yyyy-MM-dd`` only; with ``accept_timestamp`` the date of a timestamp text too."""
    strict = _typed(value, DATE_SHAPE, "date")
    if not accept_timestamp:
        return strict
    return F.coalesce(strict, as_timestamp(value).cast("date"))


def as_timestamp(value: Column) -> Column:
    return _typed(value, TIMESTAMP_SHAPE, "timestamp")


def as_double(value: Column) -> Column:
    return _typed(value, NUMBER_SHAPE, "double")


def as_decimal(value: Column, precision: int = 18, scale: int = 2) -> Column:
    return _typed(value, NUMBER_SHAPE, f"decimal({precision},{scale})")


def as_long(value: Column) -> Column:
    return _typed(value, INTEGER_SHAPE, "bigint")


def measured_number(value: Column) -> Column:
    """The numeric half of an observation value, untrimmed by design."""
    return F.when(value.rlike(MEASURED_SHAPE), value.try_cast("decimal(18,6)"))


def measured_text(value: Column) -> Column:
    """The non-numeric half of an observation value."""
    return F.when(~value.rlike(MEASURED_SHAPE), value)


def _step(convert: Callable[..., Column]) -> Callable[..., Callable[[DataFrame], DataFrame]]:
    """Lift a column conversion into a ``DataFrame.transform`` step."""

    def configured(col_name: str, new_name: str | None = None, *args, **kwargs):
        return lambda df: df.withColumn(
            new_name or col_name, convert(F.col(col_name), *args, **kwargs)
        )

    return configured


safe_to_date = _step(as_date)
safe_to_timestamp = _step(as_timestamp)
safe_to_double = _step(as_double)
safe_to_decimal = _step(as_decimal)
safe_to_long = _step(as_long)
