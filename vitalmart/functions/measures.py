"""Durations, rates, bands and flags used across the tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- durations -------------------------------------------------------------------------


def whole_years(start: Column, end: Column) -> Column:
    return F.floor(F.datediff(end, start) / F.lit(365.25)).cast("int")


def minutes_between(start: str, end: str) -> Column:
    """Whole minutes, cut towards zero; NULL when either end is missing."""
    seconds = F.unix_timestamp(_column(end)) - F.unix_timestamp(_column(start))
    return (seconds / F.lit(60)).cast("bigint")


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(_column(end), _column(start))


# --- statuses --------------------------------------------------------------------------


def is_blank(value: str | Column) -> Column:
    text = _column(value)
    return text.isNull() | (F.trim(text) == "")


def open_or(closed: str, end_text: str | Column) -> Column:
    """``active`` while the end is absent (NULL or exactly empty), else ``closed``."""
    text = _column(end_text)
    return F.when(text.isNull() | (text == ""), "active").otherwise(closed)


# --- arithmetic ------------------------------------------------------------------------


def or_zero(value: str | Column) -> Column:
    return F.coalesce(_column(value), F.lit(0))


def or_false(value: str | Column) -> Column:
    return F.coalesce(_column(value), F.lit(False))


def _cents(amount: Column) -> Column:
    """A two-place amount, or a count, as a whole-numbered double."""
    return (amount * 100).cast("double")


def pct(part: Column, whole: Column) -> Column:
    """Percentage to two places, 0 when there is no positive whole.

    Both sides become whole numbers before they are divided, so a quotient lying exactly
    between two results is seen as such and rounds up.
    """
    rate = F.round(_cents(part) * F.lit(100.0) / _cents(whole), 2)
    return F.when(whole > 0, rate).otherwise(F.lit(0.0))


def per_head(amount: Column, heads: Column) -> Column:
    """Amount per head to two places, with at least one head."""
    at_least_one = F.greatest(or_zero(heads), F.lit(1))
    return F.round(_cents(or_zero(amount)) / _cents(at_least_one), 2)


def count_where(flag: str | Column) -> Column:
    """How many rows have the flag set; a NULL flag counts as unset."""
    return F.count_if(_column(flag))


# --- classification --------------------------------------------------------------------


def bands(
    value: str | Column,
    floors: Sequence[tuple[float, str]],
    below: str,
    missing: str | None = None,
) -> Column:
    """Label of the highest floor reached.

    ``floors`` runs from high to low. NULL gets ``missing``, or ``below`` if not given.
    """
    number = _column(value)
    start = F.when(number.isNull(), F.lit(below if missing is None else missing))
    chain = reduce(lambda c, band: c.when(number >= band[0], F.lit(band[1])), floors, start)
    return chain.otherwise(F.lit(below))


def recode(value: str | Column, pairs: Mapping, default=None) -> Column:
    """Exact-match mapping; values outside it, and NULL, get the default."""
    source = _column(value)
    items = list(pairs.items())
    chain = F.when(source == items[0][0], F.lit(items[0][1]))
    for key, label in items[1:]:
        chain = chain.when(source == key, F.lit(label))
    return chain.otherwise(F.lit(default))


def true_false(condition: Column) -> Column:
    """A condition as the text ``true``/``false``; unknown counts as false."""
    return F.when(condition, "true").otherwise("false")


def filled_slots(columns: Sequence[str | Column]) -> Column:
    """How many of the columns hold non-blank text."""
    slots = F.array(*[F.when(~is_blank(c), F.lit(1)) for c in columns])
    return F.size(F.array_compact(slots))
