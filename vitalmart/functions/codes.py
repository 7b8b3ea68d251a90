"""Medical code formats: drug codes, diagnosis codes, procedure codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalmart.functions.measures import recode


def undashed(code: Column) -> Column:
    return F.replace(code, F.lit("-"), F.lit(""))


def ndc11(code: Column) -> Column:
    """National drug code as 11 digits.

    A dashed code whose segments are one digit short in exactly one place (4-4-2, 5-3-2,
    5-4-1) is padded in that segment; anything else only loses its dashes.
    """
    short = code.rlike(r"^(\d{4}-\d{4}-\d{2}|\d{5}-\d{3}-\d{2}|\d{5}-\d{4}-\d)$")
    segment = F.split(code, "-")
    padded = F.concat(
        F.lpad(F.get(segment, F.lit(0)), 5, "0"),
        F.lpad(F.get(segment, F.lit(1)), 4, "0"),
        F.lpad(F.get(segment, F.lit(2)), 2, "0"),
    )
    return F.when(short, padded).otherwise(undashed(code))


def ndc9(product_code: Column) -> Column:
    """Labeler and product segments of a dashed product code as 9 digits."""
    segment = F.split(product_code, "-")
    return F.when(
        product_code.rlike(r"^\d{4,5}-\d{3,4}$"),
        F.concat(
            F.lpad(F.get(segment, F.lit(0)), 5, "0"), F.lpad(F.get(segment, F.lit(1)), 4, "0")
        ),
    ).otherwise(undashed(product_code))


def crosswalk_ndc(code: Column) -> Column:
    """Undashed code of 10 or 11 characters as 11; any other length gives NULL."""
    digits = undashed(code)
    return F.when(F.length(digits).isin(10, 11), F.lpad(digits, 11, "0"))


def dotted_icd(raw: Column) -> Column:
    """A dot after the third character of a longer code."""
    return F.when(
        F.length(raw) > 3, F.concat(F.substring(raw, 1, 3), F.lit("."), F.substr(raw, F.lit(4)))
    ).otherwise(raw)


def icd_level(raw: Column) -> Column:
    # Level name by code length.
    return recode(
        F.length(raw),
        {
            3: "CATEGORY",
            4: "SUBCATEGORY",
            5: "SUBCATEGORY_2",
            6: "SUBCATEGORY_3",
            7: "FULL_CODE",
        },
        "UNKNOWN",
    )


def procedure_family(code: Column) -> Column:
    return (
        F.when(code.rlike("^[0-9]"), "CPT")
        .when(code.rlike("^[A-Z]"), "HCPCS_LEVEL_II")
        .otherwise("OTHER")
    )


def dashed_date(compact: Column) -> Column:
    """``yyyymmdd`` text to ``yyyy-mm-dd`` text; blank gives NULL."""
    part = [F.substring(compact, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    return F.when(F.trim(compact) != "", F.concat_ws("-", *part))
