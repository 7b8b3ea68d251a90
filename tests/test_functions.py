"""Literal edge cases of the column functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vitalmart.functions import casts, codes, keys, measures
from vitalmart.plans import cleaned


def evaluate(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("function", "values", "expected"),
    [
        (
            casts.as_date,
            ["2020-02-29", " 2020-01-01 ", "2020-13-45", "2020-01-01T00:00:00Z", "", None],
            [dt.date(2020, 2, 29), dt.date(2020, 1, 1), None, None, None, None],
        ),
        (
            lambda v: casts.as_date(v, accept_timestamp=True),
            ["2020-01-01T10:00:00Z", "2020-01-02", "x"],
            [dt.date(2020, 1, 1), dt.date(2020, 1, 2), None],
        ),
        (
            casts.as_timestamp,
            ["2020-01-01T10:30:00Z", "2020-01-01 10:30", "2020-01-01"],
            [dt.datetime(2020, 1, 1, 10, 30), dt.datetime(2020, 1, 1, 10, 30), None],
        ),
        (
            casts.as_double,
            ["12", "-4.5", "5.", ".5", "1e5", "+1", "N/A", None],
            [12.0, -4.5, 5.0, None, None, None, None, None],
        ),
        (
            casts.as_decimal,
            ["12", "-4.555", "5.", ".5", "99999999999999999999"],
            [Decimal("12.00"), Decimal("-4.56"), Decimal("5.00"), None, None],
        ),
        (casts.as_long, ["3", "-3", "3.0", "99999999999999999999"], [3, -3, None, None]),
        (
            casts.measured_number,
            [".5", "5.", "7 mg", None],
            [Decimal("0.500000"), None, None, None],
        ),
        (casts.measured_text, [".5", "5.", "7 mg", None], [None, "5.", "7 mg", None]),
        (
            codes.ndc11,
            ["1234-5678-90", "12345-678-90", "12345-6789-0", "12345-6789-01", "123-45"],
            ["01234567890", "12345067890", "12345678900", "12345678901", "12345"],
        ),
        (codes.crosswalk_ndc, ["1234567890", "12345-6789-01", "123"], ["01234567890", "12345678901", None]),
        (codes.dotted_icd, ["A00", "A000", "S72001A"], ["A00", "A00.0", "S72.001A"]),
        (codes.procedure_family, ["00100", "A0100", "-"], ["CPT", "HCPCS_LEVEL_II", "OTHER"]),
        (codes.dashed_date, ["20200102", " ", None], ["2020-01-02", None, None]),
        (
            lambda v: measures.open_or("resolved", v),
            [None, "", " ", "2020"],
            ["active", "active", "resolved", "resolved"],
        ),
    ],
)
def test_text_functions(spark, function, values, expected):
    assert evaluate(spark, function, values) == expected


def test_surrogate_key_of_null_is_digest_of_nothing(spark):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert evaluate(spark, keys.surrogate_key, [None, ""]) == [empty, empty]


def test_date_key(spark):
    assert evaluate(spark, keys.date_key, [dt.date(2024, 3, 9), None], "date") == [20240309, None]


def test_rounding_of_exact_halves(spark):
    df = spark.createDataFrame(
        [(Decimal("19433.35"), Decimal("8.00"))], "part decimal(18,2), whole decimal(18,2)"
    )
    part, whole = F.col("part"), F.col("whole")
    assert df.select(measures.pct(part, whole)).first()[0] == 242916.88
    assert df.select(measures.pct(part, whole - whole)).first()[0] == 0.0
    assert df.select(measures.per_head(whole, F.lit(0))).first()[0] == 8.0


def test_bands_take_first_floor_and_missing_label(spark):
    floors = [(65, "old"), (18, "adult")]
    label = lambda v: measures.bands(v, floors, "young", "unknown")
    assert evaluate(spark, label, [17, 18, 64, 65, None], "int") == [
        "young",
        "adult",
        "adult",
        "old",
        "unknown",
    ]


def test_filled_slots_skip_null_and_blank(spark):
    df = spark.createDataFrame([("a", "", None, "b", "c")], "a string, b string, c string, d string, e string")
    assert df.select(measures.filled_slots(list("abcde"))).first()[0] == 3


def test_dataframe_steps(spark):
    df = spark.createDataFrame([("1.255",)], "amount string")
    out = df.transform(casts.safe_to_decimal("amount", "d", 10, 1)).transform(
        casts.safe_to_double("amount")
    )
    assert out.first().asDict() == {"amount": 1.255, "d": Decimal("1.3")}


def test_empty_payer_has_no_ratio(spark):
    columns = sorted({s for m in ("text", "money", "count") for s in getattr(cleaned.SPECS["payer"], m).values()})
    row = {c: "0" for c in columns} | {"_rec_src": "s"}
    raw = spark.createDataFrame([row], ", ".join(f"{c} string" for c in row))
    assert cleaned.build("payer", raw, dt.date(2024, 1, 1)).first()["coverage_ratio"] is None
