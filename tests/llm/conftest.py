import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

EXTRA = ("n_words", "spans", "items", "ids", "score", "decoded", "key", "block", "bucket", "c0", "t", "N_LINES", "__key", "label")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts_of(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns whose names clash."""
    long = "Alpha beta, gamma delta; " * 40_000
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, " \n\n \t", "en", None),
        (None, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "fr", "c"),
        (None, None, None, None),
        (5, long, "en", "a"),
        (6, long, "en", "b"),
        (7, "One.", None, "a"),
        (8, "é\u00a0ü 日本 😀 <|endoftext|> \x00 token: abcdefghijkl0123", "xx", "d"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    frame = frame.selectExpr("*", "cast(length(text) as bigint) as n_chars")
    return frame.selectExpr("*", *[f"cast(null as string) as `{c}`" for c in EXTRA])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
