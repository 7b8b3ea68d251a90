"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitalmart.llm import (
    bpe,
    decontaminate,
    filter_audit,
    fingerprint,
    lines,
    ngram_join,
    quality,
    repeats,
    rules,
    secrets,
    spellings,
    token_files,
    urls,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op1_token_files(_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op2_bpe(_table(spark, sf_dir, "documents"), TOKENIZER)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op3_repeats(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.op4_line_dedup(_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op5_secrets(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.op6_url_filter(_table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op7_decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op8_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.op9_ngram_join(_table(spark, sf_dir, "documents"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op10_fingerprint(_table(spark, sf_dir, "documents"))


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.op11_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.op12_filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.op13_spellings(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_bpe,
        op3_repeats,
        op4_line_dedup,
        op5_secrets,
        op6_url_filter,
        op7_decontaminate,
        op8_quality,
        op9_ngram_join,
        op10_fingerprint,
        op11_rules,
        op12_filter_audit,
        op13_spellings,
    )
}
ORACLE: dict[str, str] = {"op4_line_dedup": lines.OP4_SQL, "op5_secrets": secrets.OP5_SQL, "op12_filter_audit": filter_audit.OP12_SQL}
