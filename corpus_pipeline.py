"""A training-data corpus in stages; each reads what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.llm import bpe, decontaminate, lines, ngram_join, quality
from vitalmart.llm.common import fresh, stored
from vitalmart.llm.queries import TOKENIZER


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier scores below its threshold.

    The network is fitted on labelled rows of ``docs``, of which there may be none: then all
    score 0.5 and go. NULL texts score as empty ones, equal texts alike, so repeated rows fare
    alike; an empty table stays empty; the columns are those of ``docs``.
    """
    net = quality.fit(*quality.sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return quality.keep_good(docs, net)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out of the texts and counts their characters anew.

    Lines are compared without spaces and carriage returns around them; short ones need more
    sites. Every document stays; one that had nothing but boilerplate has an empty text, a NULL
    text stays NULL. The row of the smallest id keeps a line (rows of one id alike, NULL ids
    last), so repeated rows fare alike and there are no ties; a NULL source is no site.
    """
    out = lines.drop_boilerplate(docs, n_lines="__n_lines", n_removed="__n_removed", edges=" \r")
    n_chars = F.when(F.col("__n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near-duplicates, once.

    Five-word shingles, four fifths in common. A document is an id with a text: rows of equal
    id and text (NULL and empty alike) are one, that of the smallest other columns, and
    different texts of one id are documents of their own, in the order of ``lines.row_key``.
    Documents without words are in no group and stay, as do all rows without an id.
    """
    key, place = fresh(docs, "__key"), fresh(docs, "__place")
    keyed = docs.where("doc_id is not null").withColumn(key, lines.row_key("doc_id", "text"))
    texts_of = keyed.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high"))

    def once(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.min(F.struct(docs.columns)).alias("row")).select("row.*", key)

    if texts_of.where("low <> high").isEmpty():
        found = ngram_join.join(docs).where(F.col("doc_id") != F.col("component_id"))
        left = once(keyed.join(found.select("doc_id").distinct(), "doc_id", "left_anti"))
    else:
        # Ids do not tell these documents apart, so they are numbered.
        rows = stored(once(keyed).withColumn(place, F.monotonically_increasing_id()), "pipeline-rows")
        found = ngram_join.join(rows, id_col=place).select(F.col("doc_id").alias(place), "component_id")
        first = rows.join(found, place).groupBy("component_id").agg(F.min_by(place, F.struct("doc_id", key)).alias(place))
        left = rows.join(first, place, "left_semi")
    return left.select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth of the words or more are benchmark passages.

    Documents without words, NULL and empty ones among them, stay; repeated rows fare alike;
    ids play no part. An empty or NULL item, or no item at all, drops nothing.
    """
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text left, packed as little-endian unsigned 32-bit integers.

    One row per row of ``docs``, repeated ones repeated. NULL and empty texts have no ids. Of
    other columns only ``lang`` and ``source`` go along.
    """
    coded = bpe.encode(docs, TOKENIZER, carry=("lang", "source"))
    return coded.select("doc_id", "lang", "source", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), "ids")


STAGES = [
    ("quality", classify),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", one_of_each),
    ("decontaminate", decontaminated),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stored and read again.

    Each stage works on what the one before it kept; odd rows are treated as the stages say. An
    empty table gives no row.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier is a fitted network and the groups are graph components: no SQL for these.
ORACLE_SQL = None
