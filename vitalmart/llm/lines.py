"""Line dedup by the spread of a line over distinct sites; DataFrame operations only.

Every map task sketches the sites of the lines it sees: a HyperLogLog sketch for each line and
range of sites, so a line that a third of all documents hold is some small rows a task. The
sketches of a line are merged by aggregation, first by range and then over the ranges, and
estimate its sites. Lines far below their threshold, nearly all, are done with; the
occurrences of the others are picked out. Lines far above the threshold are decided by the
estimate, and only for lines near it are (line, site) pairs made and counted exactly. Lines on
enough sites are boilerplate; they go from every document but the one of the smallest id that
has them, so no content is lost altogether.

A short line needs more sites than a long one: a bracket, a list mark or a one-word heading
comes up on many sites by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import fresh, id_or_last, stored

MIN_SITES = 5
SHORT_CHARS = 20  # lines of fewer characters are short
SHORT_MIN_SITES = 20
LG_K = 12
MARGIN = 0.25  # 15 standard errors of a sketch of 2**12 registers
SITE_RANGES = 16


def row_key(id_col: str, text_col: str) -> Column:
    """Equal for rows of equal id and text only, and for these always."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(F.col(text_col), F.lit(""))))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def spread(lines: DataFrame, lg_k: int = LG_K, ranges: int = SITE_RANGES) -> DataFrame:
    """``h1``, ``h2``, ``need``, the estimate ``sites`` and the smallest id ``first`` of each line.

    ``lines`` has ``h1``, ``h2``, ``need`` (sites that make the line boilerplate), ``site`` and
    ``id``. NULL sites count as none.
    """
    part = F.pmod(F.xxhash64("site"), F.lit(ranges))
    parts = lines.groupBy("h1", "h2", "need", part.alias("part")).agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min("id").alias("first")
    )
    return parts.groupBy("h1", "h2", "need").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sites"), F.min("first").alias("first")
    )


def boilerplate_places(lines: DataFrame, lg_k: int = LG_K, margin: float = MARGIN) -> DataFrame:
    """The rows of ``lines`` (see ``spread``) of lines on enough sites, each with the smallest id
    ``first`` that has the line."""
    key = ["h1", "h2"]
    likely = spread(lines, lg_k).where(F.col("sites") >= F.col("need") * (1 - margin))
    sure = F.col("sites") >= F.col("need") * (1 + margin)
    likely = likely.select(*key, "first", sure.alias("sure"))
    # Texts are split once more for these; what is left of all lines is small.
    places = stored(lines.join(likely, key), "likely-lines")
    pairs = places.where("not sure").groupBy(*key, "need", "site").agg(F.lit(1).alias("one"))
    exact = pairs.groupBy(*key, "need").agg(F.count("site").alias("sites")).where("sites >= need")
    return places.where("sure").unionByName(places.where("not sure").join(exact.select(*key), key, "left_semi"))


def drop_boilerplate(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    short_chars: int = SHORT_CHARS,
    short_min_sites: int = SHORT_MIN_SITES,
    lg_k: int = LG_K,
    margin: float = MARGIN,
    n_lines: str = "n_lines",
    n_removed: str = "n_removed",
    edges: str = " ",
) -> DataFrame:
    """The documents without boilerplate lines, all rows and columns kept.

    Lines end at line feeds and are compared without the characters of ``edges`` around them
    (spaces; with a carriage return among them, lines of CR LF files equal those of LF files).
    A line is boilerplate on ``min_sites`` sites, or on ``short_min_sites`` if it is then under
    ``short_chars`` characters; blank lines never are. The row of the smallest id with a line
    keeps it (NULL ids count as largest, rows of one id alike). Adds ``n_lines`` (lines that are not
    blank) and ``n_removed`` under the names given, in place of columns of these names. NULL
    text stays NULL; a text of boilerplate alone becomes empty; rows with a NULL site spread
    nothing but lose lines as others do; repeated rows fare alike; no row gives no row.
    """
    docs = docs.drop(n_lines, n_removed)
    key, bad = fresh(docs, "__key"), fresh(docs, "__bad")
    lines = docs.select(
        row_key(id_col, text_col).alias("key"),
        id_or_last(F.col(id_col)).alias("id"),
        F.col(site_col).cast("string").alias("site"),
        F.posexplode(lines_of(F.col(text_col))).alias("at", "line"),
    )
    lines = lines.withColumn("line", F.trim("line", F.lit(edges))).where("line <> ''")
    need = F.when(F.length("line") < short_chars, short_min_sites).otherwise(min_sites)
    # The second hash has a seed of its own, so both must agree by chance for two lines to be one.
    two = {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), F.col("line")), "need": need}
    lines = lines.withColumns(two).drop("line")
    gone = boilerplate_places(lines, lg_k, margin).where(F.col("id") != F.col("first"))
    gone = gone.groupBy("key").agg(F.collect_set("at").alias(bad)).withColumnRenamed("key", key)
    all_lines = lines_of(F.col(text_col))
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(bad))
    text = F.array_join(F.transform(kept, lambda i: F.element_at(all_lines, i + 1)), "\n")
    joined = docs.withColumn(key, row_key(id_col, text_col)).join(gone, key, "left")
    counted = joined.withColumns(
        {
            n_lines: F.size(F.filter(all_lines, lambda x: F.trim(x, F.lit(edges)) != "")).cast("long"),
            n_removed: F.coalesce(F.size(bad), F.lit(0)).cast("long"),
        }
    )
    out = counted.withColumn(text_col, F.when(F.col(bad).isNull(), F.col(text_col)).otherwise(text))
    return out.drop(key, bad)


def op4_line_dedup(docs: DataFrame) -> DataFrame:
    """Lines and removed lines of each document, and the digest of what is kept."""
    out = drop_boilerplate(docs)
    kept = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    return out.select("doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


OP4_SQL = f"""
WITH d AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, unnest(ls) AS raw, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, source, raw, pos, trim(raw, ' ') AS line FROM l),
b AS (SELECT line, min(doc_id) AS first FROM k WHERE line <> '' GROUP BY line
      HAVING count(DISTINCT source) >= CASE WHEN length(line) < {SHORT_CHARS} THEN {SHORT_MIN_SITES} ELSE {MIN_SITES} END),
m AS (SELECT k.doc_id, k.raw, k.pos, k.line, b.line IS NOT NULL AND k.doc_id <> b.first AS gone
      FROM k LEFT JOIN b ON k.line = b.line)
SELECT doc_id,
       CAST(count(*) FILTER (WHERE line <> '') AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
