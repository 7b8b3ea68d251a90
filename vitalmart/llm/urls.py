"""URL filter: host words by unigram Viterbi, then multinomial naive Bayes.

The words of all pages give unigram counts, stored once. Each distinct host label meets only
the words it contains, by a join on its substrings (of long words, on their beginnings), so no
word list is sent around. Pages that a rule
judges are the training set. Hosts and path shapes are counted before anything is joined, so
one host with a third of all pages costs one row; scores are found once for each distinct
host and path shape and joined back to the pages.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import stored

#: Rules as host and path, with their verdicts.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
STEM = 20  # of words longer than this, the beginning is looked up first
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for NULL and where there is no ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest fitting rule or NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def word_counts(pages: DataFrame) -> DataFrame:
    """``word``, ``n`` over the visible text of all pages, lower-cased."""
    text = F.lower(F.regexp_replace("html", r"<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The split of the label that is likeliest under the unigram counts.

    An unknown piece of k letters counts as 10 / (total * 10**k) words, so that longer ones
    cost more. Of equal splits the one whose last word is longest wins. ``counts`` may hold
    the label's own words alone. Words and unknown pieces may be of any length.
    """
    letter, unknown = math.log(10), math.log(10 / max(total, 1))
    sizes = sorted({len(w) for w in counts})
    best = [(0.0, 0)]
    # The unknown piece that ends here begins where this is largest, whatever its length.
    start, high = 0, 0.0
    for end in range(1, len(label) + 1):
        options = [(high - end * letter + unknown, end - start)]
        for size in sizes:
            if size > end:
                break
            n = counts.get(label[end - size : end], 0)
            if n:
                options.append((best[end - size][0] + math.log(n / total), size))
        best.append(max(options))
        if best[end][0] + end * letter > high:
            start, high = end, best[end][0] + end * letter
    words, end = [], len(label)
    while end:
        words.append(label[end - best[end][1] : end])
        end -= best[end][1]
    return words[::-1]


def words_in(labels: DataFrame, counts: DataFrame, stem: int = STEM) -> DataFrame:
    """``label``, ``word`` and ``n`` of every counted word that a label contains, of any length.

    ``labels`` are distinct. Words of ``stem`` letters at most are joined to the substrings of
    that length or less; longer ones to the substrings of ``stem`` letters they begin with, and
    then compared whole.
    """
    size = F.length("label")
    pieces = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(stem), size - i + 1)),
                lambda k: F.substring(F.col("label"), i, k),
            ),
        )
    )
    short = labels.select("label", F.explode(F.array_distinct(pieces)).alias("word")).join(counts, "word")
    places = labels.where(size > stem).select("label", F.explode(F.sequence(F.lit(1), size - stem)).alias("at"))
    begun = places.select("label", "at", F.substring(F.col("label"), F.col("at"), F.lit(stem)).alias("stem"))
    long = counts.where(F.length("word") > stem).withColumn("stem", F.left("word", F.lit(stem)))
    whole = F.substring(F.col("label"), F.col("at"), F.length("word")) == F.col("word")
    found = begun.join(long, "stem").where(whole).select("label", "word", "n").distinct()
    return short.select("label", "word", "n").unionByName(found)


def host_words(hosts: DataFrame, counts: DataFrame, total: int, stem: int = STEM) -> DataFrame:
    """``host`` (distinct) and ``words``: the segments of its labels, those of equal labels repeated."""
    labels = hosts.select("host", F.posexplode(F.split("host", r"[.]")).alias("at", "label")).where("label <> ''")
    distinct = labels.select("label").distinct()
    known = words_in(distinct, counts, stem)
    known = known.groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series(
            [segment(x, {} if k is None else {w["word"]: w["n"] for w in k}, total) for x, k in zip(label, known, strict=True)]
        )

    split_labels = distinct.join(known, "label", "left").select("label", split("label", "known").alias("words"))
    joined = labels.join(split_labels, "label").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("w"))
    return joined.select("host", F.flatten(F.col("w.words")).alias("words"))


def filter_urls(pages: DataFrame, *, rules: dict[str, str] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A verdict for every page.

    Returns one row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (the
    longest fitting one or NULL), ``score`` (log odds of block) and ``verdict``: that of the
    rule, else ``block`` where the score is positive. Tokens are the segmented words of the
    host and the letters or digits runs of the path, digits all alike. A URL that is NULL or
    has no ``://`` has no tokens and gets the prior odds. Without pages of either verdict the
    score is that of the counts plus one. Ties (score 0) are allowed; repeated rows repeat;
    NULL html adds no words; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    shape = F.regexp_replace(F.regexp_replace(F.lower(F.col("path")), r"[0-9]+", " 0 "), r"[^\p{L}0-9]+", " ")
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    parsed = parsed.withColumns({"rule": rule_of(F.col("host"), F.col("path"), rules), "shape": F.trim(shape)})
    verdict = F.lit(None).cast("string")
    for rule, said in rules.items():
        verdict = F.when(F.col("rule") == rule, said).otherwise(verdict)
    counted = parsed.groupBy("host", "shape").agg(
        F.count_if(verdict == "allow").alias("allow"), F.count_if(verdict == "block").alias("block")
    )
    counts = stored(word_counts(pages), "url-words")  # the html is read once
    total = counts.agg(F.sum("n")).first()[0] or 0
    words = host_words(counted.select("host").distinct(), counts, total)
    tokens = counted.join(words, "host", "left").select(
        "host",
        "shape",
        "allow",
        "block",
        F.concat(
            F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("host "), w)),
            F.transform(F.filter(F.split("shape", " "), lambda w: w != ""), lambda w: F.concat(F.lit("path "), w)),
        ).alias("tokens"),
    )
    each = tokens.select("host", "shape", "allow", "block", F.explode("tokens").alias("token"))
    model = each.groupBy("token").agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).where("a + b > 0")
    seen = model.agg(F.sum("a"), F.sum("b"), F.count("*")).first()
    pages_seen = counted.agg(F.sum("allow"), F.sum("block")).first()
    n_a, n_b, size = (x or 0 for x in seen)
    prior = math.log(((pages_seen[1] or 0) + 1) / ((pages_seen[0] or 0) + 1))
    drift = math.log((n_a + size + 1) / (n_b + size + 1))
    odds = F.log((F.coalesce("b", F.lit(0)) + 1) / (F.coalesce("a", F.lit(0)) + 1)) + F.lit(drift)
    scored = each.join(model, "token", "left").groupBy("host", "shape").agg(F.sum(odds).alias("odds"))
    out = parsed.join(scored, ["host", "shape"], "left")
    score = F.round(F.coalesce("odds", F.lit(0.0)) + F.lit(prior), 9)
    return out.select(
        "page_id", "host", "path", "rule", score.alias("score"),
        F.coalesce(verdict, F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
    )


def op6_url_filter(pages: DataFrame) -> DataFrame:
    """The contract's columns."""
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")
