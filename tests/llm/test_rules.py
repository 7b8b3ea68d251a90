"""Quality rules: counts against written-out definitions, lists against what they cover."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalmart.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def written_out(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(x in lines[:k] for k, x in enumerate(lines)),
        "n_repeat_words": len(inside),
        "n_lines": len(lines),
        "n_distinct": len(set(words)),
        "n_adjacent": sum(a == b for a, b in zip(words, words[1:])),
        "n_upper": sum(c.isupper() for c in text),
        "n_digits": sum(c in "0123456789" for c in text),
        "n_marks": text.count("!") + text.count("?"),
    }


ODD = ["", None, " \n\t", "a", "a a", "a a a", "a a a a", "x y x y x", "a b c a b c", "b\n\nb\n b\nb", "É é  A\x1cB # !?", "\x0b#\x0c1 Ⅷ ǅ", "a b c " * 9 + "d"]


def test_counts_of_odd_texts():
    rng = random.Random(8)
    texts = ODD + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) + rng.choice(["\n", "#"]) for _ in range(300)]
    for t in texts:
        assert dict(zip(rules.COUNTS, rules.counts_of(t or ""))) == written_out(t), repr(t)


def test_whole_table(spark, sf_dir, documents):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = {r["doc_id"]: r.asDict() for r in queries.op11_rules(spark, sf_dir).collect()}
    assert len(rows) == documents.count()
    for r in documents.collect():
        want, got = written_out(r["text"]), rows[r["doc_id"]]
        assert all(got[c] == want[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert got["base_failed"] == failed and not (failed and got["kept"])
    judged = [(r["kept"], labels[i]) for i, r in rows.items() if i in labels and not r["base_failed"]]
    assert sum(k == bool(y) for k, y in judged) >= 0.95 * len(judged)


def test_held_out_labels_are_not_learned(spark, documents):
    stats = rules.statistics(documents).cache()
    marks = stats.select("doc_id", (F.col("n_words") % 2).cast("int").alias("quality"))
    unseen = marks.where(rules.held_out())
    assert unseen.count() > 20 and rules.learn_from(stats, unseen).rules == ()
    seen = marks.where(~rules.held_out()).withColumn("quality", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0))
    both = seen.unionByName(unseen.withColumn("quality", F.lit(0)))
    assert rules.learn_from(stats, seen) == rules.learn_from(stats.repartition(7), both)


def noisy(n, seed):
    rng = np.random.default_rng(seed)
    table = {"x": rng.random(n), "y": rng.random(n), "z": rng.integers(0, 3, n).astype(float)}
    bad = ((table["x"] > 0.7) & (table["y"] < 0.4)) | ((table["z"] == 2) & (table["x"] < 0.2))
    return table, np.where(bad, 0, 1)


def test_a_list_finds_conjunctions_and_says_what_it_covers():
    table, labels = noisy(4000, 1)
    found = rules.learn(table, labels)
    assert found.default == 1 and 2 <= len(found.rules) <= 8
    fresh, truth = noisy(4000, 2)
    verdict = np.ones(4000, int)
    for r in found.rules[::-1]:
        verdict[rules._covers(r.conditions, fresh, 4000)] = r.verdict
    assert (verdict == truth).mean() > 0.97
    assert all(r.right >= 0.9 * r.covered > 0 for r in found.rules)
    assert {c.feature for r in found.rules for c in r.conditions} == {"x", "y", "z"}
    assert rules.learn(table, labels) == found
    assert "then 0" in str(found) and str(found).endswith("else 1")


def test_noise_is_pruned():
    rng = np.random.default_rng(3)
    table = {name: rng.random(3000) for name in "abcd"}
    assert len(rules.learn(table, rng.integers(0, 2, 3000)).rules) == 0
    labels = np.where((table["a"] > 0.5) ^ (rng.random(3000) < 0.05), 0, 1)
    found = rules.learn(table, labels)
    assert 1 <= len(found.rules) <= 3 and abs(found.rules[0].conditions[0].threshold - 0.5) < 0.05


@pytest.mark.parametrize("labels", [[], [1, 1, 1], [0, 0], [0, 1]])
def test_few_labels_and_ties(labels):
    found = rules.learn({"x": np.zeros(len(labels))}, np.array(labels, int))
    assert found.rules == () and found.default == 1


def test_spark_expression_is_the_list(spark):
    table, labels = noisy(4000, 1)
    found = rules.learn(table, labels)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in zip(*table.values())], "x double, y double, z double")
    said = frame.select(found.verdict({n: F.col(n) for n in table}).alias("v"))
    verdict = np.ones(4000, int)
    for r in found.rules[::-1]:
        verdict[rules._covers(r.conditions, table, 4000)] = 0
    assert [r["v"] for r in said.collect()] == verdict.tolist()
    plan = said._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in plan and "Python" not in plan
    none = frame.selectExpr("cast(null as double) as x", "y", "z").limit(1)
    assert none.select(found.verdict({n: F.col(n) for n in table}).alias("v")).first()["v"] == 1


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (8, None), (None, 0)], "doc_id bigint, quality int")
    rows = rules.op11_rules(odd, labels).collect()
    assert sorted((repr(r["doc_id"]), r["n_words"]) for r in rows) == sorted((repr(r["doc_id"]), written_out(r["text"])["n_words"]) for r in odd.collect())
    long = [r for r in rows if r["doc_id"] in (5, 6)]
    assert all(r["n_words"] == 160_000 == r["n_repeat_words"] and r["base_failed"] and not r["kept"] for r in long)
    assert rules.op11_rules(none, labels).collect() == [] and rules.op11_rules(odd, labels.limit(0)).count() == odd.count()
    kept = rules.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes and kept.collect() == []
    assert rules.keep_good(none, labels).collect() == []


def test_keep_good_agrees_with_the_query(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r["doc_id"] for r in rules.keep_good(documents.withColumn("good", F.lit(None).cast("string")), labels).collect()}
    assert kept == {r["doc_id"] for r in rules.op11_rules(documents, labels).where("kept").collect()} and kept
