"""Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitalmart.llm import bpe, decontaminate, fingerprint, lines, ngram_join, quality, queries, repeats, secrets, token_files, urls

ITEMS = [(1, "quick brown fox jumps over the lazy dog and runs far away from here"), (None, None)]


def count(df):
    return sorted(((r["doc_id"] is None, r["doc_id"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def runs(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    net = quality.fit([b"good text", b"BAD!!"] * 10, [1, 0] * 10, epochs=2)
    return {
        "token_files": lambda d: token_files.op1_token_files(d, queries.TOKENIZER),
        "bpe": lambda d: bpe.op2_bpe(d, queries.TOKENIZER),
        "repeats": repeats.op3_repeats,
        "lines": lines.op4_line_dedup,
        "secrets": secrets.op5_secrets,
        "decontaminate": lambda d: decontaminate.op7_decontaminate(d, items),
        "quality": lambda d: quality.score(d, net),
        "ngram_join": ngram_join.op9_ngram_join,
        "fingerprint": fingerprint.op10_fingerprint,
    }


NAMES = ["token_files", "bpe", "repeats", "lines", "secrets", "decontaminate", "quality", "ngram_join", "fingerprint"]


@pytest.mark.parametrize("name", NAMES)
def test_rows_stay(odd, none, runs, name):
    assert count(runs[name](odd)) == count(odd)
    assert runs[name](none).collect() == []


def test_repeats_of_null_and_equal_ids(odd):
    found = {(r["doc_id"], r["n_bytes"]): r for r in repeats.remove_repeats(odd).collect()}
    assert found[1, 78]["spans"] == []  # rows of one id do not remove from each other
    assert [tuple(s) for s in found[None, 78]["spans"]] == [(0, 78)]  # a NULL id comes after all
    assert found[5, 1_000_000]["spans"] == [] and [tuple(s) for s in found[6, 1_000_000]["spans"]] == [(0, 1_000_000)]


def test_ngram_join_of_odd_rows(odd):
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.op9_ngram_join(odd).collect()]
    assert found.count((1, 14, 1)) == 2 and (None, 14, None) in found and (None, 0, None) in found
    assert (2, 0, 2) in found and (3, 0, 3) in found and (4, 0, 4) in found and (6, 4, 5) in found and (7, 1, 7) in found


def test_quality_without_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.op8_quality(odd, labels).collect()} == {0.5}


def test_decontaminate_of_odd_rows(odd, spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = decontaminate.find_items(odd, items).collect()
    assert sum(r["items"] == ["1"] for r in rows) == 3
    assert decontaminate.find_items(odd, items.limit(0)).where(F.size("spans") > 0).count() == 0
    clean = decontaminate.keep_clean(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 3


def test_fingerprint_of_one_row_and_empty_texts(odd):
    one = fingerprint.op10_fingerprint(odd.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert {r["fingerprint"] for r in fingerprint.fingerprint(odd.where("doc_id = 3")).collect()} == {""}


def test_urls_of_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "no scheme", "x"), (3, "http://", None), (None, "HTTP://A.B.example.ORG/es/é?q#f", "<b>Words</b>"), (4, "x://" + "a" * 3000 + ".com/fr/", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("clash")).withColumn("tokens", F.lit(1))
    found = [(r["page_id"], r["host"][:20], r["path"], r["rule"], r["verdict"]) for r in urls.op6_url_filter(pages).collect()]
    assert len(found) == 6 and found.count((1, "", "", None, "allow")) == 2
    assert (None, "a.b.example.org", "/es/é", "example.org/es/", "block") in found
    assert (4, "a" * 20, "/fr/", "com/fr/", "allow") in found
    assert urls.op6_url_filter(pages.limit(0)).collect() == []


def test_stages_keep_the_columns(spark, odd, none, tmp_path):
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1), (8, 0), (None, 1)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns and out.dtypes == odd.dtypes, name
        out.collect()
        assert stage(spark, none, str(tmp_path)).collect() == []
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, odd, str(tmp_path)).count() == odd.count() and last(spark, none, str(tmp_path)).count() == 0


def test_line_dedup_stage_takes_line_ends_alike(spark, tmp_path):
    line = "A line that stands on six sites."
    rows = [(n, f"{line}{end}\nOwn line of {n}.{end}", f"s{n}", 0) for n, end in enumerate(["\r", "", " \r", "\r", "", ""])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, docs, str(tmp_path)).collect()}
    assert kept == {n: text if n == 0 else text.split("\n")[1] for n, text, _, _ in rows}


def test_different_texts_of_one_id_are_documents_of_their_own(spark, tmp_path):
    def text(topic, n=60):
        return " ".join(f"{topic}{k}" for k in range(n))

    rows = [(3, text("a"), "en"), (5, text("a") + " end", "en"), (5, text("b"), "en"), (5, text("c"), "fr"), (5, text("c"), "de")]
    rows += [(7, text("b") + " end", "en"), (7, "", "en"), (None, text("a"), "en"), (None, text("a"), "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    kept = corpus_pipeline.one_of_each(spark, docs, str(tmp_path)).collect()
    expected = [(3, text("a"), "en"), (5, text("b"), "en"), (5, text("c"), "de"), (7, "", "en"), *[(None, text("a"), "en")] * 2]
    assert sorted(map(tuple, kept), key=repr) == sorted(expected, key=repr)


def test_pipeline_does_what_its_stages_decide(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = quality.op8_quality(docs, labels).where("predicted = 1").select("doc_id")
    first = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert count(first) == count(good)
    groups = {r["component_id"] for r in ngram_join.join(first).collect()}
    third = corpus_pipeline.STAGES[2][1](spark, first, sf_dir)
    assert {r["doc_id"] for r in third.collect()} == groups
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_encode_then_decode_with_carried_columns(odd):
    coded = bpe.encode(odd, queries.TOKENIZER, carry=("lang", "score", "ids"))
    assert coded.columns == ["doc_id", "lang", "score", "ids"]
    back = bpe.decode(coded, queries.TOKENIZER)
    got = sorted(((r["doc_id"], r["decoded"]) for r in back.collect()), key=repr)
    assert got == sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=repr)


def test_workers_let_go_of_other_operators_tables():
    bpe.Codec.of(queries.TOKENIZER).encode(["some text"])
    assert bpe.Codec._open
    token_files.LibraryEncoder.of(queries.TOKENIZER).encode(["some text"])
    assert not bpe.Codec._open and token_files.LibraryEncoder._open
