"""Sketches merged over ranges of sites, exact counts near the threshold, short lines."""

from pyspark.sql import functions as F

from vitalmart.llm import lines


def stood(spark, sites_of):
    """A document for each (line, site); ids ascend by line and site."""
    rows = [(1000 * n + s, line, f"s{s}") for n, (line, sites) in enumerate(sites_of.items()) for s in range(sites)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def removed(df):
    return {r["doc_id"]: r["n_removed"] for r in df.collect()}


def test_short_lines_need_more_sites(spark):
    sites_of = {"Read more": 19, "Log in": 20, "Nineteen characters": 19, "Twenty characters ok": 5, "A line of four sites only": 4, "]": 40, "": 60}
    found = removed(lines.drop_boilerplate(stood(spark, sites_of)))
    want = {}
    for n, (line, sites) in enumerate(sites_of.items()):
        gone = line and sites >= (20 if len(line) < 20 else 5)
        want |= {1000 * n + s: int(bool(gone) and s > 0) for s in range(sites)}
    assert found == want
    again = removed(lines.drop_boilerplate(stood(spark, sites_of), short_chars=0, min_sites=3))
    assert all(n == (i % 1000 > 0 and i < 6000) for i, n in again.items())


def test_wide_spread_is_estimated_and_near_spread_counted(spark):
    # 900 sites for a threshold of 500 are sure, 480 to 520 are counted
    sites_of = {f"A long enough line of {n} sites": n for n in (300, 480, 499, 500, 520, 900)}
    docs = stood(spark, sites_of).repartition(9)
    found = removed(lines.drop_boilerplate(docs, min_sites=500))
    sizes = list(sites_of.values())
    assert all(n == (sizes[i // 1000] >= 500 and i % 1000 > 0) for i, n in found.items())
    rows = docs.selectExpr("xxhash64(text) as h1", "xxhash64(1, text) as h2", "500 as need", "source as site", "doc_id as id")
    estimates = {r["first"] // 1000: r["sites"] for r in lines.spread(rows).collect()}
    assert all(abs(estimates[k] - n) <= 0.1 * n for k, n in enumerate(sizes))


def test_pairs_are_made_near_the_threshold_only(spark):
    rows = spark.range(10).selectExpr("id as h1", "id as h2", "5 as need", "cast(id as string) as site", "id")
    plan = lines.spread(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "hll_union_agg" in plan and "count(" not in plan


def test_no_hash_follows_from_the_other(spark):
    # were the second hash made from the first, it would be the same function of it for all lines
    row = spark.range(1).select(F.xxhash64(F.lit("a")), F.xxhash64(F.lit(1), F.lit("a")), F.xxhash64(F.lit("a"), F.lit(1))).first()
    assert len(set(row)) == 3


def test_repeats_within_a_site_do_not_count(spark):
    rows = [(n, "The same line in one site, many times over", "s0") for n in range(50)] + [(99, "The same line in one site, many times over", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert set(removed(lines.drop_boilerplate(docs, min_sites=2)).values()) == {0}
    assert sorted(removed(lines.drop_boilerplate(docs, min_sites=1)).items())[1:] == [(n, 1) for n in [*range(1, 50), 99]]
