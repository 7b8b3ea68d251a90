"""Spelling variants against deletion neighbourhoods and written-out definitions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalmart.llm import queries, spellings

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, min_chars=6, min_count=5):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def grouped(words):
    """By dictionaries of words with one code point taken out."""
    met = defaultdict(set)
    for w in words:
        met[w].add(w)
        for k in range(len(w)):
            met[w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for group in met.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 5 * n:
                form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(rows)


def test_whole_table(spark, sf_dir, documents):
    want = grouped(counted([(r["doc_id"], r["text"]) for r in documents.collect()]))
    found = queries.op13_spellings(spark, sf_dir)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = sorted(map(tuple, found.collect()))
    assert rows == want and any(r[1] for r in rows)


@pytest.mark.parametrize(("open_places", "tile"), [(1, 4), (2, 3), (3, 512), (9, 5)])
def test_near_words_of_few_letters(spark, open_places, tile):
    rng = random.Random(open_places)
    words = {"".join(rng.choice("abß😀") for _ in range(rng.randint(1, 7))): rng.choice([1, 2, 5, 11, 60, 300]) for _ in range(900)}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = spellings.spelling_groups(frame, open_places=open_places)
    assert sorted(map(tuple, found.collect())) == grouped(words)
    one = spellings.near_words(frame, open_places, tile)
    two = spellings.near_words(frame)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_runs_of_blocks_and_tiles_find_the_same_pairs():
    rng = random.Random(2)
    blocks = [["".join(rng.choice("ab") for _ in range(9)) for _ in range(n)] for n in (2, 30, 7, 7, 2)]
    blocks = [list(dict.fromkeys(b)) for b in blocks]
    flat = [w for b in blocks for w in b]
    sizes, n = np.array([len(b) for b in blocks]), len(blocks)
    starts = np.cumsum([0, *sizes])
    want = {(i, j) for s, e in zip(starts, starts[1:]) for i in range(s, e) for j in range(i + 1, e) if one_edit(flat[i], flat[j])}
    for tile in (1, 3, 100):
        one, two = spellings.near_rows(flat, sizes, np.full(n, 9), np.zeros(n, int), 9, tile)
        assert set(zip(one.tolist(), two.tolist())) == want and len(one) == len(want)


def test_blocks_are_bounded_by_the_alphabet(spark):
    words = [f"{a}{b}{c}{d}" for a in "abcd" for b in "abcd" for c in "abcd" for d in "abcd"]
    frame = spark.createDataFrame([(w, 5) for w in [*words, *[w + "a" for w in words], *[w[1:] for w in words[:64]]]], "word string, n bigint")
    largest = spellings.blocks_of(frame, 2).agg(F.max(F.size("entries"))).first()[0]
    assert largest <= 4**2 + 4
    plan = spellings.near_words(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_odd_rows(spark, odd, none):
    found = spellings.words_of(odd)
    want = Counter()
    for r in odd.collect():
        for w, n in counted([(r["doc_id"], r["text"])], min_count=1).items():
            want[w] += n
    got = {r["word"]: r["count"] for r in found.where(F.length("word") >= 6).groupBy("word").count().collect()}
    assert got == dict(want) and got["abcdefghijkl"] == 1
    assert spellings.op13_spellings(none).collect() == []
    alone = spark.createDataFrame([(None, 9, "x"), ("", 9, "x"), ("word", 9, "x")], "word string, n bigint, root string")
    assert [tuple(r) for r in spellings.spelling_groups(alone).collect()] == [("word", None, "word", 9, 0, None)]


def test_chains_end_at_their_last_form(spark):
    chain = ["stone", "stones", "stoness", "stonesss", "stonessss", "stonesssss"]
    rows = [(w, 5 * 6**k) for k, w in enumerate(chain)]
    found = {r["word"]: (r["form"], r["root"]) for r in spellings.spelling_groups(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert found == {w: (chain[k + 1] if k < 5 else None, chain[-1]) for k, w in enumerate(chain)}
