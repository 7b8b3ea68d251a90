"""Repeat groups against every repeated window of the texts."""

import random
from collections import defaultdict

import pytest

from vitalmart.llm import repeats


def windows(texts, length):
    """Occurrences of every string of ``length`` bytes that several ids have."""
    found = defaultdict(set)
    for i, text in texts:
        raw = text.encode()
        for at in range(len(raw) - length + 1):
            found[raw[at : at + length]].add((i, at))
    return {w: where for w, where in found.items() if len({i for i, _ in where}) > 1}


def passages(rng, n):
    parts = ["".join(rng.choice("ab ") for _ in range(rng.randint(10, 90))) for _ in range(12)]
    own = lambda: "".join(rng.choice("cdé") for _ in range(rng.randint(0, 15)))
    texts = [(k, own().join(rng.choice(parts) for _ in range(rng.randint(0, 5))) + own()) for k in range(n)]
    return [*texts, (n, ""), (n + 1, "x" * 200), (n + 2, "x" * 130), (n + 3, texts[0][1]), (None, texts[1][1] + parts[0])]


@pytest.mark.parametrize(("length", "block_bytes", "hot_blocks"), [(20, 1 << 20, 2000), (25, 300, 2000), (30, 200, 1), (50, 400, 3)])
def test_groups_are_all_repeats_with_all_occurrences(spark, length, block_bytes, hot_blocks):
    texts = passages(random.Random(length), 40)
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    rows = repeats.repeat_groups(frame, length=length, block_bytes=block_bytes, bucket_bytes=500, hot_blocks=hot_blocks).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[bytes(r["repeat"])].append((r["doc_id"], r["place"]))
    raw = {i: t.encode() for i, t in texts}
    for repeat, where in groups.items():
        assert len(repeat) >= length and len(where) == len(set(where)) and len({i for i, _ in where}) > 1
        assert all(raw[i][at : at + len(repeat)] == repeat for i, at in where)
    # every repeated window lies in a repeat that has all of its occurrences
    of_window = defaultdict(list)
    for repeat, where in groups.items():
        for at in range(len(repeat) - length + 1):
            of_window[repeat[at : at + length]].append({(i, p + at) for i, p in where})
    want = windows(texts, length)
    assert set(of_window) == set(want) and want
    assert all(where in of_window[w] for w, where in want.items())


def test_odd_rows(spark, odd, none):
    assert repeats.repeat_groups(none).collect() == []
    texts = [(r["doc_id"], r["text"] or "") for r in odd.where("doc_id is null or doc_id not in (5, 6)").collect()]
    rows = repeats.repeat_groups(odd.where("doc_id is null or doc_id not in (5, 6)")).collect()
    held = {(r["doc_id"], r["place"]) for r in rows}
    assert held and held <= set().union(*windows(texts, 50).values())
    assert {r["doc_id"] for r in rows} == {None, 1}


def test_blocks_without_windows_or_words(spark):
    from vitalmart.llm import ngram_join

    frame = spark.createDataFrame([(1, "short"), (2, "short"), (3, ""), (4, None)], "doc_id bigint, text string")
    assert repeats.repeat_groups(frame).collect() == []
    assert {(r["doc_id"], len(r["spans"])) for r in repeats.remove_repeats(frame).collect()} == {(n, 0) for n in (1, 2, 3, 4)}
    blank = frame.where("doc_id > 2")
    assert {tuple(r) for r in ngram_join.op9_ngram_join(blank).collect()} == {(3, 0, 3), (4, 0, 4)}
