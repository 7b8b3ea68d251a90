"""Word segmentation and naive Bayes verdicts of the URL filter, computed a second time."""

import math
import random
from collections import Counter

import pytest
import regex

from vitalmart.llm import queries, urls

RULES = urls.RULES


def best_split(label, counts, total):
    """Score of the best split by plain dynamic programming over all pieces."""
    best = [0.0]
    for end in range(1, len(label) + 1):
        scores = []
        for start in range(end):
            piece = label[start:end]
            own = math.log(counts[piece] / total) if piece in counts else math.log(10 / total) - len(piece) * math.log(10)
            scores.append(best[start] + own)
        best.append(max(scores))
    return best[-1]


def score_of(words, counts, total):
    return sum(math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10) for w in words)


def test_segments_of_any_length():
    rng = random.Random(3)
    long = "extraordinarilylongword" * 2
    counts = {"a": 5, "ab": 3, "abc": 9, "news": 40, long: 2, "b" * 30: 1}
    for _ in range(200):
        label = "".join(rng.choice(["abc", "ab", "news", "q", "zz", long, "b" * 30, "b" * 31]) for _ in range(rng.randint(1, 6)))
        words = urls.segment(label, counts, 60)
        assert "".join(words) == label and score_of(words, counts, 60) == pytest.approx(best_split(label, counts, 60))
    assert urls.segment("x" * 50, {}, 60) == ["x" * 50]  # one unknown word costs less than two


@pytest.mark.parametrize("stem", [1, 3, 20])
def test_labels_meet_all_words_they_contain(spark, stem):
    rng = random.Random(stem)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))): n + 1 for n in range(60)} | {"a" * 25: 3, "ab" * 14: 2}
    labels = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(60)} | {"c" + "a" * 27, "ab" * 15, "é"}
    found = urls.words_in(spark.createDataFrame([(x,) for x in labels], "label string"), spark.createDataFrame(list(words.items()), "word string, n bigint"), stem)
    rows = [(r["label"], r["word"], r["n"]) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(x, w, n) for x in labels for w, n in words.items() if w in x}


def verdicts(pages):
    """host, path and html of all pages to a verdict for each, from counts made here."""
    words = Counter(w for _, _, _, html in pages for w in regex.split(r"[^\p{L}]+", regex.sub(r"<[^>]*>", " ", html or "").lower()) if w)
    total = sum(words.values())

    def tokens(host, path):
        mine = {w: words[w] for w in {host[i:j] for i in range(len(host)) for j in range(i + 1, len(host) + 1)} if w in words}
        shape = regex.sub(r"[^\p{L}0-9]+", " ", regex.sub("[0-9]+", " 0 ", path.lower())).split()
        return ["host " + w for label in host.split(".") if label for w in urls.segment(label, mine, total)] + ["path " + w for w in shape]

    allow, block, seen = Counter(), Counter(), Counter()
    for host, path, rule, _ in pages:
        if rule:
            seen[RULES[rule]] += 1
            (allow if RULES[rule] == "allow" else block).update(tokens(host, path))
    size = len(allow.keys() | block.keys())
    prior = math.log((seen["block"] + 1) / (seen["allow"] + 1))
    drift = math.log((sum(allow.values()) + size + 1) / (sum(block.values()) + size + 1))
    out = []
    for host, path, rule, _ in pages:
        odds = prior + sum(math.log((block[t] + 1) / (allow[t] + 1)) + drift for t in tokens(host, path))
        out.append((RULES[rule] if rule else None, odds))
    return out


def test_scores_of_the_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = urls.filter_urls(pages).collect()
    want = verdicts([(r["host"], r["path"], r["rule"], html[r["page_id"]]) for r in rows])
    free = 0
    for r, (said, odds) in zip(rows, want, strict=True):
        assert r["score"] == pytest.approx(odds, abs=1e-6)
        if said is None and abs(odds) > 1e-6:
            free += 1
            said = "block" if odds > 0 else "allow"
        assert said is None or r["verdict"] == said
    assert {r["verdict"] for r in queries.op6_url_filter(spark, sf_dir).collect()} <= {"allow", "block"}


def test_scores_without_rules_among_many_hosts(spark):
    rng = random.Random(9)
    topics = {"org": "good news garden history".split(), "de": "cheap pills casino lottery".split()}
    rows, n = [], 0
    for kind, names in topics.items():
        for _ in range(60):
            name, tail = "".join(rng.sample(names, 2)), rng.choice(["fr", "de"]) if kind == "de" else "x"
            host = f"{name}.example.org" if kind == "org" else f"{name}.shop.com"
            path = "/a/" if kind == "org" else f"/{'de' if tail == 'de' else 'zz'}/{n}"
            rows.append((n, f"http://{host}{path}", "<p>" + " ".join(rng.choice(names) for _ in range(30)) + "</p>"))
            n += 1
    rows += [(900, "http://cheapcasino.net/q", None), (901, "http://gardenhistory.net/q", ""), (902, None, None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in urls.filter_urls(frame).collect()}
    html = {i: h for i, _, h in rows}
    want = verdicts([(r["host"], r["path"], r["rule"], html[i]) for i, r in found.items()])
    assert all(r["score"] == pytest.approx(odds, abs=1e-6) for r, (_, odds) in zip(found.values(), want, strict=True))
    assert (found[900]["verdict"], found[901]["verdict"]) == ("block", "allow")
