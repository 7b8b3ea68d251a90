"""Phrases, names and likeness against the parse written out symbol by symbol."""

import random

import numpy as np
import pytest

from vitalmart.llm import fingerprint

MASK = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15


def mix(x):
    for _ in range(2):
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & MASK
    return x ^ (x >> 32)


def level_up(symbols, level):
    """Names and lengths, in symbols of the level below, of one text's phrases."""
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    names = [s if n == 1 else mix((s + n * ODD) & MASK) for s, n in runs]
    labels, bits = names, 64
    for _ in range(4):
        new = []
        for k, here in enumerate(labels):
            before = labels[k - 1] if k else ~here & ((1 << bits) - 1)
            differ = (before ^ here) or 1
            low = (differ & -differ).bit_length() - 1
            new.append(low << 1 | here >> low & 1)
        labels, bits = new, 8
    cuts = [0] + [k for k in range(1, len(labels) - 1) if labels[k - 1] < labels[k] > labels[k + 1]]
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(names)]):
        total = sum(mix((s + level) & MASK) * pow(ODD, (k & 63) + 1, 1 << 64) for k, s in enumerate(names[a:b]))
        out.append(mix((total + b - a) & MASK))
    return out


def names_of(text):
    symbols, found = [b + 1 for b in text], []
    for level in range(1, max(fingerprint.LEVELS) + 1):
        symbols = level_up(symbols, level)
        if level in fingerprint.LEVELS:
            found.append(sorted({s >> 32 for s in symbols}))
    return found


def texts(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    made = [" ".join(word() for _ in range(n)) for n in (1, 2, 5, 40, 300)]
    return [*made, "", "a", "aa", "a" * 500, "ab" * 200, "é日😀" * 30, made[-1][7:], "x" + made[-1]]


def test_names_are_those_of_the_parse_written_out():
    rng = random.Random(1)
    docs = [t.encode() for t in texts(rng)]
    rng.shuffle(docs)
    for doc, found in zip(docs, fingerprint.phrases(docs), strict=True):
        want = names_of(doc) if doc else [[], []]
        assert [p.tolist() for p in found] == want, doc[:40]


def shares(a, b):
    """Mean over levels of common names to all names of two texts."""
    return float(np.mean([len(set(x) & set(y)) / len(set(x) | set(y)) for x, y in zip(names_of(a), names_of(b))]))


def test_likeness_is_the_share_of_common_names():
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefghijklmno ") for _ in range(40)).encode()
    for other in (base, base[:20] + b"zz" + base[20:], base[::-1], base + b"tail"):
        a, b = (fingerprint.fingerprints([x.decode()])[0] for x in (base, other))
        assert all(len(n) < fingerprint.KEPT for n in names_of(base) + names_of(other))  # nothing is left out
        assert fingerprint.likeness(a, b) == pytest.approx(1.0 if base == other else shares(base, other))


def test_likeness_of_long_texts_is_near_the_share_of_all_names():
    rng = random.Random(3)
    errors, pairs = [], []
    for k in range(40):
        base = "".join(rng.choice("abcdefghijklmno ") for _ in range(6000))
        cut = int(6000 * k / 40)
        other = base[:cut] + "".join(rng.choice("abcdefghijklmno ") for _ in range(6000 - cut))
        a, b = fingerprint.fingerprints([base, other])
        true = shares(base.encode(), other.encode())
        pairs.append((true, fingerprint.likeness(a, b)))
        errors.append(pairs[-1][1] - true)
    assert max(t for t, _ in pairs) > 0.9 > 0.05 > min(t for t, _ in pairs)
    assert np.sqrt(np.mean(np.square(errors))) < 0.09 and abs(np.mean(errors)) < 0.04


def test_buckets_are_bounded_and_each_is_one_task(spark, documents, monkeypatch):
    monkeypatch.setattr(fingerprint, "MOST_BUCKETS", 3)
    frame = fingerprint.in_order(documents.select("doc_id", "text"), bucket_text_bytes=2000)
    rows = frame.selectExpr("bucket", "copy", "doc_id", "spark_partition_id() as part").collect()
    assert {r["bucket"] for r in rows} == {0, 1, 2} and all(r["part"] == r["bucket"] for r in rows)
    order = [r["doc_id"] for r in sorted((r for r in rows if not r["copy"]), key=lambda r: (r["bucket"], -r["doc_id"]))]
    assert order == sorted(order, reverse=True) and len(order) == documents.count()
