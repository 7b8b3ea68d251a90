"""Filter audit against each order applied filter by filter."""

import itertools
import random
import re
from collections import Counter

import pytest

from vitalmart.llm import filter_audit, queries


def applied(rows, filters, width):
    """Steps of every order: rows are (mask, counts)."""
    out, shapley = {}, Counter()
    for order in itertools.permutations(filters):
        left = list(rows)
        for step, name in enumerate(order, 1):
            bit = 1 << filters.index(name)
            gone = [r for r in left if r[0] & bit]
            left = [r for r in left if not r[0] & bit]
            total = lambda some, k=0: sum(r[1][k] for r in some)
            failing, alone = total([r for r in rows if r[0] & bit]), total([r for r in rows if r[0] == bit])
            out["".join(order), step] = (name, total(left), total(gone), failing - total(gone), alone, *[total(gone, k) for k in range(1, width)])
            shapley[name] += total(gone)
    return {k: (*v[:5], shapley[v[0]], *v[5:]) for k, v in out.items()}


@pytest.mark.parametrize("filters", ["A", "AB", "XYZ", "ABCD", "ABCDE"])
def test_diagrams_give_every_order_applied(filters):
    rng = random.Random(len(filters))
    for share in (0.2, 0.7, 1.0):
        masks = {m: (rng.choice([1, 1, 2, 40]), rng.randint(0, 3)) for m in range(1 << len(filters)) if rng.random() < share}
        found = filter_audit.steps_of(masks, filters, 2)
        want = applied(list(masks.items()), filters, 2)
        assert {(o, s): tuple(rest) for o, s, *rest in found} == want and len(found) == len(want)


def test_a_swap_changes_two_levels_and_no_counts():
    rng = random.Random(4)
    masks = {m: (rng.randint(0, 2),) for m in range(32)}
    bits = {f: 1 << k for k, f in enumerate("ABCDE")}
    diagram = filter_audit.Diagram("ABCDE", masks, bits, 1)
    for place in filter_audit.adjacent_swaps(5):
        diagram.swap(place)
        fresh = filter_audit.Diagram(diagram.order, masks, bits, 1)
        assert list(diagram.all_pass()) == list(fresh.all_pass())
        assert diagram.counts[diagram.root] == (sum(n for n, in masks.values()),)
    # equal subtrees are shared: all counts alike need one node a level
    same = filter_audit.Diagram("ABCDE", dict.fromkeys(range(32), (1,)), bits, 1)
    assert len(same.counts) == 6


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_swaps_lead_through_all_orders(n):
    order = list(range(n))
    seen = {tuple(order)}
    for place in filter_audit.adjacent_swaps(n):
        order[place], order[place + 1] = order[place + 1], order[place]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert seen == set(itertools.permutations(range(n)))


def mask(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)]
    fails += [bool(re.search(r"[#$%&*|]", text)), copy]
    return sum(1 << k for k, f in enumerate(fails) if f)


def test_masks_of_odd_rows(spark, odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text", "source").collect()]
    firsts = {}
    for i, t, _ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    want = Counter((i, s or "", mask(t or "", i is not None and firsts[t or ""] < i)) for i, t, s in rows)
    found = filter_audit.failure_masks(odd.repartition(7))
    assert found.columns == ["doc_id", "part", "mask"]
    assert Counter(map(tuple, found.collect())) == want
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 1), (None, 1, 1), (5, 0, None)], "doc_id bigint, quality int, toxic int")
    out = filter_audit.op12_filter_audit(odd, labels).collect()
    assert len(out) == 600 * 5
    first = {r["part"]: r for r in out if r["filter_order"] == "ABCDE" and r["step"] == 1}
    assert first["a"]["removed"] == 3 and first["a"]["good_lost"] == 2 and first["a"]["toxic_lost"] == 2 and first["a"]["kept"] == 1
    assert filter_audit.op12_filter_audit(none, labels).collect() == []
    assert filter_audit.op12_filter_audit(odd, labels.limit(0)).count() == 600 * 5


def test_other_filters_and_counts(spark):
    rows = [("p", 0, 5, 1), ("p", 3, 2, 2), ("p", 3, 1, 0), (None, 2, 4, 4)]
    frame = spark.createDataFrame(rows, "part string, mask int, docs bigint, bytes bigint")
    found = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit(frame, "xy", ["docs", "bytes"]).collect()}
    assert len(found) == 8
    r = found["p", "yx", 1]
    assert (r["filter"], r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"], r["lost_bytes"]) == ("y", 5, 3, 0, 0, 3, 2)
    assert found[None, "xy", 2]["removed"] == 4 and found[None, "xy", 2]["unique_fails"] == 4
    with pytest.raises(ValueError):
        filter_audit.audit(frame, "xx", ["docs"])


def test_registered():
    assert queries.ORACLE["op12_filter_audit"] == filter_audit.OP12_SQL
