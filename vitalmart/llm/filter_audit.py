"""Audit of text filters that overlap: what each removes in each order of application.

A document's failures are a mask, one bit a filter. Documents are counted by (part, mask)
before anything else, so a part is at most ``2 ** len(filters)`` rows of counts however many
documents it has. From these a decision diagram is built: a level for each filter in the
order of application, a branch for passing and one for failing, equal subtrees shared, and on
every node the counts of all documents below it. Documents kept after a step are the counts
on the path that passes everywhere; documents removed by the step are those on the failing
branch beside it. All orders come from one diagram by swaps of adjacent levels, one swap an
order, and a swap rebuilds two levels alone.

Filter E (a text that a smaller id has too) is decided over the whole table: the smallest id
of every text, found with one row a text and map task, is joined on text digest and id, so a
text that a third of all documents have is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import stored

WORD_ENDS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#$%&*|]"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_UPPER_PCT = 2

Counts = tuple[int, ...]


# --- diagrams ------------------------------------------------------------------------------


class Diagram:
    """A count-weighted decision diagram over the levels of ``order``.

    Nodes are numbers. A node above the leaves has a passing and a failing branch; each has
    the sum of the counts of its leaves. Two nodes of equal branches are one node.
    """

    def __init__(self, order: Sequence[str], masks: Mapping[int, Counts], bits: Mapping[str, int], width: int):
        self.order = list(order)
        self.counts: list[Counts] = []
        self.branches: list[tuple[int, int] | None] = []
        self.known: dict[object, int] = {}
        zero = (0,) * width

        def build(level: int, mask: int) -> int:
            if level == len(self.order):
                return self.leaf(masks.get(mask, zero))
            return self.node(build(level + 1, mask), build(level + 1, mask | bits[self.order[level]]))

        self.root = build(0, 0)

    def leaf(self, counts: Counts) -> int:
        return self._one(("leaf", counts), counts, None)

    def node(self, passing: int, failing: int) -> int:
        key = (passing, failing)
        at = self.known.get(key)
        if at is not None:
            return at
        return self._one(key, tuple(map(sum, zip(self.counts[passing], self.counts[failing]))), key)

    def _one(self, key: object, counts: Counts, branches: tuple[int, int] | None) -> int:
        at = self.known.setdefault(key, len(self.counts))
        if at == len(self.counts):
            self.counts.append(counts)
            self.branches.append(branches)
        return at

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next one. Only nodes of these two levels
        are made anew; what is below is shared, what is above is linked to the new nodes."""
        done: dict[int, int] = {}

        def rebuild(node: int, above: int) -> int:
            if node not in done:
                low, high = self.branches[node]
                if above:
                    done[node] = self.node(rebuild(low, above - 1), rebuild(high, above - 1))
                else:
                    (pp, pf), (fp, ff) = self.branches[low], self.branches[high]
                    done[node] = self.node(self.node(pp, fp), self.node(pf, ff))
            return done[node]

        self.root = rebuild(self.root, level)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[str, Counts, Counts]]:
        """Filter, counts kept and counts removed at each level of the path that always passes."""
        node = self.root
        for name in self.order:
            node, failing = self.branches[node]
            yield name, self.counts[node], self.counts[failing]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places of the swaps that lead through all orders of ``n`` things, each once.

    The last thing walks through each order of the others, back and forth; between two walks
    the others make their next swap, shifted by one when the walker stands in front.
    """
    if n < 2:
        return
    walk, others = range(n - 2, -1, -1), adjacent_swaps(n - 1)
    while True:
        yield from walk
        place = next(others, None)
        if place is None:
            return
        yield place + (walk[-1] == 0)
        walk = walk[::-1]


def steps_of(masks: Mapping[int, Counts], filters: str, width: int) -> list[tuple]:
    """All orders of ``filters`` with their steps: order, step, filter, kept, removed,
    redundant, unique failures and Shapley sum (of the first count), and the other removed counts."""
    diagram = Diagram(filters, masks, {f: 1 << k for k, f in enumerate(filters)}, width)
    found, failing, alone, shapley = [], {}, {}, dict.fromkeys(filters, 0)

    def note() -> None:
        order = "".join(diagram.order)
        for step, (name, kept, removed) in enumerate(diagram.all_pass(), 1):
            found.append((order, step, name, kept[0], removed[0], removed[1:]))
            shapley[name] += removed[0]
            if step == 1:
                failing[name] = removed[0]  # nothing was removed before
            if step == len(filters):
                alone[name] = removed[0]  # all others were passed

    note()
    for place in adjacent_swaps(len(filters)):
        diagram.swap(place)
        note()
    return [
        (order, step, name, kept, removed, failing[name] - removed, alone[name], shapley[name], *lost)
        for order, step, name, kept, removed, lost in found
    ]


# --- the audit -----------------------------------------------------------------------------


def audit(masks: DataFrame, filters: str, counts: Sequence[str], part: str = "part", mask: str = "mask") -> DataFrame:
    """One row per part, order of ``filters`` and step, from rows of a part, a mask and counts.

    Bit k of ``mask`` is set where the k-th filter fails. ``counts`` are names of bigint
    columns, each summed: the first gives ``kept``, ``removed``, ``redundant`` (failing,
    removed earlier), ``unique_fails`` (failing this filter only) and ``shapley`` (removed,
    summed over all orders), every other one a column ``lost_<name>``. A part that is NULL is
    a part of its own; no row gives no row. One filter at least, eight at most: the result
    has a row for each order and step of a part.
    """
    if not 1 <= len(filters) <= 8 or len(set(filters)) != len(filters):
        raise ValueError("one to eight different filters, a letter each")
    width = len(counts)
    summed = masks.groupBy(F.col(part).alias("part"), F.col(mask).alias("mask")).agg(
        *[F.sum(F.col(c)).cast("bigint").alias(f"n{k}") for k, c in enumerate(counts)]
    )
    names = ["filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "shapley"]
    names += [f"lost_{c}" for c in counts[1:]]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        given = {int(m): tuple(map(int, n)) for m, *n in rows[["mask", *[f"n{k}" for k in range(width)]]].itertuples(index=False)}
        out = pd.DataFrame(steps_of(given, filters, width), columns=names)
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    kinds = ["string", "int", "string", *["bigint"] * (len(names) - 3)]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return summed.groupBy("part").applyInPandas(run, f"part {dict(summed.dtypes)['part']}, {schema}")


# --- the five filters of the contract ------------------------------------------------------

FILTERS = "ABCDE"


def text_failures(text: Column) -> dict[str, Column]:
    """Failures that a text shows by itself, NULL texts as empty ones."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_ENDS, -1), lambda w: w != "")
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PCT * F.size(words),
        "C": 100 * upper > MAX_UPPER_PCT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def mask_of(failures: Mapping[str, Column], filters: str = FILTERS) -> Column:
    """One bit for each failure, that of the filter's place in ``filters``."""
    bits = [F.when(failed, 1 << filters.index(f)).otherwise(0) for f, failed in failures.items()]
    return reduce(Column.__add__, bits).cast("int")


def failure_masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id``, ``part`` and ``mask`` of every document, one row per row of ``docs``.

    NULL and empty texts are equal. A row fails E if a row of a smaller id has the same text;
    rows of one id do not make each other fail, and a NULL id is neither smaller nor larger
    than any other. A NULL part is the empty string. Other columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        mask_of(text_failures(text)).alias("mask"),
    )
    # Texts are read once; the rows kept here are some ten bytes each.
    own = stored(own, "filter-masks")
    first = own.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    kept = own.join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    e_bit = 1 << FILTERS.index("E")
    return kept.select("doc_id", "part", (F.col("mask") + F.when(copy, e_bit).otherwise(0)).alias("mask"))


def op12_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns. A document is good or toxic if any of its labels says so."""
    marks = labels.groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    marks = marks.where("doc_id is not null and good + toxic > 0")
    rows = failure_masks(docs).join(marks, "doc_id", "left")
    rows = rows.select("part", "mask", F.lit(1).cast("bigint").alias("documents"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    found = audit(rows, FILTERS, ["documents", "good", "toxic"])
    return found.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        F.col("lost_good").alias("good_lost"), F.col("lost_toxic").alias("toxic_lost"), "shapley",
    )


#: The same from counts by mask, for each order filter by filter, without a diagram.
OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS upper,
             min(doc_id) OVER (PARTITION BY text) AS first FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END)
          || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
          || (CASE WHEN 100 * upper > 2 * length(text) THEN 'C' ELSE '' END)
          || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
          || (CASE WHEN first < w.doc_id THEN 'E' ELSE '' END) AS fails
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS v),
o AS (SELECT a.v || b.v || c.v || d.v || e.v AS filter_order
      FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
             left(filter_order, step - 1) AS before FROM o, range(1, 6) r(step)),
p AS (SELECT part, filter_order, step, letter,
             coalesce(sum(n) FILTER (WHERE translate(fails, before || letter, '') = fails), 0) AS kept,
             coalesce(sum(n) FILTER (WHERE contains(fails, letter) AND translate(fails, before, '') = fails), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE contains(fails, letter)), 0) AS failing,
             coalesce(sum(n) FILTER (WHERE fails = letter), 0) AS unique_fails,
             coalesce(sum(good) FILTER (WHERE contains(fails, letter) AND translate(fails, before, '') = fails), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (WHERE contains(fails, letter) AND translate(fails, before, '') = fails), 0) AS toxic_lost
      FROM s, c GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(failing - removed AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM p
"""
