"""Quality rules: a learned decision list over interpretable statistics of a text.

Every text gives a row of counts (words, symbols, repeated lines, ...), and these give the
features a rule may test, all of them plain columns. Rules are learned from labelled rows by
sequential covering: a rule is grown condition by condition (a feature at least or at most a
threshold) on two thirds of the rows left, by information gain, until it covers no document
of the other class; conditions are pruned from its end as the last third advises; rows it
covers are taken out, and the next rule is learned from the rest. Rules that help nothing in
the end are dropped. The list is applied as one ordered conditional expression of Spark, so
judging a corpus needs no Python beyond the counts.

Rules are learned on the driver on a bounded sample of labelled rows: the first ``max_docs``
by a hash of the id, as rows of some ten numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalmart.llm.common import computed, fresh, stored, take_over
from vitalmart.llm.quality import held_out

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
MARKS = b"!?"
MAX_DOCS = 20_000
MIN_PRECISION = 0.9
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

# --- statistics ----------------------------------------------------------------------------

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_adjacent", "n_upper", "n_digits", "n_marks",
)


def repeat_words(ids: np.ndarray, size: int = 3) -> int:
    """Words in windows of ``size`` words that are found twice or more, the first included."""
    if len(ids) <= size:
        return 0
    keys = ids
    for k in range(1, size):
        # Windows one word longer, numbered anew, so that keys stay small.
        keys = keys[: len(ids) - k] * (int(ids.max()) + 1) + ids[k:]
        keys = np.unique(keys, return_inverse=True)[1]
    often = np.bincount(keys)[keys] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:-size] += often
    edge[size:] -= often
    return int(np.count_nonzero(np.cumsum(edge)))


def counts_of(text: str) -> tuple[int, ...]:
    """``COUNTS`` of one text. Words end at space and 0x09-0x0D; lines are those with a word."""
    data = text.encode()
    words = data.split()
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    lines = [line for line in data.split(b"\n") if line.strip()]
    plain = len(data) == len(text)
    return (
        len(words),
        len(text) - sum(map(data.count, SPACES)),
        sum(map(data.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(ids),
        len(lines),
        len(numbers),
        int(np.count_nonzero(ids[1:] == ids[:-1])),
        len(data) - len(data.translate(None, _UPPER)) if plain else sum(map(str.isupper, text)),
        len(data) - len(data.translate(None, b"0123456789")),
        sum(map(data.count, MARKS)),
    )


_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def _counted(texts: list[str]) -> list[pa.Array]:
    take_over("rules")
    rows = np.array([counts_of(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
    return [pa.array(column) for column in rows.T]


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every row, from whole texts. NULL texts count as empty."""
    fields = [T.StructField(c, T.LongType()) for c in COUNTS]
    return computed(docs, (id_col,), text_col, fields, _counted).withColumnRenamed("c0", "doc_id")


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def features() -> dict[str, Column]:
    """What rules test, over ``COUNTS``. A share of nothing is 0."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _share("word_chars", "n_words"),
        "symbol_share": _share("n_symbols", "word_chars"),
        "mark_share": _share("n_marks", "word_chars"),
        "upper_share": _share("n_upper", "word_chars"),
        "digit_share": _share("n_digits", "word_chars"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "adjacent_share": _share("n_adjacent", "n_words"),
        "distinct_share": _share("n_distinct", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "line_words": _share("n_words", "n_lines"),
    }


# --- decision lists ------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, values: Mapping[str, Column]) -> Column:
        value = values[self.feature]
        return value >= self.threshold if self.at_least else value <= self.threshold

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.at_least else values <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    verdict: int
    covered: int  # learned rows that reach this rule and fit it
    right: int  # of these, rows of its verdict

    def column(self, values: Mapping[str, Column]) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(values)
        return out

    def __str__(self) -> str:
        return f"if {' and '.join(map(str, self.conditions))} then {self.verdict} ({self.right} of {self.covered})"


@dataclass(frozen=True)
class DecisionList:
    """The verdict of the first rule that fits, else ``default``."""

    rules: tuple[Rule, ...]
    default: int

    def verdict(self, values: Mapping[str, Column]) -> Column:
        """One ordered conditional expression; a NULL feature fits no condition."""
        out = None
        for r in self.rules:
            out = F.when(r.column(values), r.verdict) if out is None else out.when(r.column(values), r.verdict)
        return F.lit(self.default) if out is None else out.otherwise(self.default)

    def __str__(self) -> str:
        return "\n".join([*map(str, self.rules), f"else {self.default}"])


def _covers(conditions: Sequence[Condition], table: Mapping[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for c in conditions:
        out &= c.holds(table[c.feature])
    return out


def _gains(values: np.ndarray, target: np.ndarray) -> tuple[float, float, bool]:
    """Best gain of a threshold on these values, the threshold, and on which side it covers.

    The gain is that of first-order rules: target rows covered, times the bits their share rises.
    """
    order = np.argsort(values, kind="stable")
    v, y = values[order], target[order]
    cuts = np.flatnonzero(v[1:] > v[:-1]) + 1  # the first place behind each cut
    if not len(cuts):
        return 0.0, 0.0, True
    total = int(y.sum())
    below = np.cumsum(y)[cuts - 1]
    base = np.log2(total / len(y))
    best = (0.0, 0.0, True)
    for at_least, hits, size in ((False, below, cuts), (True, total - below, len(y) - cuts)):
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(hits > 0, hits * (np.log2(hits / size) - base), 0.0)
        k = int(gain.argmax())
        if gain[k] > best[0] + 1e-9:
            middle = (float(v[cuts[k] - 1]) + float(v[cuts[k]])) / 2
            # two neighbours in floating point have no middle
            best = (float(gain[k]), middle if v[cuts[k] - 1] < middle else float(v[cuts[k]]), at_least)
    return best


def grow(table: Mapping[str, np.ndarray], target: np.ndarray, most: int = 6) -> list[Condition]:
    """Conditions added one by one, the largest gain first, until only target rows are covered."""
    conditions: list[Condition] = []
    inside = np.ones(len(target), bool)
    while len(conditions) < most and target[inside].any() and not target[inside].all():
        found = [(*_gains(values[inside], target[inside]), name) for name, values in table.items()]
        gain, threshold, at_least, name = max(found, key=lambda g: g[0])
        if gain <= 0:
            break
        conditions.append(Condition(name, at_least, threshold))
        inside &= conditions[-1].holds(table[name])
    return conditions


def prune(conditions: list[Condition], table: Mapping[str, np.ndarray], target: np.ndarray) -> list[Condition]:
    """The beginning of the conditions that is worth most on rows it was not grown on."""

    def worth(n: int) -> float:
        inside = _covers(conditions[:n], table, len(target))
        hits = int(target[inside].sum())
        return (2 * hits - int(inside.sum())) / (int(inside.sum()) + 1)

    return conditions[: max(range(1, len(conditions) + 1), key=lambda n: (worth(n), n))] if conditions else []


def learn(
    table: Mapping[str, np.ndarray], labels: np.ndarray, *, verdict: int = 0, min_precision: float = MIN_PRECISION, max_rules: int = 30, seed: int = 5
) -> DecisionList:
    """A list of rules for ``verdict`` (label 0 or 1), the other label as default.

    ``table`` has a value of each feature for each row, ``labels`` its label. A rule must be
    right on ``min_precision`` of the rows it covers, of those it was not grown on too. Without rows of both labels the
    list is empty.
    """
    target = np.asarray(labels) == verdict
    split = np.random.default_rng(seed).random(len(target)) < 2 / 3
    left = np.ones(len(target), bool)
    found: list[list[Condition]] = []
    take = lambda rows: {name: values[rows] for name, values in table.items()}
    while len(found) < max_rules and target[left].any() and not target[left].all():
        growing, pruning = left & split, left & ~split
        conditions = prune(grow(take(growing), target[growing]), take(pruning), target[pruning])
        inside = left & _covers(conditions, table, len(target))
        # Both by all rows and by those it was not grown on, of which it must cover some.
        if not conditions or not all(target[x].any() and target[x].sum() >= min_precision * x.sum() for x in (inside, inside & ~split)):
            break
        found.append(conditions)
        left &= ~inside
    for conditions in found[::-1]:  # a rule goes if the list errs no more without it
        others = [c for c in found if c is not conditions]
        if _errors(others, table, target) <= _errors(found, table, target):
            found = others
    rules, left = [], np.ones(len(target), bool)
    for conditions in found:
        inside = left & _covers(conditions, table, len(target))
        rules.append(Rule(tuple(conditions), verdict, int(inside.sum()), int(target[inside].sum())))
        left &= ~inside
    return DecisionList(tuple(rules), 1 - verdict)


def _errors(rules: list[list[Condition]], table: Mapping[str, np.ndarray], target: np.ndarray) -> int:
    said = np.zeros(len(target), bool)
    for conditions in rules:
        said |= _covers(conditions, table, len(target))
    return int((said != target).sum())


# --- rules for a corpus --------------------------------------------------------------------


def learn_from(stats: DataFrame, labels: DataFrame, *, max_docs: int = MAX_DOCS, where: Column | None = None, **options) -> DecisionList:
    """The decision list that rejects documents of label 0, learned from at most ``max_docs``
    rows of ``stats`` that have a label, are not held out and fulfil ``where``."""
    values = features()
    chosen = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label in (0, 1) and doc_id is not null").where(~held_out()).distinct()
    rows = stats if where is None else stats.where(where)
    rows = rows.join(chosen, "doc_id").select(F.xxhash64("doc_id").alias("place"), "doc_id", "label", *[v.alias(n) for n, v in values.items()])
    found = rows.orderBy("place", "doc_id", "label", *values).limit(max_docs).collect()
    table = {n: np.array([r[n] for r in found], float) for n in values}
    return learn(table, np.array([r["label"] for r in found], int), **options)


def base_failed() -> Column:
    """Fixed rules of the contract: few words, or most words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def judged(stats: DataFrame, found: DecisionList, name: str = "good") -> DataFrame:
    """The statistics with the list's verdict, true for label 1."""
    return stats.withColumn(name, found.verdict(features()) == 1)


def keep_good(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that fail no fixed rule and that the learned list keeps.

    The list is learned from ``docs`` itself. All columns stay; NULL texts count as empty and
    go; equal rows fare alike; no row gives no row.
    """
    stats = statistics(docs, text_col=text_col)
    found = learn_from(stats, labels, where=~base_failed(), **options)
    fields = [T.StructField(c, T.LongType()) for c in COUNTS]
    rows = computed(docs, tuple(docs.columns), text_col, fields, _counted)
    good = fresh(rows, "good")
    kept = judged(rows.where(~base_failed()), found, good).where(F.col(good))
    return kept.select(*[F.col(f"c{n}").alias(c) for n, c in enumerate(docs.columns)])


def op11_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, and the share features that the rules test.

    One row per row of ``docs``; NULL texts have no words; other columns are left out.
    """
    stats = stored(statistics(docs), "text-statistics")  # texts are read once
    found = learn_from(stats, labels, where=~base_failed())
    out = judged(stats, found)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & F.col("good")).alias("kept"),
    )
