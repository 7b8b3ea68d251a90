"""Secret scans through a trigram inverted index; DataFrame operations only.

Each rule's regular expression gives a Boolean query on trigrams that every match must hold:
an OR of ANDs. The postings of the trigrams in these queries are built from all texts, lower
case; intersecting them gives the candidates of each rule, and only these are searched with
the expression. A rule without mandatory trigrams is searched in all texts.

Spans come from the pieces between matches: their lengths, summed up in order, give every
match's place in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.llm.common import texts
from vitalmart.llm.lines import row_key
from vitalmart.llm.patterns import parse

ANY = None
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the least length of ``group`` in a match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Formats of further well-known keys.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE + MORE


def _all_of(strings: set[str]) -> frozenset[frozenset[str]] | None:
    """The query that any of the strings occurs; ANY if one is too short to say."""
    if any(len(s) < 3 for s in strings):
        return ANY
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _least(clauses: set[frozenset[str]]) -> frozenset[frozenset[str]]:
    """Without clauses that another one already covers."""
    return frozenset(c for c in clauses if not any(o < c for o in clauses))


def _both(a, b):
    if a is ANY or b is ANY:
        return b if a is ANY else a
    return _least({x | y for x in a for y in b})


def _walk(tree) -> tuple[set[str] | None, frozenset[frozenset[str]] | None]:
    """Either all strings the expression matches, if few, or a query that holds for each."""
    exact, query, whole = {""}, ANY, True

    def end(strings):
        nonlocal exact, query, whole
        query, exact, whole = _both(query, _all_of(strings)), {""}, False

    for code, *value in tree:
        more = None
        if code == "set" and value[0] is not None and len(value[0]) <= 8:
            more = {c.lower() for c in value[0]}
        elif code == "group":
            more, inner = _walk(value[0])
            if more is None:
                end(exact)
                query = _both(query, inner)
                continue
        elif code == "either":
            parts = [_walk(t) for t in value[0]]
            if all(p[0] is not None for p in parts):
                more = set().union(*(p[0] for p in parts))
            else:
                end(exact)
                asks = [p[1] if p[0] is None else _all_of(p[0]) for p in parts]
                if all(a is not ANY for a in asks):
                    query = _both(query, _least(set().union(*asks)))
                continue
        elif code == "repeat":
            low, high, inner = value
            strings, ask = _walk(inner)
            if (low, high) == (0, 1) and strings is not None:
                more = {"", *strings}
            elif low and strings is not None and len(strings) ** low <= MOST_STRINGS:
                for _ in range(low):
                    exact = {a + b for a in exact for b in strings}
                if high != low:
                    end(exact)
                continue
            else:
                end(exact)
                if low:
                    query = _both(query, ask if strings is None else _all_of(strings))
                continue
        if more is None or len(more) * len(exact) > MOST_STRINGS:
            end(exact)
            exact = more if more is not None else {""}
        else:
            exact = {a + b for a in exact for b in more}
    if whole:
        return exact, ANY
    return None, _both(query, _all_of(exact))


def trigram_query(pattern: str) -> frozenset[frozenset[str]] | None:
    """Clauses of lower-case trigrams of which every match holds one whole; None without any."""
    exact, query = _walk(parse(pattern))
    return _all_of(exact) if exact is not None else query


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of these trigrams: ``trigram``, ``key`` of each text that has it."""
    low = docs.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]))
    return low.select("key", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``key`` and ``rules``: kinds whose trigram query the text fulfils."""
    clauses = [(r.kind, n, t, len(c)) for r in rules for n, c in enumerate(trigram_query(r.pattern) or ()) for t in sorted(c)]
    asked = docs.sparkSession.createDataFrame(clauses, "kind string, clause int, trigram string, need int")
    index = postings(docs, sorted({c[2] for c in clauses}))
    met = index.join(asked, "trigram").groupBy("key", "kind", "clause", "need").agg(F.collect_set("trigram").alias("had"))
    return met.where(F.size("had") == F.col("need")).groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def find_secrets(docs: DataFrame, *, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All spans that rules match, leftmost and not overlapping within a kind.

    Returns one row per row of ``docs``: ``doc_id`` and ``spans``, an array of (``start``,
    ``rank``, ``kind``, ``end``) in that order; places count code points, the end is
    exclusive, ``rank`` is the rule's place in ``rules``. Matches whose group is too short are
    dropped after the search, so they still take up their text. NULL and empty texts have no
    spans; repeated rows have equal ones; other columns are left out; no row gives no row.
    """
    keyed = texts(docs, id_col, text_col).withColumn("key", row_key("doc_id", "text"))
    scanned = [r for r in rules if trigram_query(r.pattern) is None]
    indexed = tuple(r for r in rules if r not in scanned)
    searched = keyed.join(candidates(keyed, indexed), "key", "left") if indexed else keyed.withColumn("kinds", F.array().cast("array<string>"))

    def matches(rule: Rule) -> Column:
        found = F.regexp_extract_all("text", F.lit(rule.pattern), 0)
        inner = F.regexp_extract_all("text", F.lit(rule.pattern), rule.group)
        sizes = F.transform(
            F.arrays_zip(F.split("text", rule.pattern, -1).alias("gap"), found.alias("hit"), inner.alias("part")),
            lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["hit"]).alias("hit"), (F.length(m["part"]) >= rule.least).alias("good")),
        )
        wanted = F.lit(True) if rule in scanned else F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        return F.when(wanted, F.when(F.regexp_like("text", F.lit(rule.pattern)), sizes))

    each = F.array(*[F.struct(F.lit(n).alias("rank"), F.lit(r.kind).alias("kind"), matches(r).alias("m")) for n, r in enumerate(rules)])
    some = searched.select("key", F.explode(F.filter(each, lambda x: x["m"].isNotNull())).alias("x"))
    parts = some.select("key", "x.rank", "x.kind", F.posexplode("x.m").alias("at", "m")).where("m.hit is not null")
    parts = parts.dropDuplicates(["key", "rank", "at"])
    upto = Window.partitionBy("key", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumn("end", F.sum(F.col("m.gap") + F.col("m.hit")).over(upto)).where("m.good")
    spans = placed.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("m.hit")).alias("start"), "rank", "kind", "end"))).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return keyed.select("doc_id", "key").join(spans, "key", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_secrets(docs: DataFrame) -> DataFrame:
    """The digest of the contract from the operator's spans."""
    spans = find_secrets(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return spans.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(F.encode(as_text(base), "UTF-8"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def _sql() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    each = "\nUNION ALL\n".join(
        f"SELECT doc_id, {n} AS rank, '{r.kind}' AS kind, string_split_regex(text, {quoted(r.pattern)}) AS gaps, "
        f"regexp_extract_all(text, {quoted(r.pattern)}) AS hits, regexp_extract_all(text, {quoted(r.pattern)}, {r.group}) AS parts, {r.least} AS least "
        f"FROM d WHERE regexp_matches(text, {quoted(r.pattern)})"
        for n, r in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({each}),
p AS (SELECT doc_id, rank, kind, least, unnest(hits) AS hit, unnest(parts) AS part, unnest(gaps[1:len(hits)]) AS gap,
             generate_subscripts(hits, 1) AS pos FROM m),
e AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY pos) AS BIGINT) AS stop FROM p),
s AS (SELECT doc_id, rank, kind, stop - length(hit) AS start, kind || ':' || (stop - length(hit)) || ':' || stop AS span
      FROM e WHERE length(part) >= least)
SELECT d.doc_id,
       count(*) FILTER (WHERE kind = 'assign') AS n_assign,
       count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id
"""


OP5_SQL = _sql()
