"""Side-by-side run of Spark queries and their DuckDB twins.

    python -m checks.compare SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return repr(value + 0.0) if value == value else ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = sorted(tuple(_cell(r[i]) for i in order) for r in rows)
    return [names[i] for i in order], cells


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both agree, else the first difference."""
    df = query(spark, sf_dir)
    names, got = _rows(df.columns, df.collect())
    found = con.execute(sql)
    other, want = _rows([d[0] for d in found.description], found.fetchall())
    if names != other:
        return f"columns {sorted(set(names) ^ set(other))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            where = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
            return f"{sum(a != b for a, b in zip(got, want))} rows differ, first {where[:4]}"
    return None


def main() -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from vitalmart.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), duck(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        began = time.monotonic()
        try:
            problem = difference(spark, con, query, ORACLE[name], sf_dir) if name in ORACLE else "no SQL"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name:42s} {time.monotonic() - began:6.2f} {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
