"""Compare registered queries with their DuckDB text: ``python tests/compare.py [sf] [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else (int(x) if x == int(x) and abs(x) < 1e15 else x)
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in x.items())
    if isinstance(x, (list, tuple)) and not hasattr(x, "asDict"):
        return tuple(plain(v) for v in x)
    if hasattr(x, "asDict"):
        return tuple((k, plain(v)) for k, v in x.asDict().items())
    return x


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, query, sql: str | None, sf: str) -> tuple[str, int]:
    """Empty text when equal, and the number of rows."""
    df = query(spark, sf)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return "", len(got)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if got == want:
        return "", len(got)
    a, b = set(map(repr, got)), set(map(repr, want))
    return (f"{len(got)} rows vs {len(want)}; only spark {sorted(a - b)[:2]}; "
            f"only sql {sorted(b - a)[:2]}"[:1500]), len(got)


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from seqtide import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf), oracle_sql(), 0
    for name, q in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            text, n = difference(spark, con, q, oracles.get(name), sf)
        except Exception as e:  # noqa: BLE001
            text, n = f"ERROR {type(e).__name__}: {str(e)[:1500]}", -1
        bad += bool(text)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if text else 'ok':4} {kind:4} {name:28} {n:7} {time.time() - began:6.1f}s {text}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
