"""Run queries in Spark and their SQL in DuckDB and compare values.

    python -m tests.oracle_compare [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    """A comparable form that keeps the kind of the value apart (1 is not 1.0)."""
    if v is None:
        return ("null", "")
    if isinstance(v, bool):
        return ("bool", str(v))
    if isinstance(v, int):
        return ("int", str(v))
    if isinstance(v, Decimal):
        return ("decimal", str(v.quantize(Decimal("0.01"))))
    if isinstance(v, float):
        return ("float", f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return ("timestamp", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return ("text", str(v))


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = canonical(want_cols, cur.fetchall())
    got_cols = spark_df.columns
    if sorted(got_cols) != sorted(want_cols):
        return f"columns differ: only spark {set(got_cols) - set(want_cols)}, only sql {set(want_cols) - set(got_cols)}"
    got = canonical(got_cols, [tuple(r) for r in spark_df.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows in spark, {len(want)} in sql"
    names = sorted(got_cols)
    for g, w in zip(got, want):
        if g != w:
            return "; ".join(f"{n}: spark {a} sql {b}" for n, a, b in zip(names, g, w) if a != b)
    return None


def main(folder: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from tieout.session import local_session

    spark = local_session(8, 8, "12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    print("no sql:", sorted(set(queries) - set(sql)), "sql only:", sorted(set(sql) - set(queries)))
    bad = 0
    for name in only or queries:
        start = time.time()
        try:
            problem = compare(queries[name](spark, folder), con, sql[name])
        except Exception as e:  # report and go on with the rest
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
