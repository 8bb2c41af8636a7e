"""Compare registered queries with their check SQL, strictly.

    python tests/oracle_check.py [--sf 0.01] [prefix ...]

Column names, the four output types and every value must agree.
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as entry
from tidemark.bindings import BASE_TABLES
from tidemark.session import build_session

ORACLES = entry.oracle_sql()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def spark_session():
    spark = build_session(
        "oracle-check",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def compare(spark, con, name: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    df = entry.queries()[name](spark, folder)
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    sql = ORACLES.get(name)
    if sql is None:
        return None if rows else "no rows and no check SQL"
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns: spark {cols} oracle {sorted(rel.columns)}"
    kinds = dict(df.dtypes)
    other = dict(zip(rel.columns, [str(t) for t in rel.types]))
    bad = [(c, kinds[c], other[c]) for c in cols if TYPES.get(kinds[c]) != other[c]]
    if bad:
        return f"types: {bad}"
    place = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(r[i] for i in place)) for r in rel.fetchall())
    if rows == want:
        return None if rows else "EMPTY"
    gone, extra = sorted(set(want) - set(rows)), sorted(set(rows) - set(want))
    return (
        f"rows {len(rows)} vs {len(want)}; cols {cols}\n     only oracle: {gone[:2]}"
        f"\n     only spark:  {extra[:2]}"
    )


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("prefix", nargs="*")
    opts = args.parse_args()
    folder = f"/root/testdata/sf{opts.sf}"
    spark, con = spark_session(), duck(folder)
    failed = 0
    names = [
        n
        for n in entry.queries()
        if not opts.prefix or any(n.startswith(p) for p in opts.prefix)
    ]
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        took = time.time() - start
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        note = "" if name in ORACLES else " (rows only)"
        print(f"{mark} {name} {took:.1f}s{note}" + (f"\n     {problem}" if problem else ""), flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
