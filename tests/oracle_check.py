"""Side-by-side check of Spark queries against their DuckDB formulations.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.  Compares row
count, column names and the sorted values of every column (floats exactly,
since both sides round them to the same digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.date() if v == v.normalize() else v.to_pydatetime()
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    left = sdf.toPandas()
    t1 = time.time()
    right = con.execute(sql).df()
    t2 = time.time()
    msg = f"{name}: spark {len(left)} rows {t1 - t0:.1f}s, duckdb {len(right)} rows {t2 - t1:.1f}s"
    if sorted(left.columns) != sorted(right.columns):
        return False, msg + f"\n  columns differ: {sorted(set(left.columns) ^ set(right.columns))}"
    if len(left) != len(right):
        return False, msg + "\n  row counts differ"
    a, b = canon(left), canon(right)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        cols = sorted(left.columns)
        x, y = bad[0]
        diffs = [(c, u, v) for c, u, v in zip(cols, x, y) if u != v]
        return False, msg + f"\n  {len(bad)} rows differ, first: {diffs[:6]}"
    return True, msg


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from campaignlens.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"{name}: rows-only, {n} rows")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        failed += not ok
        print(("OK   " if ok else "FAIL ") + msg, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
