"""Run registered Spark plans and their DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per plan: rows, schema and an order-insensitive value match.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (float, np.floating)):
        return round(float(v), 9)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return False, f"columns {sorted(spark_df.columns)} vs {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return False, f"rows {len(spark_df)} vs {len(oracle_df)}"
    a, b = canon(spark_df), canon(oracle_df)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} differing rows, e.g. {bad[0]}"
    return True, "ok"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    from marquee.session import local_session
    import __spark_entry__ as E

    spark = local_session()
    con = duck(sf_dir)
    oracle = E.oracle_sql()
    failed = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        sdf = fn(spark, sf_dir).toPandas()
        ts = time.time() - t0
        if name not in oracle:
            print(f"{name:34s} rows={len(sdf):8d} spark={ts:6.1f}s  (no oracle)")
            continue
        t0 = time.time()
        odf = con.execute(oracle[name]).df()
        to = time.time() - t0
        ok, msg = compare(sdf, odf)
        failed += not ok
        print(f"{name:34s} rows={len(sdf):8d} spark={ts:6.1f}s duck={to:5.1f}s {'PASS' if ok else 'FAIL'} {msg}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
