"""Run registered queries against their DuckDB oracles: python tests/check_queries.py [name-prefix ...]"""
from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: "NULL" if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA
                          else (f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(name, spark, con, queries, oracles, sf_dir):
    t0 = time.time()
    got = queries[name](spark, sf_dir).toPandas()
    t1 = time.time()
    if name not in oracles:
        return "rows-only", len(got), None, t1 - t0
    want = con.execute(oracles[name]).df()
    a, b = canon(got), canon(want)
    if list(a.columns) != list(b.columns):
        return "COLUMNS", len(got), f"{set(a.columns) ^ set(b.columns)}", t1 - t0
    if len(a) != len(b):
        return "ROWS", len(a), f"spark {len(a)} oracle {len(b)}", t1 - t0
    if not a.equals(b):
        bad = [c for c in a.columns if not a[c].equals(b[c])]
        i = (a[bad[0]] != b[bad[0]]).idxmax()
        return "VALUES", len(a), f"cols {bad} first {a.loc[i].to_dict()} vs {b.loc[i].to_dict()}", t1 - t0
    types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if str(got[c].dtype) != str(want[c].dtype)}
    return "ok", len(a), types or None, t1 - t0


def main(argv):
    import __spark_entry__ as E
    from chargelens.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    con = connect(sf_dir)
    queries, oracles = E.queries(), E.oracle_sql()
    names = [n for n in queries if not argv or any(n.startswith(p) for p in argv)]
    bad = 0
    for n in names:
        try:
            status, rows, note, sec = compare(n, spark, con, queries, oracles, sf_dir)
        except Exception as exc:
            status, rows, note, sec = "ERROR", -1, str(exc)[:700], 0
        if status not in ("ok", "rows-only"):
            bad += 1
        print(f"{status:9s} {n:45s} rows={rows} {sec:.1f}s {note or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
