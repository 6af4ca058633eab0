"""Compare registered queries with their DuckDB SQL: rows, column names, values.

Run as a script: python tests/oracle_check.py [sf] [query ...]
"""

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _canonical(df):
    df = df[sorted(df.columns)]
    if len(df.columns) == 0:
        return df
    return df.sort_values(list(df.columns), ignore_index=True, key=lambda s: s.astype(str))


def compare(got: pd.DataFrame, want: pd.DataFrame):
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = _canonical(got), _canonical(want)
    for c in got.columns:
        a, b = got[c], want[c]
        if a.dtype != b.dtype and not (a.isna().any() or b.isna().any()):
            if not (a.dtype == object or str(a.dtype).startswith("str")):
                return f"{c}: type {a.dtype} != {b.dtype}"
        differ = ~((a == b) | (a.isna() & b.isna()))
        if differ.any():
            i = differ.idxmax()
            return f"{c}: {int(differ.sum())} values differ, first {a[i]!r} != {b[i]!r}"
    return None


def check(spark, con, sf_dir, name, run, sql):
    t0 = time.time()
    got = run(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return None, len(got), t1 - t0, 0.0
    want = con.execute(sql).df()
    return compare(got, want), len(got), t1 - t0, time.time() - t1


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tagloom.staging import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark, con = build_session("oracle-check"), connect(sf_dir)
    runs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or runs:
        try:
            problem, rows, spark_s, duck_s = check(spark, con, sf_dir, name, runs[name], sqls.get(name))
        except Exception as e:
            problem, rows, spark_s, duck_s = f"{type(e).__name__}: {str(e)[:600]}", 0, 0, 0
        bad += problem is not None
        state = "ok" if problem is None else f"FAIL {problem}"
        print(f"{name:28s} {rows:8d} rows {spark_s:6.2f}s duck {duck_s:5.2f}s {'' if name in sqls else 'rows-only '}{state}", flush=True)
    print("failures:", bad)
