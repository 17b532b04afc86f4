"""Run each catalogue query on Spark and its SQL on DuckDB; compare.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows (values compared exactly after the queries' own rounding).

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from mergestat.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    idx = [d_cols.index(c) for c in sorted(d_cols)]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} sql={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} sql={len(d_rows)}")
    if not problems:
        a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            problems.append(f"{len(bad)} differing rows, first: spark={bad[0][0]} sql={bad[0][1]}")
    return problems, len(s_rows)


def main(argv):
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    # A plain session like the driver's: none of mergestat's own settings.
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    failed = 0
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name not in sqls:
                n = df.count()
                print(f"{name:32s} rows-only {n:7d} {time.time() - t:6.1f}s")
                continue
            problems, n = compare(df, con, sqls[name])
        except Exception as e:  # noqa: BLE001
            problems, n = [f"error {type(e).__name__}: {str(e)[:400]}"], -1
        status = "OK " if not problems else "BAD"
        failed += bool(problems)
        print(f"{name:32s} {status} {n:7d} {time.time() - t:6.1f}s {'; '.join(problems)}",
              flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
