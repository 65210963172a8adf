"""Run registered queries next to their SQL counterpart in DuckDB.

    python tests/oracle.py [sf] [name-or-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session(cores: str = "8", shared: str | None = None):
    import tempfile

    from pyspark.sql import SparkSession
    shared = shared or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("corpusflow-tests")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", shared)
             .config("spark.sql.warehouse.dir", shared + "/warehouse").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connection(base: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return float(v)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, base, name, query, sql):
    """``(ok, message, rows, seconds)`` of one query."""
    t = time.time()
    df = query(spark, base)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t
    if sql is None:
        return True, "rows only", len(got), took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}", len(got), took
    if got == want:
        return True, "match" if got else "match (EMPTY)", len(got), took
    a = [r for r in got if r not in set(want)][:2] if len(got) < 50000 else got[:1]
    b = [r for r in want if r not in set(got)][:2] if len(want) < 50000 else want[:1]
    return False, f"{len(got)} vs {len(want)} rows\n   spark {str(a)[:900]}\n   duck  {str(b)[:900]}", len(got), took


def main():
    from corpusflow.plans import all_queries
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0][:1].isdigit() else "0.01"
    base = f"/root/testdata/sf{sf}"
    queries, oracles = all_queries()
    names = [n for n in queries if not args or any(n == a or n.startswith(a + "*") or
             (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    if args and args[0].startswith("@"):
        import importlib
        before = importlib.import_module("corpusflow.plans." + args[0][1:])
        names = [n for n in queries if queries[n].module == before.__name__]
    spark, con = session(), connection(base)
    bad = []
    for n in names:
        try:
            ok, msg, rows, took = compare(spark, con, base, n, queries[n], oracles.get(n))
        except Exception as e:  # noqa: BLE001
            ok, msg, rows, took = False, f"{type(e).__name__}: {str(e)[:900]}", 0, 0
        print(("ok  " if ok else "BAD ") + f"{n:28s} {rows:8d} rows {took:6.2f}s  {msg}", flush=True)
        if not ok:
            bad.append(n)
    print(f"{len(names) - len(bad)}/{len(names)} good; bad: {bad}")


if __name__ == "__main__":
    main()
