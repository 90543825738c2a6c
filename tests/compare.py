"""Run queries next to their SQL on DuckDB and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]").appName("lamella")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def plain(v):
    """One comparable form for values of both engines; numbers keep their type."""
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, decimal.Decimal):
        return ("dec", format(v, "f"))
    if isinstance(v, bool):
        return ("bool", str(v))
    if isinstance(v, int):
        return ("int", str(v))
    if isinstance(v, float):
        return ("float", repr(v))
    if isinstance(v, (list, tuple)):
        return ("list", [plain(x) for x in v])
    return (type(v).__name__, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(json.dumps([plain(r[i]) for i in order]) for r in rows)


def compare(spark, name, sf_dir):
    """(difference or None, rows, seconds of Spark)."""
    import __spark_entry__ as entry

    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return (None if got else "no rows"), len(got), took
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(df.columns) ^ set(names))}", len(got), took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return None, len(got), took
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return (f"{len(a)} rows against {len(b)}, columns {sorted(names)}\n  spark {only_a[:3]}\n  sql   {only_b[:3]}",
            len(got), took)


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:] or list(entry.queries())
    wanted = [q for q in entry.queries() if any(q == w or (w.endswith("*") and q.startswith(w[:-1])) for w in wanted)]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for q in wanted:
        try:
            diff, n, took = compare(spark, q, sf)
        except Exception as e:  # report every query, also after one that fails
            diff, n, took = f"{type(e).__name__}: {str(e)[:1500]}", 0, 0.0
        kind = "sql " if q in entry.oracle_sql() else "rows"
        print(f"{'ok  ' if diff is None else 'DIFF'} {kind} {q} rows={n} {took:.1f}s" + (f"\n  {diff}" if diff else ""),
              flush=True)
        bad += diff is not None
    print(f"{len(wanted)} queries, {bad} differ")
