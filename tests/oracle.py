"""Compare every registered query with its SQL on DuckDB: columns, rows, values.

    python tests/oracle.py [directory of the tables] [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import tempfile
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, (bytes, bytearray, memoryview)):
        return bytes(value).hex()
    if isinstance(value, Decimal):
        return float(value) if value != int(value) else int(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value == int(value) and abs(value) < 1e15 else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return datetime.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def duck(sf):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def compare(spark, con, sf, name, fn, sql):
    started = time.time()
    df = fn(spark, sf)
    got_columns, got = bag(df.columns, df.collect())
    took = time.time() - started
    if sql is None:
        return f"rows only ({sum(got.values())})", took
    result = con.execute(sql)
    want_columns, want = bag([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"FAIL columns {got_columns} != {want_columns}", took
    if got != want:
        return (f"FAIL {sum(got.values())} rows != {sum(want.values())}; extra {list((got - want))[:2]} "
                f"missing {list((want - got))[:2]}"), took
    if not got:
        return "FAIL no rows to compare", took
    return f"ok {sum(got.values())}", took


def main(argv):
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="statlake-oracle-")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf), 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        try:
            verdict, took = compare(spark, con, sf, name, fn, oracles.get(name))
        except Exception as error:
            verdict, took = f"FAIL {type(error).__name__}: {str(error)[:600]}", 0
        failed += verdict.startswith("FAIL")
        print(f"{name:32} {took:6.2f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
