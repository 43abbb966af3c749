"""Compare queries with their SQL on the same tables.

Run as a script: ``python tests/oracle.py [directory] [query ...]``.
"""

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{directory}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(data, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, directory, query, sql):
    """None when both agree, else what differs."""
    df = query(spark, directory)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None
    found = con.execute(sql)
    want = table_of([c[0] for c in found.description], found.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} <> {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows <> {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{a} <> {b}"
    return None


def main(argv):
    from pyspark.sql import SparkSession

    from tidemark.registry import ORACLES, QUERIES

    directory = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, directory, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
