"""Run every query against its SQL counterpart: ``python tests/check_oracles.py [sf] [name...]``."""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from batchgate.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return value.normalize() + 0
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def compare(spark, connection, name, sf_dir):
    """None if both agree, else what differs; seconds of the Spark run."""
    start = time.time()
    frame = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in frame.collect()]
    seconds = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, len(rows), seconds
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(names)}", len(rows), seconds
    got, want = sorted_rows(frame.columns, rows), sorted_rows(names, expected)
    if got != want:
        first = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"rows {len(got)} / {len(want)}: {first}", len(rows), seconds
    return None, len(rows), seconds


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    chosen = sys.argv[2:] or list(entry.queries())
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(sf_dir)
    bad = 0
    for query in chosen:
        try:
            problem, count, took = compare(session, duck, query, sf_dir)
        except Exception as error:  # report and go on
            problem, count, took = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0
        bad += problem is not None
        print(f"{query:28s} {count:7d} rows {took:6.2f} s  {problem or 'ok'}", flush=True)
    print("differences:", bad)
