"""Run registered queries beside their SQL. `python tests/oracle_check.py [--sf 0.01] [name ...]` prints a table."""

from __future__ import annotations

import argparse
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, name, sf_dir):
    """None if a query and its SQL agree, else what differs."""
    frame = entry_module.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return None if got[1] else "no rows"
    result = connection.execute(sql)
    want = rows_of([column[0] for column in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}"
    different = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if different:
        return f"{len(different)} of {len(got[1])} rows differ: {str(different[0][0])[:600]} AGAINST {str(different[0][1])[:600]}"
    return None if got[1] else "no rows"


if __name__ == "__main__":
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    sf_dir = f"/root/testdata/sf{options.sf}"
    spark, connection = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    for name in options.names or entry_module.queries():
        start = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        oracle = "sql " if name in entry_module.oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {oracle} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
