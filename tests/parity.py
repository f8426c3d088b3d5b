"""Compare registered queries with their oracle SQL: ``python tests/parity.py [sf_dir] [keys…]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if value is None:
        return "~null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "~nan" if math.isnan(number) else repr(number + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, connection, function, sql, sf_dir):
    """(match, spark rows, message)."""
    df = function(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return False, 0, "cross join in the plan"
    got_columns, got = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return False, len(got), f"columns {got_columns} vs {want_columns}"
    if len(got) != len(want):
        return False, len(got), f"rows {len(got)} vs {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return False, len(got), f"first difference {mine} vs {theirs}"
    return True, len(got), ""


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    spark = builder.config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = oracle(sf_dir), 0
    sql = contract.oracle_sql()
    for key, function in contract.queries().items():
        if wanted and key not in wanted:
            continue
        begun = time.time()
        try:
            if key in sql:
                match, n, message = compare(spark, connection, function, sql[key], sf_dir)
            else:
                match, n, message = True, len(function(spark, sf_dir).collect()), "rows only"
        except Exception as error:  # noqa: BLE001
            match, n, message = False, 0, f"{type(error).__name__}: {str(error)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failures += not match
        print(f"{'ok  ' if match else 'FAIL'} {key:30s} {n:7d} rows {time.time() - begun:6.2f}s {message}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
