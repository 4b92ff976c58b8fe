"""Run registered queries beside their SQL: ``python -m workload.check [--folder DIR] [name part ...]``."""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from workload import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list | tuple):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    return value


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and its SQL; empty if nothing does."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _sorted_rows(names, cursor.fetchall())
    actual = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    if sorted(names) != sorted(result.columns):
        return [f"columns: spark {sorted(result.columns)}, sql {sorted(names)}"]
    found = []
    if len(actual) != len(expected):
        found.append(f"rows: spark {len(actual)}, sql {len(expected)}")
    for left, right in zip(actual, expected, strict=False):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            found.append(f"row: spark {left!r:.600}, sql {right!r:.600}")
            break
    return found


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(options.folder)
    failed = 0
    for name, run in QUERIES.items():
        if options.names and not any(part in name for part in options.names):
            continue
        started = time.monotonic()
        try:
            result = run(spark, options.folder)
            if name in ORACLES:
                found = differences(result, connection, ORACLES[name])
                state = "ok" if not found else "DIFFERS"
            else:
                found, state = [], f"rows {len(result.collect())}"
        except Exception as error:  # noqa: BLE001 - keep checking the others
            found, state = [str(error)[:1500]], "ERROR"
        failed += bool(found)
        print(f"{state:10s} {time.monotonic() - started:6.2f}s {name}", flush=True)
        for line in found:
            print("    " + line)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
