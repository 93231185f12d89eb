"""Runs a registered query and its SQL statement and compares the two row bags."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from millrace.sources.tables import ALL_TABLES  # noqa: E402

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in ALL_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, folder: str, name: str, df=None) -> str:
    """Empty when both sides agree in column names, types and rows."""
    df = df or queries()[name](spark, folder)
    spark_rows = df.collect()
    statement = oracle_sql().get(name)
    if statement is None:
        return "" if spark_rows else "no rows"
    result = connect(folder).execute(statement)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    wrong = {
        field: (kind, types[field])
        for field, kind in df.dtypes
        if TYPES.get(kind) != types[field]
    }
    if wrong:
        return f"types differ: {wrong}"
    ours, theirs = bag(spark_rows, df.columns), bag(result.fetchall(), names)
    if ours != theirs:
        return (
            f"rows differ: {sum(ours.values())} and {sum(theirs.values())}, "
            f"only ours {list((ours - theirs).items())[:2]}, only SQL {list((theirs - ours).items())[:2]}"
        )
    return ""


def main(folder: str, wanted: list[str]) -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failures = 0
    for name in wanted or queries():
        started = time.time()
        try:
            problem = compare(spark, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += bool(problem)
        kind = "sql" if name in oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok'} {name} [{kind}] {time.time() - started:.2f}s {problem}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
