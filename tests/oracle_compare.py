"""Run every query and its reference SQL on one folder and compare all values exactly."""

from __future__ import annotations

import datetime
import math
import sys
import tempfile
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda row: repr(row)
    )


def compare(spark, connection, folder: str, query, sql: str) -> str:
    """Empty text when equal, otherwise the first difference."""
    frame = query(spark, folder)
    left = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    right = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} vs {sorted(columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    for mine, other in zip(left, right):
        if mine != other or [type(v) for v in mine] != [type(v) for v in other]:
            return f"{sorted(columns)}\n   spark {mine}\n  oracle {other}"
    return ""


def main(folder: str, names: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderloom-compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            difference = compare(spark, connection, folder, queries[name], oracles[name])
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        print(f"{name:32} {time.time() - start:6.2f}s  {difference or 'ok'}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
