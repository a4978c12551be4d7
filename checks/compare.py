"""Run Spark queries next to their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time

import duckdb
from pyspark import SparkConf
from pyspark.sql import SparkSession

from checks.duck_sql import SQL
from checks.spark_queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


_SQL_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def session(cores: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]")
    if not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clipsieve-stages-"))
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Leave out the call-site capture of every column expression, which slows down plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return str(value) if value is not None else None


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((value is None, value or "") for value in row))


def compare(spark: SparkSession, connection, name: str, sf_dir: str) -> str:
    """"ok" or what differs."""
    frame = QUERIES[name](spark, sf_dir)
    left = _sorted_rows(frame.columns, frame.collect())
    if name not in SQL:
        return f"rows only: {len(left)}"
    cursor = connection.execute(SQL[name])
    names = [column[0] for column in cursor.description]
    kinds = {column[0]: _SQL_TYPES.get(str(column[1]), str(column[1])) for column in cursor.description}
    spark_kinds = dict(frame.dtypes)
    wrong = {n: (spark_kinds.get(n), kind) for n, kind in kinds.items() if spark_kinds.get(n) != kind}
    if wrong:
        return f"types differ: {wrong}"
    right = _sorted_rows(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns differ: {sorted(frame.columns)} / {sorted(names)}"
    if left == right:
        return f"ok ({len(left)} rows)"
    pairs = [(a, b) for a, b in zip(left, right) if a != b][:2]
    return f"DIFFERS: {len(left)} / {len(right)} rows, {str(pairs)[:1500]}"


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark, connection = session(), duck(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            outcome = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            outcome = f"FAILED: {str(error)[:1500]}"
        failed += not outcome.startswith(("ok", "rows only"))
        print(f"{name:24s} {time.time() - started:6.1f}s  {outcome}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
