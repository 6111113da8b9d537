"""Compare a Spark result with the oracle's, values and row counts, order-insensitive."""

from __future__ import annotations

import datetime
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return (type(value).__name__, value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(spark_df, connection, sql: str) -> int:
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = rows_of(expected_columns, cursor.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    assert sorted(spark_df.columns) == sorted(expected_columns)
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{sum(missing.values())} missing, {sum(extra.values())} extra; "
        f"e.g. {list(missing)[:2]} vs {list(extra)[:2]}"
    )
    return sum(actual.values())
