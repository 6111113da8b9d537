"""Tables stored in buckets, so that grouping and joining by their keys moves no rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

#: What per-user models group and join by. A user alone would bring all days of a heavy one into
#: one bucket.
USER_DAY = ("event_date", "user_id")


def store_bucketed(
    tables: Mapping[str, DataFrame],
    database: str,
    root: str,
    buckets: int,
    keys: Sequence[str] = USER_DAY,
) -> dict[str, DataFrame]:
    """Store tables in sorted buckets below ``root`` and in the catalog; read them back.

    Rows are shuffled once, here, into a task and a file per bucket. Tables that are joined need
    the same number of buckets; as many as tasks should share the largest table.
    """
    found = {}
    for name, rows in tables.items():
        spark: SparkSession = rows.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        writer = rows.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
        writer.option("path", f"{root.rstrip('/')}/{name}").bucketBy(buckets, *keys).sortBy(
            *keys
        ).saveAsTable(f"{database}.{name}")
        found[name] = spark.table(f"{database}.{name}")
    return found
