"""Written tables that cut a job's lineage, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tempolake.session import scratch_dir as folder

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` as a written table: read back, they don't depend on executors that may go."""
    spark = rows.sparkSession
    path = folder(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def written_alone(rows: DataFrame, purpose: str) -> DataFrame:
    """As ``written``; the job's shuffle files go when it ends, not when the driver drops it."""
    conf = rows.sparkSession.conf
    before = conf.get(_CLEAN_UP, "false")
    conf.set(_CLEAN_UP, "true")
    try:
        return written(rows, purpose)
    finally:
        conf.set(_CLEAN_UP, before)
