"""Raw (bronze) tables written by the ingest.

Parquet by ``event_date``, written by the built-in streaming file sink. Always read through the
table's folder, so that only committed files are seen.

``BatchTable`` holds each batch of an ingest in a folder of its own, with a ledger of what the
batch brought: counts of lines and rows, and the days that its rows belong to.

Rows without a usable time sit in the NULL date partition: ``dated`` prunes it, ``rejects``
returns it. ``read`` returns everything, so that the audit of the layer built on it sees rows
without a date and fails.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolake.schemas import Topic


def _dated() -> Column:
    return F.col("event_date").isNotNull()


def between(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of the days start..end (inclusive); prunes date partitions."""
    return rows.filter(F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


class FileSinkTable:
    def __init__(self, spark: SparkSession, root: str, topic: Topic):
        self.spark, self.topic = spark, topic
        self.path = f"{root.rstrip('/')}/{topic.name}"

    def _all(self) -> DataFrame:
        rows = self.spark.read.schema(self.topic.bronze_schema).parquet(self.path)
        return rows.select(*self.topic.bronze_columns)

    def read(self) -> DataFrame:
        return self._all()

    def dated(self) -> DataFrame:
        return self._all().filter(_dated())

    def rejects(self) -> DataFrame:
        return self._all().filter(~_dated())


class BatchTable:
    """``<root>/<topic>/rows/batch_id=<n>`` and ``<root>/<topic>/ledger/batch_id=<n>``.

    The ledger entry is written last: rows of a batch without one don't count.
    """

    _LEDGER = (
        "lines bigint, malformed bigint, rejected bigint, rows bigint, "
        "days array<struct<event_date: date, rows: bigint>>, batch_id bigint"
    )

    def __init__(self, spark: SparkSession, root: str, topic: Topic):
        self.spark, self.topic = spark, topic
        self.path = f"{root.rstrip('/')}/{topic.name}"

    def write_batch(self, rows: DataFrame, batch_id: int, counts: Observation) -> None:
        """Write a batch, or write it again, with the counts that were observed meanwhile."""
        own = f"{self.path}/rows/batch_id={batch_id}"
        rows.write.mode("overwrite").partitionBy("event_date").parquet(own)
        seen = counts.get
        # Only the number of rows per partition is read back, which the files' footers have.
        stored = self._stored(own, self.topic.bronze_schema)
        per_day = stored.groupBy("event_date").agg(F.count("*").alias("rows"))
        entry = per_day.agg(
            *[F.lit(seen[c]).cast("bigint").alias(c) for c in ("lines", "malformed", "rejected")],
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.sort_array(F.collect_list(F.struct("event_date", "rows"))).alias("days"),
        )
        entry.coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/ledger/batch_id={batch_id}"
        )

    def _stored(self, path: str, schema) -> DataFrame:
        """A folder's rows; none when nothing was written yet."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def ledger(self) -> DataFrame:
        """(batch_id, lines, malformed, rejected, rows, days) of every finished batch."""
        stored = self._stored(f"{self.path}/ledger", self._LEDGER)
        return stored.select("batch_id", "lines", "malformed", "rejected", "rows", "days")

    def totals(self) -> DataFrame:
        """One row: batches, and the sums of all counts over all runs of the ingest."""
        sums = ("lines", "malformed", "rejected", "rows")
        return self.ledger().agg(
            F.count("*").alias("batches"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        )

    def last_batch(self) -> int:
        """The number of the last finished batch, -1 before the first."""
        last = self.ledger().agg(F.max("batch_id")).first()[0]
        return -1 if last is None else last

    def days_after(self, batch_id: int, upto: int | None = None) -> DataFrame:
        """(event_date) of the days that finished batches after ``batch_id`` brought rows for."""
        batches = self.ledger().filter(F.col("batch_id") > batch_id)
        if upto is not None:
            batches = batches.filter(F.col("batch_id") <= upto)
        return batches.select(F.explode("days").alias("day")).select("day.event_date").distinct()

    def batches(self, upto: int | None = None) -> DataFrame:
        """All rows with their batch_id, up to a batch (by default the last finished one)."""
        schema = T.StructType([*self.topic.bronze_schema, T.StructField("batch_id", T.LongType())])
        last = self.last_batch() if upto is None else upto
        rows = self._stored(f"{self.path}/rows", schema)
        return rows.filter(F.col("batch_id") <= last).select(*self.topic.bronze_columns, "batch_id")

    def read(self, upto: int | None = None) -> DataFrame:
        return self.batches(upto).drop("batch_id")
