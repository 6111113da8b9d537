"""Continuous ingest: one independent streaming query per topic, append only.

A query is a narrow projection (decode, date, partitioned write): no shuffle and no state.
Exactly-once comes from the checkpoint together with the sink's commit. With ``once`` a query also
drops events that a client sent twice; it then keeps a hash of each recent event in RocksDB, whose
changes go to the checkpoint, so a restarted query still knows them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tempolake.schemas import TOPICS, Topic
from tempolake.sources.bronze import BatchTable, FileSinkTable
from tempolake.streaming.decode import WATERMARK_DELAY, decode, to_bronze

# Fixed value: how often the ingest commits.
COMMIT_INTERVAL = {"processingTime": "60 seconds"}


_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Settings that a stateful query takes over when it starts, and its checkpoint keeps."""
    wanted = dict(_STATE)
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def bronze_stream(
    lines: DataFrame,
    topic: Topic,
    files_per_batch: int | None = None,
    once: str | None = None,
) -> DataFrame:
    """Raw-table rows of a stream of lines, with the event-time watermark declared.

    ``files_per_batch`` merges input tasks without a shuffle, for fewer files per commit.
    ``once`` is the delay within which an event that comes again is dropped (see ``to_bronze``).
    """
    decoded = decode(lines, topic)
    rows = to_bronze(decoded, topic, once or WATERMARK_DELAY, once=once is not None)
    return rows.coalesce(files_per_batch) if files_per_batch else rows


def start_ingest(
    lines: DataFrame,
    table: FileSinkTable,
    checkpoint: str,
    trigger: Mapping | None = None,
    files_per_batch: int | None = None,
    once: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start (or, with the same checkpoint, resume) the query that feeds ``table``.

    ``state_partitions`` splits the state of ``once`` when the query first starts; from then on
    the checkpoint decides.
    """
    rows = bronze_stream(lines, table.topic, files_per_batch, once)
    writer = (
        rows.writeStream.queryName(table.topic.name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{table.topic.name}")
        .trigger(**(trigger or COMMIT_INTERVAL))
    )
    with state_settings(lines.sparkSession, state_partitions):
        return writer.format("parquet").partitionBy("event_date").start(table.path)


def start_counted_ingest(
    lines: DataFrame, table: BatchTable, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """The same into a table that also keeps each batch's counts.

    A batch that runs again after a failure replaces what it wrote the first time, rows and
    counts alike, so both are exact.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = Observation()
        rows = to_bronze(decode(batch, table.topic, counts), table.topic)
        table.write_batch(rows, batch_id, counts)

    return (
        lines.writeStream.queryName(table.topic.name)
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{table.topic.name}")
        .trigger(**(trigger or COMMIT_INTERVAL))
        .start()
    )


def start_all(
    spark: SparkSession,
    source: Callable[[Topic], DataFrame],
    root: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    files_per_batch: int | None = None,
) -> dict[str, StreamingQuery]:
    """Start the four queries. ``source`` returns the stream of lines of a topic."""
    return {
        name: start_ingest(
            source(topic), FileSinkTable(spark, root, topic), checkpoint, trigger, files_per_batch
        )
        for name, topic in TOPICS.items()
    }


def await_all(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait for queries that end by themselves (``availableNow``); a failure is raised."""
    for query in queries.values():
        query.awaitTermination()
