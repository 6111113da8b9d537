"""Running figures of a stream of plays: sliding windows and sessions, with state.

Both keep what is not finished yet in RocksDB, until the event-time watermark passes it, and then
append it to a table. Messages without a usable time belong to no window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempolake.functions import event_time, valid_ms
from tempolake.streaming.decode import WATERMARK_DELAY
from tempolake.streaming.ingest import COMMIT_INTERVAL, state_settings


def _timed(messages: DataFrame, delay: str) -> DataFrame:
    timed = messages.withColumn("event_time", event_time(valid_ms(F.col("ts"))))
    return timed.filter(F.col("event_time").isNotNull()).withWatermark("event_time", delay)


def plays_per_window(
    messages: DataFrame,
    keys: Sequence[str],
    length: str,
    slide: str | None = None,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """(window_start, window_end, keys, plays) of decoded messages.

    Windows start at multiples of ``slide`` since 1970 (of ``length``, without it). Equal keys
    are counted before they are shuffled.
    """
    window = F.window("event_time", length, slide)
    counted = _timed(messages, delay).groupBy(window.alias("window"), *keys)
    return counted.agg(F.count("*").alias("plays")).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "plays",
    )


def user_sessions(
    messages: DataFrame, gap: str, user: str = "userId", delay: str = WATERMARK_DELAY
) -> DataFrame:
    """(session_start, last_event, user, events): runs of a user's messages without a ``gap``."""
    known = _timed(messages, delay).filter(F.col(user).isNotNull())
    grouped = known.groupBy(F.session_window("event_time", gap).alias("session"), user)
    return grouped.agg(
        F.max("event_time").alias("last_event"), F.count("*").alias("events")
    ).select(F.col("session.start").alias("session_start"), "last_event", user, "events")


def start_figures(
    figures: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append figures to the table at ``path`` as soon as they are final."""
    writer = (
        figures.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or COMMIT_INTERVAL))
    )
    with state_settings(figures.sparkSession, state_partitions):
        return writer.format("parquet").start(path)
