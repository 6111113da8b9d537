"""Paced replay: messages sent in slices of event time, one after the other.

The messages are stored once by slice, sorted by a range partitioning; each slice is then a
job over its own partition only. The driver holds the numbers of the slices, of which there are as
many as slice lengths in the replayed time.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolake.functions import valid_ms

Send = Callable[[DataFrame, int], None]


def stage_slices(messages: DataFrame, folder: str, slice_ms: int) -> None:
    """Store (key, value, topic, ts) messages by slice, counted from the earliest time.

    Messages without a usable time (0, as the replay has it, or null) go with the first slice.
    """
    timed = F.nullif(valid_ms(F.col("ts")), F.lit(0))
    first = messages.agg(F.min(timed)).first()[0] or 0
    number = F.greatest(F.floor((timed - first) / slice_ms), F.lit(0))
    sliced = messages.withColumn("slice", F.coalesce(number, F.lit(0)).cast("bigint"))
    # The value spreads a time that many messages share.
    order = ["slice", "ts", "value"]
    ordered = sliced.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.partitionBy("slice").parquet(folder)


def read_slice(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """The messages of one staged slice."""
    return spark.read.parquet(folder).filter(F.col("slice") == number).drop("slice")


def replay(
    spark: SparkSession,
    folder: str,
    send: Send,
    slice_ms: int,
    speed: float = 0,
    clock: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep,
) -> list[int]:
    """Send the staged slices in order, at ``speed`` times real time (0: without waiting).

    A slice is due when its time has passed since the first one; late slices are sent at once.
    Returns the numbers of the slices.
    """
    numbers = [r[0] for r in spark.read.parquet(folder).select("slice").distinct().collect()]
    start = clock()
    for number in sorted(numbers):
        if speed > 0:
            wait = start + (number - min(numbers)) * slice_ms / 1000 / speed - clock()
            if wait > 0:
                sleep(wait)
        send(read_slice(spark, folder, number), number)
    return sorted(numbers)


def to_files(folder: str) -> Send:
    """Sends a slice as files of lines below ``folder``."""

    def send(messages: DataFrame, number: int) -> None:
        messages.select("value").write.mode("append").text(f"{folder}/slice={number}")

    return send
