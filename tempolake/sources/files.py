"""Newline-JSON event files and their replay as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolake.functions import trim_all
from tempolake.schemas import TOPICS, Topic
from tempolake.sources.kafka import message_key
from tempolake.streaming.decode import not_blank

# A file named after a topic, or a part file in a folder named after one.
_TOPIC_PATH = "/(" + "|".join(TOPICS) + ")(?:/[^/]*)?$"


def _topic_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, _TOPIC_PATH, 1), F.lit(""))


def topic_lines(spark: SparkSession, directory: str) -> DataFrame:
    """(value, topic, path, block) of every line of the topic files below ``directory``.

    Lines of other files are filtered out. Fails when there is no topic file at all.
    """
    recursive = spark.read.option("recursiveFileLookup", True)
    listed = recursive.format("binaryFile").load(directory).select("path")
    if listed.filter(F.col("path").rlike(_TOPIC_PATH)).isEmpty():
        raise FileNotFoundError(f"{directory} has no file or folder with a topic's name")
    files = spark.read.option("recursiveFileLookup", True).text(directory)
    path = F.col("_metadata.file_path")
    return files.filter(path.rlike(_TOPIC_PATH)).select(
        "value",
        _topic_of(path).alias("topic"),
        path.alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def stream_lines(
    spark: SparkSession,
    directory: str,
    topic: Topic | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Unbounded ``value`` lines of the files below ``directory``, oldest file first.

    With ``topic`` only the files that ``topic_lines`` counts as its own, so that the four
    queries can share one directory; without, every file (a folder that belongs to one
    topic). ``max_files`` limits the files per trigger, which paces a backfill.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(directory)
    if topic:
        # Known per file before it is read, so files of other topics are not scanned.
        lines = lines.filter(_topic_of(F.col("_metadata.file_path")) == topic.name)
    return lines.select("value")


def replay_messages(lines: DataFrame) -> DataFrame:
    """(key, value, topic, ts) messages of ``topic_lines``, malformed lines skipped.

    The payload is the trimmed line itself. ``ts`` is 0 where the event has none. A line must
    be one object: two of them are malformed.
    """
    fields = "array<struct<userId: string, ts: string>>"
    trimmed = not_blank(lines).withColumn("value", trim_all(F.col("value")))
    whole = F.concat(F.lit("["), "value", F.lit("]"))
    parsed = trimmed.select("*", F.from_json(whole, fields).alias("_rows"))
    # The observation keeps Catalyst from parsing each line again for the filter.
    counted = parsed.observe("replay", F.count("*").alias("lines"))
    one = (F.size("_rows") == 1) & F.col("value").startswith("{")
    kept = counted.filter(one).withColumn("_row", F.get("_rows", F.lit(0)))
    kept = kept.filter(F.col("_row").isNotNull())
    ts = F.col("_row.ts")
    number = F.coalesce(ts.try_cast("bigint"), ts.try_cast("double").try_cast("bigint"))
    position = [F.col(c) for c in ("path", "block") if c in lines.columns]
    return kept.select(
        message_key(F.col("_row.userId")).alias("key"),
        "value",
        F.translate("topic", "_", "-").alias("topic"),
        F.coalesce(number, F.lit(0)).cast(T.LongType()).alias("ts"),
        *position,
    )


def replay_order(messages: DataFrame) -> DataFrame:
    """Messages in event-time order; equal times keep file and line order.

    The file position also breaks ties for the range partitioning of the sort, so a time
    that holds a large share of the events (such as the missing one) spreads over tasks.
    """
    position = [c for c in ("path", "block") if c in messages.columns]
    ordered = messages.withColumn("_line", F.monotonically_increasing_id())
    return ordered.orderBy("ts", *position, "_line").select("key", "value", "topic", "ts")


def trigger_for_speed(slice_seconds: float, speed: float) -> dict:
    """Trigger options that replay slices of event time at ``speed`` times real time.

    Use with ``stream_lines(max_files=...)`` over a folder with that many files per slice;
    speed 0 replays as fast as possible.
    """
    if speed <= 0:
        return {"availableNow": True}
    return {"processingTime": f"{round(slice_seconds * 1000 / speed)} milliseconds"}
