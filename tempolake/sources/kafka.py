"""Message-bus source and sink. The connector package must be on the classpath."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolake.schemas import Topic

# Producer settings of a replay. Batches close by size in bytes or after the linger time.
PRODUCER_OPTIONS = {
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "1048576",
}


def source_options(
    brokers: str,
    topic: Topic,
    group_prefix: str | None = None,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options: earliest offsets on first start, later the checkpoint decides.

    ``min_partitions`` splits large bus partitions over several tasks, which is what
    spreads a user who produces a large share of all messages. Spark gives every query a
    consumer group of its own, as queries in one group take messages from each other; for
    brokers that authorise by group name ``group_prefix`` sets it to prefix and topic.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic.bus_topic,
        "startingOffsets": "earliest",
    }
    if group_prefix:
        options["kafka.group.id"] = f"{group_prefix}-{topic.bus_topic}"
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream(spark: SparkSession, brokers: str, topic: Topic, **limits) -> DataFrame:
    options = source_options(brokers, topic, **limits)
    return spark.readStream.format("kafka").options(**options).load()


def batch(spark: SparkSession, brokers: str, topic: Topic) -> DataFrame:
    options = source_options(brokers, topic)
    return spark.read.format("kafka").options(**options).load()


def message_key(user_id: Column) -> Column:
    """Key text of a message: the user id, or an empty string without one."""
    return F.coalesce(user_id.cast("string"), F.lit(""))


def to_messages(rows: DataFrame, topic: Topic) -> DataFrame:
    """(key, value, topic) messages from typed message rows."""
    fields = [F.col(n) for n, _ in topic.fields]
    return rows.select(
        message_key(F.col("userId")).alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.lit(topic.bus_topic).alias("topic"),
    )


def write_messages(messages: DataFrame, brokers: str) -> None:
    """Send (key, value, topic) rows; the topic column routes each row."""
    (
        messages.select("key", "value", "topic")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .options(**PRODUCER_OPTIONS)
        .save()
    )
