"""Lenient decoding of newline-JSON messages into typed raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolake.functions import event_time, trim_all, utc_date, valid_ms
from tempolake.schemas import Topic

WATERMARK_DELAY = "30 seconds"
_CORRUPT = "_corrupt_record"


def not_blank(lines: DataFrame) -> DataFrame:
    """Drop NULL and blank lines, which a JSON parser would turn into empty rows."""
    return lines.filter(trim_all(F.col("value")) != "")


def parse_object(value: Column, names: list[str]) -> Column:
    """Struct of the named fields as text, plus the line itself when it is not an object.

    Reading every field as text keeps one bad field from marking the whole row corrupt.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    return F.from_json(value, schema, {"columnNameOfCorruptRecord": _CORRUPT})


def _typed(text: Column, kind: T.DataType) -> Column:
    """One field from its text: NULL when it does not fit the type."""
    if isinstance(kind, (T.IntegerType, T.LongType)):
        # A fractional number is truncated, as a typed JSON reader does. A string that holds
        # a number is read like that number: fields are read as text, which hides the quotes.
        whole = text.try_cast(kind)
        return F.coalesce(whole, text.try_cast("double").try_cast(kind))
    if isinstance(kind, T.BooleanType):
        return F.lower(trim_all(text)) == "true"
    if isinstance(kind, T.DoubleType):
        # NaN and infinities are no lengths or the like.
        number = text.try_cast(kind)
        return F.when((F.abs(number) < float("inf")) & ~F.isnan(number), number)
    return text.try_cast(kind)


def decode(lines: DataFrame, topic: Topic, counts: Observation | None = None) -> DataFrame:
    """Typed message fields of a (streaming or batch) DataFrame with a ``value`` column.

    Blank and unparsable lines are skipped, a field of the wrong type becomes NULL. The
    counts of lines read, malformed lines and rows without a usable time are observed
    under the topic's name, so they show up in the query progress, or by ``counts``. (Observing
    between parse and filter also keeps the filter from parsing every line a second time.)
    """
    names = [n for n, _ in topic.fields]
    text = F.col("value").cast("string").alias("value")
    parsed = not_blank(lines.select(text)).select(
        parse_object(F.col("value"), names).alias("_row")
    )
    corrupt = F.col(f"_row.{_CORRUPT}").isNotNull() | F.col("_row").isNull()
    ts = _typed(F.col("_row.ts"), T.LongType())
    counted = parsed.observe(
        counts or topic.name,
        F.count("*").alias("lines"),
        F.count_if(corrupt).alias("malformed"),
        F.count_if(~corrupt & valid_ms(ts).isNull()).alias("rejected"),
    )
    return counted.filter(~corrupt).select(
        *[_typed(F.col(f"_row.{f.name}"), f.dataType).alias(f.name) for f in topic.message_schema]
    )


def to_bronze(
    messages: DataFrame, topic: Topic, watermark: str | None = None, once: bool = False
) -> DataFrame:
    """Raw-table columns, in order, with the UTC ``event_date`` of the event time.

    A message without a usable ``ts`` keeps a NULL date: the sink files it under the NULL
    partition, the rejects. ``watermark`` declares the event-time watermark. Without ``once``
    the job holds no state, so no late row is ever dropped.

    With ``once`` an event that comes again within the watermark's delay is dropped: equal
    events meet at a hash of all their fields, which is all the state holds, until the watermark
    passes their time. Events older than the watermark are dropped, too (the query progress
    counts them); rejects have no time to forget them by and all stay.
    """
    ts = valid_ms(F.col("ts"))
    rows = messages.withColumn("event_time", event_time(ts)).withColumn(
        "event_date", utc_date(ts)
    )
    renamed = rows.withColumnsRenamed(dict(topic.renames))
    if once:
        return _once(renamed, topic, watermark or WATERMARK_DELAY)
    if watermark:
        renamed = renamed.withWatermark("event_time", watermark)
    return renamed.select(*topic.bronze_columns)


def _once(rows: DataFrame, topic: Topic, watermark: str) -> DataFrame:
    fields = F.to_json(F.struct(*topic.bronze_columns))
    dated = (
        rows.filter(F.col("event_time").isNotNull())
        .withWatermark("event_time", watermark)
        .withColumn("_event", F.unhex(F.sha2(fields, 256)))
        .dropDuplicatesWithinWatermark(["_event"])
    )
    undated = rows.filter(F.col("event_time").isNull())
    return dated.select(*topic.bronze_columns).union(undated.select(*topic.bronze_columns))
