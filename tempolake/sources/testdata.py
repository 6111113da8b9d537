"""Adapters that derive the four raw event tables from the test star schema.

Inner joins only; Spark picks broadcast or shuffle joins from the actual sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolake.functions import utc_date
from tempolake.schemas import AUTH, LISTEN, PAGE_VIEW, STATUS_CHANGE, Topic


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_ms(column: str) -> Column:
    """Epoch milliseconds of a zone-less timestamp; the session zone must be UTC."""
    return F.unix_millis(F.col(column).cast("timestamp"))


def _artist(blank_artist: str) -> Column:
    return (
        F.when(F.col("p_size") == 1, blank_artist)
        .when(F.col("p_size") == 2, F.lit(None))
        .otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" ")))
    )


def _level() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", "paid")
        .when(segment == "MACHINERY", "PAID")
        .when(segment == "HOUSEHOLD", F.lit(None))
        .otherwise("free")
    )


def _gender(user: str) -> Column:
    return F.when(F.col(user) % 2 == 0, "F").otherwise("M")


def _as_bronze(rows: DataFrame, topic: Topic) -> DataFrame:
    dated = rows.withColumn("event_date", utc_date(F.col("ts")))
    return dated.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in topic.bronze_schema.fields]
    )


def star_listens(
    spark: SparkSession, sf_dir: str, blank_artist: str = "  ", task_rows: int | None = None
) -> DataFrame:
    """Raw plays from lineitem: 28 quarters, whole-second lengths.

    ``blank_artist`` is the artist of parts of size 1; the default makes the artist
    not_null check fail on purpose. With ``task_rows`` the plays meet their orders in tasks of
    at most about so many rows, however many plays there are, for work that keeps state per play.
    """
    items = table(spark, sf_dir, "lineitem")
    if task_rows:
        # The count comes from the files' footers.
        tasks = max(-(-items.count() // task_rows), spark.sparkContext.defaultParallelism)
        items = items.repartition(tasks, "l_orderkey")
    plays = (
        items.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    rows = plays.select(
        F.col("o_custkey").alias("userId"),
        F.col("o_orderkey").alias("sessionId"),
        F.col("l_linenumber").alias("itemInSession"),
        _artist(blank_artist).alias("artist"),
        F.col("p_name").alias("song"),
        (F.col("l_quantity") * 10).alias("length"),
        _level().alias("level"),
        (_epoch_ms("l_shipdate") + (F.col("l_orderkey") * 7919 % 86400) * 1000).alias("ts"),
        _gender("o_custkey").alias("gender"),
        F.col("c_name").alias("firstName"),
        F.lit("").alias("lastName"),
        F.col("o_orderpriority").alias("userAgent"),
        F.lit("Logged In").alias("auth"),
        F.lit(0).alias("registration"),
    )
    return _as_bronze(rows, LISTEN)


def _event_base(
    spark: SparkSession, sf_dir: str, blank_artist: str, undated: bool
) -> DataFrame:
    events = table(spark, sf_dir, "events")
    part = table(spark, sf_dir, "part")
    # Every part is some event's song, however many there are.
    parts = part.agg(F.count("*")).scalar()
    joined = (
        events.withColumn("partkey", F.col("event_id") % parts)
        .join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .join(part, F.col("partkey") == F.col("p_partkey"))
    )
    number = F.col("event_id")
    return joined.select(
        F.col("event_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.when(number % 89 != 0, F.col("user_id")).alias("userId"),
        (F.col("user_id") * 100 + F.dayofmonth("ts") + number % 3 * 31).alias("sessionId"),
        (F.col("event_id") % 100).alias("itemInSession"),
        _artist(blank_artist).alias("artist"),
        F.col("p_name").alias("song"),
        F.col("value").alias("length"),
        _level().alias("level"),
        (F.when(number % 97 != 0, _epoch_ms("ts")) if undated else _epoch_ms("ts")).alias("ts"),
        _gender("user_id").alias("gender"),
        F.col("c_name").alias("firstName"),
        F.when(number % 5 == 0, "\tLee\u00a0")
        .when(number % 5 == 1, "\t ")
        .when(number % 5 == 2, F.lit(None))
        .otherwise("")
        .alias("lastName"),
        F.concat(F.lit("browser "), number % 4).alias("userAgent"),
        F.lit("Logged In").alias("auth"),
        (_epoch_ms("ts") - number % 1000 * 86_400_000).alias("registration"),
    )


def event_tables(
    spark: SparkSession, sf_dir: str, blank_artist: str = "  ", undated: bool = False
) -> dict[str, DataFrame]:
    """The four raw tables from events: one month, millisecond timestamps.

    With ``undated`` one event in 97 has no time.
    """
    base = _event_base(spark, sf_dir, blank_artist, undated)
    last_digit = F.col("k") % 10
    # By a list, not by cases: a filter of pages is pushed down to the scan and repeats the
    # expression, with the parsing of ``k`` in it, as often as it names the digit.
    pages = [
        "Error", "Upgrade", " Save Settings ", "  ", "Home", " Help", "About", "Logout",
    ]
    page = F.coalesce(
        F.get(F.array(*map(F.lit, pages)), last_digit.cast("int")), F.lit("NextSong")
    )
    views = base.select(
        "*",
        page.alias("page"),
        F.when(F.col("k") % 2 == 0, "GET").otherwise("PUT").alias("method"),
        F.when(last_digit == 0, 404).otherwise(200).alias("status"),
    )
    signups = base.filter(F.col("event_type") == "signup").withColumn(
        "success", F.col("k") % 4 != 0
    )
    return {
        LISTEN.name: _as_bronze(base.filter(F.col("event_type").isin("click", "view")), LISTEN),
        PAGE_VIEW.name: _as_bronze(views, PAGE_VIEW),
        AUTH.name: _as_bronze(signups, AUTH),
        STATUS_CHANGE.name: _as_bronze(
            base.filter(F.col("event_type") == "purchase"), STATUS_CHANGE
        ),
    }
