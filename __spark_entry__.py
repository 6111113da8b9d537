"""

Every query reads whole test tables through the adapters in ``tempolake.sources.testdata``.
The streaming and flow queries write to a fresh folder below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import oracles
from tempolake import Pipeline, Warehouse, functions, require_utc
from tempolake.operators import gold, quality, ranking, sets, silver
from tempolake.operators.intervals import join_ranges
from tempolake.schemas import AUTH, LISTEN, PAGE_VIEW, STATUS_CHANGE, TOPICS, Topic
from tempolake.plans.buckets import store_bucketed
from tempolake.plans.wap import ChangedDays
from tempolake.session import scratch_dir
from tempolake.sources import bronze, files, kafka, testdata
from tempolake.streaming.decode import decode
from tempolake.streaming import replay, windows
from tempolake.streaming.ingest import await_all, start_all, start_counted_ingest, start_ingest

try:
    import corpus_pipeline
    from tempolake.llm import queries as llm_queries
except ImportError as missing:
    # Only the optional subpackage itself may be missing.
    if missing.name not in ("corpus_pipeline", "tempolake.llm"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

BACKFILL = {"availableNow": True}

#: Plays per task that are joined and put into sets: a task holds nearly one set per play.
SET_ROWS = 1_000_000


# -- inputs ------------------------------------------------------------------------------


def _star_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_listen_events(testdata.star_listens(spark, sf_dir))


def _event_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _silver_of(testdata.event_tables(spark, sf_dir))


def _silver_of(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "silver_listen_events": silver.silver_listen_events(raw[LISTEN.name]),
        "silver_page_view_events": silver.silver_page_view_events(raw[PAGE_VIEW.name]),
        "silver_auth_events": silver.silver_auth_events(raw[AUTH.name]),
        "silver_status_change_events": silver.silver_status_change_events(
            raw[STATUS_CHANGE.name]
        ),
    }


def _stored_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver tables as the flow stores them, so that gold does not derive them again."""
    warehouse = Warehouse(spark, scratch_dir(spark, "silver"))
    run = Pipeline(warehouse, testdata.event_tables(spark, sf_dir))
    run.write_silver()
    run.publish_silver()
    return warehouse.read_all("silver", warehouse.published("silver"))


def _gold_of(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    listens = tables["silver_listen_events"]
    return {
        "gold_daily_listening_stats": gold.daily_listening_stats(listens),
        "gold_top_artists_daily": gold.top_artists_daily(listens),
        "gold_top_songs_daily": gold.top_songs_daily(listens),
        "gold_hourly_listening_heatmap": gold.hourly_listening_heatmap(listens),
        "gold_user_activity_daily": gold.user_activity_daily(
            listens,
            tables["silver_page_view_events"],
            tables["silver_status_change_events"],
        ),
        "gold_qoq_listener_growth": gold.qoq_listener_growth(listens),
    }


def _event_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _gold_of(_event_silver(spark, sf_dir))


def _messages(raw: DataFrame, topic: Topic) -> DataFrame:
    """Raw rows under their message field names."""
    message_names = {new: old for old, new in topic.renames}
    return raw.withColumnsRenamed(message_names).select(*[n for n, _ in topic.fields])


def _write_lines(messages: DataFrame, folder: str) -> None:
    messages.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(folder)


# -- silver and gold ---------------------------------------------------------------------


def _star_model(model: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: model(_star_silver(spark, sf_dir))


def _top(model: Callable[..., DataFrame], n: int) -> Query:
    return _star_model(lambda silver: ranking.top_n(model(silver, n), n))


def _stored_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listeners of every hour, stored; queries of them don't read plays."""
    path = f"{scratch_dir(spark, 'sets')}/listener_sets"
    plays = testdata.star_listens(spark, sf_dir, task_rows=SET_ROWS)
    sets.listener_sets(silver.silver_listen_events(plays)).write.parquet(path)
    return spark.read.parquet(path)


def _qoq_from_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.qoq_growth_of_sets(_stored_sets(spark, sf_dir))


def _listeners_from_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different listeners per day, per cell of the heatmap and per year."""
    stored = _stored_sets(spark, sf_dir)
    weekday = functions.day_of_week(F.col("event_date")).alias("day_of_week")
    spans = {
        "day": ["event_date"],
        "cell": [weekday, "hour_of_day"],
        "year": [F.year("event_date").alias("year")],
    }
    parts = []
    for span, keys in spans.items():
        counted = sets.count_members(stored, keys, "unique_listeners")
        names = counted.columns[:-1]
        key = F.concat_ws(" ", *[F.col(c).cast("string") for c in names])
        parts.append(counted.select(F.lit(span).alias("span"), key.alias("key"), "unique_listeners"))
    return reduce(DataFrame.unionByName, parts)


def _cohort_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and days per cohort and quarter, clipped to the span of each user's orders."""
    spans = (
        testdata.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").cast("int").alias("userId"))
        .agg(
            F.to_date(F.min("o_orderdate")).alias("start"),
            F.to_date(F.max("o_orderdate")).alias("end"),
        )
    )
    calendar = functions.quarter_ranges(F.col("start"), F.col("end"))
    ranges = spans.select("userId", F.inline(calendar))
    plays = testdata.star_listens(spark, sf_dir).select("userId", "event_date")
    labelled = join_ranges(plays, ranges, "event_date", "range_start", "range_end", ["userId"])
    cohort = functions.cohort(F.col("userId"), control_users=700).alias("cohort")
    return labelled.groupBy(cohort, "label").agg(
        F.count("*").alias("plays"),
        F.count_distinct("userId").alias("users"),
        F.min("event_date").alias("first_day"),
        F.max("event_date").alias("last_day"),
    )


def _undated_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _silver_of(testdata.event_tables(spark, sf_dir, undated=True))


def _undated_gold(name: str) -> Query:
    return lambda spark, sf_dir: _gold_of(_undated_silver(spark, sf_dir))[name]


def _event_model(name: str) -> Query:
    return lambda spark, sf_dir: _event_silver(spark, sf_dir)[name]


def _event_gold_model(name: str) -> Query:
    return lambda spark, sf_dir: _event_gold(spark, sf_dir)[name]


def _user_activity_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User activity over silver tables stored in buckets by day and user."""
    tables = _event_silver(spark, sf_dir)
    names = ("silver_listen_events", "silver_page_view_events", "silver_status_change_events")
    folder = scratch_dir(spark, "buckets")
    stored = store_bucketed(
        {name: tables[name] for name in names},
        "bucketed_" + folder[-8:],
        folder,
        spark.sparkContext.defaultParallelism,
    )
    return gold.user_activity_daily(*[stored[name] for name in names], co_located=True)


def _layer_creation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers created twice: those there are, and the rows that SQL finds in the silver one."""
    warehouse = Warehouse(spark, scratch_dir(spark, "layers"))
    run = Pipeline(warehouse, testdata.event_tables(spark, sf_dir))
    run.write_silver("silver_auth_events")
    run.publish_silver()
    for _ in range(2):
        warehouse.create_layers()
        warehouse.create_views("silver")
    there = {database.name for database in spark.catalog.listDatabases()}
    rows = spark.sql("SELECT count(*) FROM silver.silver_auth_events").first()[0]
    spark.sql("DROP VIEW silver.silver_auth_events")
    found = [(n, n in there, rows if n == "silver" else 0) for n in ("bronze", "silver", "gold")]
    return spark.createDataFrame(found, "layer string, created boolean, rows bigint")


def _pipeline_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = gold.pipeline_status(_gold_of(_stored_silver(spark, sf_dir)))
    return status.drop("refreshed_at")


# -- checks ------------------------------------------------------------------------------


def _dq_silver_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit(_event_silver(spark, sf_dir), quality.SILVER_CHECKS)


def _dq_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver audit, counted while the tables are written."""
    run = Pipeline(Warehouse(spark, scratch_dir(spark, "observed")), testdata.event_tables(spark, sf_dir))
    run.write_silver()
    results = run.audited("silver", "silver_staging", quality.SILVER_CHECKS)
    names = ("table", "column", "test", "failures")
    rows = [tuple(r[n] for n in names) for r in results]
    return spark.createDataFrame(rows, "table string, column string, test string, failures bigint")


def _dq_gold_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit(_gold_of(_stored_silver(spark, sf_dir)), quality.GOLD_CHECKS)


def _dq_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver audit over raw tables some of whose rows have no time."""
    return quality.audit(_undated_silver(spark, sf_dir), quality.SILVER_CHECKS)


def _dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(_star_silver(spark, sf_dir), ["user_id", "artist", "is_paid"])


def _dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(_event_silver(spark, sf_dir)["silver_auth_events"], "session_id")


def _dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values(
        testdata.star_listens(spark, sf_dir), "level", ["paid", "free"]
    )


# -- expressions -------------------------------------------------------------------------


def _page_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = _event_silver(spark, sf_dir)["silver_page_view_events"]
    return views.groupBy("page").agg(F.count("*").alias("views"))


def _blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    artist = functions.clean_text(F.col("artist")).alias("artist")
    return testdata.star_listens(spark, sf_dir).groupBy(artist).agg(F.count("*").alias("plays"))


def _paid_case_quirk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star_silver(spark, sf_dir).groupBy("level", "is_paid").agg(F.count("*").alias("plays"))


def _change_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _event_silver(spark, sf_dir)["silver_status_change_events"]
    return changes.groupBy("change_category").agg(F.count("*").alias("changes"))


def _week_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = testdata.table(spark, sf_dir, "lineitem").groupBy(
        F.to_date("l_shipdate").alias("ship_date")
    )
    counted = days.agg(F.count("*").alias("lines"))
    return counted.withColumn("week_of_year", functions.week_of_year(F.col("ship_date")))


def _time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    date = functions.utc_date(F.col("ms"))
    return (
        testdata.table(spark, sf_dir, "events")
        .select("event_id", ms.alias("ms"))
        .select(
            "event_id",
            functions.event_time(F.col("ms")).alias("event_timestamp"),
            date.alias("event_date"),
            functions.utc_hour(F.col("ms")).alias("hour_of_day"),
            functions.day_of_week(date).alias("day_of_week"),
            functions.quarter_start(date).alias("quarter_start"),
            functions.quarter_label(date).alias("quarter_label"),
        )
    )


def _quarter_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = (
        testdata.table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.to_date(F.min("o_orderdate")).alias("start"),
            F.to_date(F.max("o_orderdate")).alias("end"),
        )
    )
    ranges = functions.quarter_ranges(F.col("start"), F.col("end"))
    return spans.select("o_custkey", F.inline(ranges))


def _cohort_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort = functions.cohort(F.col("userId"), control_users=700).alias("cohort")
    return (
        testdata.star_listens(spark, sf_dir)
        .groupBy(cohort, "event_date")
        .agg(F.count("*").alias("plays"), F.count_distinct("userId").alias("users"))
    )


# -- sources, replay and streaming -------------------------------------------------------


def _json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode ``props`` with the event id spliced into each object."""
    topic = Topic(
        "props", (("event_id", "bigint"), ("k", "int"), ("ts", "bigint")), ("event_id", "k")
    )
    prefix = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", "))
    lines = testdata.table(spark, sf_dir, "events").select(
        F.concat(prefix, F.expr("substring(props, 2)")).alias("value")
    )
    return decode(lines, topic).select("event_id", "k")


def _message_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.event_tables(spark, sf_dir)[PAGE_VIEW.name]
    messages = kafka.to_messages(_messages(raw, PAGE_VIEW), PAGE_VIEW)
    payload = F.from_json("value", "ts bigint, page string, artist string, duration double")
    return messages.select("key", "topic", payload.alias("p")).select("key", "topic", "p.*")


def _replay_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the four topics as JSON lines, then read them back as one ordered stream."""
    folder = scratch_dir(spark, "replay")
    raw = testdata.event_tables(spark, sf_dir)
    for name, topic in TOPICS.items():
        _write_lines(_messages(raw[name], topic), f"{folder}/2024_Q1_control.json/{name}")
    messages = files.replay_messages(files.topic_lines(spark, folder))
    return files.replay_order(messages).select("key", "topic", "ts")


def _stream_ingest(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        topic = TOPICS[name]
        folder = scratch_dir(spark, "ingest")
        raw = testdata.event_tables(spark, sf_dir)[name]
        _write_lines(_messages(raw, topic), f"{folder}/lines")
        table = bronze.FileSinkTable(spark, f"{folder}/bronze", topic)
        lines = files.stream_lines(spark, f"{folder}/lines")
        start_ingest(lines, table, f"{folder}/checkpoint", BACKFILL).awaitTermination()
        return table.read()

    return query


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without a time end up among the rejects, the others in the table."""
    folder = scratch_dir(spark, "rejects")
    raw = testdata.event_tables(spark, sf_dir)[AUTH.name]
    untimed = raw.withColumn("ts", F.when(F.col("gender") != "F", F.col("ts")))
    _write_lines(_messages(untimed, AUTH), f"{folder}/lines")
    table = bronze.FileSinkTable(spark, f"{folder}/bronze", AUTH)
    lines = files.stream_lines(spark, f"{folder}/lines")
    start_ingest(lines, table, f"{folder}/checkpoint", BACKFILL).awaitTermination()
    kept = table.dated().withColumn("rejected", F.lit(False))
    rejected = table.rejects().withColumn("rejected", F.lit(True))
    return (
        kept.unionByName(rejected)
        .groupBy("rejected")
        .agg(F.count("*").alias("rows"), F.count_distinct("userId").alias("users"))
    )


def _presented_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heatmap's cells with their position in the order it is presented in."""
    name = "gold_hourly_listening_heatmap"
    cells = gold.presented(name, gold.hourly_listening_heatmap(_star_silver(spark, sf_dir)))
    placed = cells.withColumn("_at", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("_at")).cast("bigint")
    return placed.select("day_of_week", "hour_of_day", position.alias("position"))


def _with_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value): one good line per event, or one of several kinds of bad ones."""
    number = F.col("event_id")
    name = number.cast("string")
    good = F.concat(
        F.lit('{"event_id": '), name, F.lit(', "k": '), name, F.lit(', "ts": '), name,
        F.lit(', "userId": '), name, F.lit("}"),
    )
    kind = number % 11
    value = (
        F.when(kind == 1, "  \t ")
        .when(kind == 2, F.concat(good, F.lit("}}}"), good))
        .when(kind == 3, F.substring_index(good, ",", 2))
        .when(kind == 4, F.replace(good, F.lit('"k": '), F.lit('"k": "x')))
        .when(kind == 5, F.concat(F.lit("\t \u00a0"), good, F.lit(" ")))
        .when(kind == 6, "[1, 2]")
        .when(kind == 7, F.concat(good, good))
        .otherwise(good)
    )
    return testdata.table(spark, sf_dir, "events").select("event_id", value.alias("value"))


_BAD_TOPIC = Topic("bad", (("event_id", "bigint"), ("k", "int"), ("ts", "bigint")), ("event_id",))


def _json_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all kinds of lines: the first of several objects counts, an array does not."""
    lines = _with_bad_lines(spark, sf_dir)
    return decode(lines.select("value"), _BAD_TOPIC).select("event_id", "k")


def _json_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines decoded: the first of several objects; an array is no object and is skipped."""
    lines = _with_bad_lines(spark, sf_dir)
    return decode(lines.select("value"), _BAD_TOPIC).select("event_id", "k")


def _replay_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _with_bad_lines(spark, sf_dir).withColumn("topic", F.lit(AUTH.name))
    return files.replay_messages(lines).select("key", "topic", "ts", "value")


def _replay_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many replayed messages there are, and how many stand after a later one."""
    folder = scratch_dir(spark, "order")
    raw = testdata.event_tables(spark, sf_dir, undated=True)
    for name, topic in TOPICS.items():
        _write_lines(_messages(raw[name], topic), f"{folder}/lines/{name}")
    messages = files.replay_messages(files.topic_lines(spark, f"{folder}/lines"))
    files.replay_order(messages).write.parquet(f"{folder}/ordered")
    stored = spark.read.parquet(f"{folder}/ordered")
    # Files are numbered in order and rows keep theirs within a file.
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    rows = stored.select("ts", part.alias("part"), F.monotonically_increasing_id().alias("at"))
    within = Window.partitionBy("part").orderBy("at")
    inside = (
        rows.withColumn("late", F.col("ts") < F.lag("ts").over(within))
        .groupBy("part")
        .agg(
            F.count("*").alias("messages"),
            F.count_if("late").alias("late"),
            F.min("ts").alias("low"),
            F.max("ts").alias("high"),
        )
    )
    across = Window.orderBy("part")
    return inside.withColumn("early", F.col("low") < F.lag("high").over(across)).agg(
        F.sum("messages").alias("messages"),
        (F.sum("late") + F.count_if("early")).alias("out_of_order"),
    )


def _stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four queries over one folder, stopped and started again: rows after each run."""
    folder = scratch_dir(spark, "restart")
    raw = testdata.event_tables(spark, sf_dir)
    later = F.col("event_date") >= F.lit("2024-01-16").cast("date")
    counts = []
    for run, part in ((1, later), (2, ~later)):
        for name, topic in TOPICS.items():
            _write_lines(_messages(raw[name].filter(part), topic), f"{folder}/lines/{name}")
        queries = start_all(
            spark,
            lambda topic: files.stream_lines(spark, f"{folder}/lines", topic),
            f"{folder}/bronze",
            f"{folder}/checkpoint",
            trigger=BACKFILL,
        )
        await_all(queries)
        for name, topic in TOPICS.items():
            rows = bronze.FileSinkTable(spark, f"{folder}/bronze", topic).read().count()
            counts.append((run, name, rows))
    return spark.createDataFrame(counts, "run int, table_name string, rows bigint")


DAY_MS = 86_400_000


def _staged(spark: SparkSession, sf_dir: str, topic: Topic, folder: str, days: int) -> str:
    """A topic's messages stored in slices of some days of event time."""
    messages = _messages(testdata.event_tables(spark, sf_dir)[topic.name], topic).select(
        kafka.message_key(F.col("userId")).alias("key"),
        F.to_json(F.struct("*")).alias("value"),
        F.lit(topic.bus_topic).alias("topic"),
        "ts",
    )
    replay.stage_slices(messages, f"{folder}/staged", days * DAY_MS)
    return f"{folder}/staged"


def _sent_twice(spark: SparkSession, staged: str, folder: str) -> replay.Send:
    """Sends each slice, and then the one before it once more."""
    deliver = replay.to_files(folder)

    def send(messages: DataFrame, number: int) -> None:
        deliver(messages, number)
        deliver(replay.read_slice(spark, staged, number - 1), number)

    return send


def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views of which all but the last days' come twice, over several triggers."""
    folder = scratch_dir(spark, "dedup")
    staged = _staged(spark, sf_dir, PAGE_VIEW, folder, 11)
    replay.replay(spark, staged, _sent_twice(spark, staged, f"{folder}/lines"), 11 * DAY_MS)
    table = bronze.FileSinkTable(spark, f"{folder}/bronze", PAGE_VIEW)
    start_ingest(
        files.stream_lines(spark, f"{folder}/lines", max_files=12),
        table,
        f"{folder}/checkpoint",
        BACKFILL,
        once="23 days",
        state_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return table.read()


def _stream_dedup_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, stopped after every second slice: what the state forgot would come twice."""
    folder = scratch_dir(spark, "dedup")
    staged = _staged(spark, sf_dir, AUTH, folder, 8)
    table = bronze.FileSinkTable(spark, f"{folder}/bronze", AUTH)
    deliver, counts = _sent_twice(spark, staged, f"{folder}/lines"), []

    def send(messages: DataFrame, number: int) -> None:
        deliver(messages, number)
        if number % 2 == 1:
            run()

    def run() -> None:
        start_ingest(
            files.stream_lines(spark, f"{folder}/lines"),
            table,
            f"{folder}/checkpoint",
            BACKFILL,
            once="17 days",
            state_partitions=spark.sparkContext.defaultParallelism,
        ).awaitTermination()
        rows = table.read()
        counts.append((len(counts) + 1, rows.count(), rows.distinct().count()))

    replay.replay(spark, staged, send, 8 * DAY_MS)
    return spark.createDataFrame(counts, "run int, rows bigint, different bigint")


def _ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lasting counts after two runs over good and bad lines."""
    folder = scratch_dir(spark, "counts")
    lines = _with_bad_lines(spark, sf_dir)
    half = lines.agg(F.floor(F.max("event_id") / 2)).scalar()
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        lines.filter(part).select("value").write.mode("append").text(f"{folder}/lines")
        table = bronze.BatchTable(spark, f"{folder}/bronze", AUTH)
        source = files.stream_lines(spark, f"{folder}/lines")
        start_counted_ingest(source, table, f"{folder}/checkpoint", BACKFILL).awaitTermination()
    return bronze.BatchTable(spark, f"{folder}/bronze", AUTH).totals()


def _paced_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays replayed in slices of eight days, a trigger each: the times of every batch."""
    folder = scratch_dir(spark, "paced")
    staged = _staged(spark, sf_dir, LISTEN, folder, 8)
    table = bronze.BatchTable(spark, f"{folder}/bronze", LISTEN)
    deliver = replay.to_files(f"{folder}/lines")

    def send(messages: DataFrame, number: int) -> None:
        deliver(messages, number)
        source = files.stream_lines(spark, f"{folder}/lines")
        start_counted_ingest(source, table, f"{folder}/checkpoint", BACKFILL).awaitTermination()

    replay.replay(spark, staged, send, 8 * DAY_MS)
    times = table.batches().groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    before = F.lag("last_ts").over(Window.orderBy("batch_id"))
    return times.withColumn("overlaps", F.coalesce(F.col("first_ts") <= before, F.lit(False)))


def _figures(
    spark: SparkSession,
    sf_dir: str,
    topic: Topic,
    figures: Callable[[DataFrame], DataFrame],
    columns: str,
) -> DataFrame:
    """Final figures after messages came in two halves of a month, each in a run of its own."""
    folder = scratch_dir(spark, "figures")
    staged = _staged(spark, sf_dir, topic, folder, 16)
    deliver = replay.to_files(f"{folder}/lines")

    def send(messages: DataFrame, number: int) -> None:
        deliver(messages, number)
        lines = files.stream_lines(spark, f"{folder}/lines")
        windows.start_figures(
            figures(decode(lines, topic)),
            f"{folder}/figures",
            f"{folder}/checkpoint",
            BACKFILL,
            spark.sparkContext.defaultParallelism,
        ).awaitTermination()

    replay.replay(spark, staged, send, 16 * DAY_MS)
    return spark.read.schema(columns).parquet(f"{folder}/figures")


def _stream_top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The songs that rank third or better in each finished window of two days, daily."""
    counted = _figures(
        spark,
        sf_dir,
        LISTEN,
        lambda plays: windows.plays_per_window(plays, ["song"], "2 days", "1 day", "1 day"),
        "window_start timestamp, window_end timestamp, song string, plays bigint",
    )
    ranked = ranking.rank_by_count(
        counted, counted.select("window_start", "plays"), "window_start", "plays", "song_rank"
    )
    return ranking.top_n(ranked, 3, "song_rank").select(
        "window_start", "window_end", "song", "plays", "song_rank"
    )


def _stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished sessions of page views: a user's views less than twelve hours apart."""
    return _figures(
        spark,
        sf_dir,
        PAGE_VIEW,
        lambda views: windows.user_sessions(views, "12 hours", delay="1 hour"),
        "session_start timestamp, last_event timestamp, userId int, events bigint",
    )


def _ingested(
    spark: SparkSession, folder: str, rows: dict[str, DataFrame]
) -> dict[str, bronze.BatchTable]:
    """Raw tables with a ledger after one more batch of ``rows``.

    The topics don't depend on each other: they come in at the same time, so that the tail of one
    does not idle the cluster.
    """

    def brought(name: str) -> bronze.BatchTable:
        topic = TOPICS[name]
        _write_lines(_messages(rows[name], topic), f"{folder}/lines/{name}")
        table = bronze.BatchTable(spark, f"{folder}/bronze", topic)
        source = files.stream_lines(spark, f"{folder}/lines/{name}")
        start_counted_ingest(source, table, f"{folder}/checkpoint", BACKFILL).awaitTermination()
        return table

    with ThreadPoolExecutor(len(rows)) as pool:
        return dict(zip(rows, pool.map(brought, rows), strict=True))


def _after_late_events(
    spark: SparkSession, sf_dir: str, topics: list[Topic], steps: Callable[[ChangedDays], object]
) -> tuple[Warehouse, ChangedDays]:
    """A full run, and one after late events of women on two days came in."""
    folder = scratch_dir(spark, "changed")
    events = testdata.event_tables(spark, sf_dir, blank_artist="Indie")
    raw = {topic.name: events[topic.name] for topic in topics}
    two_days = F.col("event_date").isin("2024-01-10", "2024-01-20")
    late = two_days & (F.col("gender") == "F")
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    for part in (~late, late):
        tables = _ingested(spark, folder, {name: rows.filter(part) for name, rows in raw.items()})
        run = ChangedDays(warehouse, tables)
        steps(run)
    return warehouse, run


def _changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User activity after late events, and whether a row's file is of the second run."""
    topics = [LISTEN, PAGE_VIEW, STATUS_CHANGE]

    def steps(run: ChangedDays) -> None:
        run.write_silver(*[f"silver_{topic.name}" for topic in topics])
        run.audit_silver()
        run.publish_silver()
        run.build_gold("gold_user_activity_daily")

    warehouse, run = _after_late_events(spark, sf_dir, topics, steps)
    rows = warehouse.read("gold", "gold_user_activity_daily", origin="file")
    rebuilt = F.col("file").contains(f"run_id={run.run_id}/").alias("rebuilt")
    return rows.select(*[c for c in rows.columns if c != "file"], rebuilt)


def _changed_days_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table after late events, and how many the second run wrote."""
    warehouse, run = _after_late_events(spark, sf_dir, list(TOPICS.values()), ChangedDays.run)
    parts = []
    for layer in ("silver", "gold"):
        tables = warehouse.read_all(layer, warehouse.published(layer), origin="file")
        for name, rows in tables.items():
            new = F.count_if(F.col("file").contains(f"run_id={run.run_id}/")).alias("new_rows")
            counts = rows.agg(F.count("*").alias("rows"), new)
            parts.append(counts.select(F.lit(name).alias("table_name"), "rows", "new_rows"))
    return reduce(DataFrame.unionByName, parts)


def _bronze_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    listens = _event_silver(spark, sf_dir)["silver_listen_events"]
    days = bronze.between(listens, "2024-01-10", "2024-01-12")
    return days.groupBy("event_date").agg(F.count("*").alias("plays"))


def _silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole plays, one per user and session; plays without an artist don't count."""
    raw = testdata.event_tables(spark, sf_dir)[LISTEN.name]
    return silver.silver_listen_events(raw, dedup_keys=["userId", "sessionId"])


def _wap_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full write-audit-publish run; the row counts of everything it published."""
    warehouse = Warehouse(spark, scratch_dir(spark, "wap"))
    raw = testdata.event_tables(spark, sf_dir, blank_artist="Indie")
    Pipeline(warehouse, raw).run()
    status = warehouse.read("status", "gold_pipeline_status").drop("refreshed_at")
    cleaned = warehouse.read_all("silver", warehouse.published("silver"))
    counts = [
        rows.agg(F.count("*").alias("rows_loaded")).select(
            F.lit(name).alias("table_name"), F.lit(True).alias("is_ready"), "rows_loaded"
        )
        for name, rows in cleaned.items()
    ]
    return reduce(DataFrame.unionByName, [status, *counts])


def _wap_empty_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run on a day without subscription changes; rows and columns of every silver table."""
    warehouse = Warehouse(spark, scratch_dir(spark, "empty"))
    raw = testdata.event_tables(spark, sf_dir, blank_artist="Indie")
    raw[STATUS_CHANGE.name] = raw[STATUS_CHANGE.name].filter(F.lit(False))
    Pipeline(warehouse, raw).run()
    tables = warehouse.read_all("silver", warehouse.published("silver"))
    counts = [
        rows.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(rows.columns)).alias("columns"), "rows"
        )
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _status_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One refresh time for all tables, none missing, all ready, and the time readers get."""
    warehouse = Warehouse(spark, scratch_dir(spark, "status"))
    raw = testdata.event_tables(spark, sf_dir, blank_artist="Indie")
    Pipeline(warehouse, raw).run()
    status = warehouse.read("status", "gold_pipeline_status")
    refreshed = gold.last_refresh(status)
    return status.crossJoin(refreshed).agg(
        F.count("*").alias("tables"),
        F.count_distinct("refreshed_at").alias("refresh_times"),
        F.count_if(F.col("refreshed_at").isNull()).alias("missing"),
        F.count_if("is_ready").alias("ready"),
        F.count_if(F.col("refreshed_at") == F.col("last_refreshed_at")).alias("as_read"),
        F.sum("rows_loaded").alias("rows_loaded"),
    )


def _counts_of(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _selected_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of one silver and one gold model; what was published."""
    warehouse = Warehouse(spark, scratch_dir(spark, "selected"))
    run = Pipeline(warehouse, testdata.event_tables(spark, sf_dir, blank_artist="Indie"))
    run.write_silver("silver_listen_events")
    run.audit_silver()
    run.publish_silver()
    run.build_gold("gold_hourly_listening_heatmap")
    tables = {
        name: rows
        for layer in ("silver", "gold")
        for name, rows in warehouse.read_all(layer, warehouse.published(layer)).items()
    }
    return _counts_of(tables)


def _republish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current auth rows after runs 10 and 20 and run 10 published again."""
    warehouse = Warehouse(spark, scratch_dir(spark, "republish"))
    raw = testdata.event_tables(spark, sf_dir)
    table, counts = "silver_auth_events", {}
    for step, run_id in enumerate((10, 20, 10)):
        if step < 2:
            part = raw[AUTH.name].filter((F.col("gender") == "F") | F.lit(run_id == 20))
            run = Pipeline(warehouse, {AUTH.name: part}, run_id=run_id)
            run.write_silver(table)
        warehouse.publish("silver", run_id, [table], "silver_staging")
        counts[f"step {step + 1}"] = warehouse.read("silver", table)
    return _counts_of(counts)


def _table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table, copied over another run's: whole rows."""
    warehouse = Warehouse(spark, scratch_dir(spark, "copy"))
    table = "silver_status_change_events"
    raw = testdata.event_tables(spark, sf_dir)
    for run_id, part in ((1, F.lit(True)), (2, F.col("gender") == "F")):
        rows = {STATUS_CHANGE.name: raw[STATUS_CHANGE.name].filter(part)}
        Pipeline(warehouse, rows, run_id=run_id).write_silver(table)
    warehouse.copy(("silver_staging", 1, table), ("silver_staging", 2, table))
    return warehouse.read_run("silver_staging", 2, table)


def _registered() -> dict[str, Query]:
    return {
        "silver_listen_events": _star_silver,
        "silver_page_view_events": _event_model("silver_page_view_events"),
        "silver_auth_events": _event_model("silver_auth_events"),
        "silver_status_change_events": _event_model("silver_status_change_events"),
        "daily_listening_stats": _star_model(gold.daily_listening_stats),
        "top_artists_daily": _star_model(gold.top_artists_daily),
        "top_songs_daily": _star_model(gold.top_songs_daily),
        "top_artists_top3": _top(gold.top_artists_daily, 3),
        "top_songs_top10": _top(gold.top_songs_daily, 10),
        "hourly_listening_heatmap": _star_model(gold.hourly_listening_heatmap),
        "qoq_listener_growth": _star_model(gold.qoq_listener_growth),
        "daily_listening_stats_events": _event_gold_model("gold_daily_listening_stats"),
        "top_artists_daily_events": _event_gold_model("gold_top_artists_daily"),
        "top_songs_daily_events": _event_gold_model("gold_top_songs_daily"),
        "user_activity_daily": _event_gold_model("gold_user_activity_daily"),
        "pipeline_status": _pipeline_status,
        "dq_silver_audit": _dq_silver_audit,
        "dq_gold_audit": _dq_gold_audit,
        "dq_not_null": _dq_not_null,
        "dq_unique": _dq_unique,
        "dq_accepted_values": _dq_accepted_values,
        "page_exclusion": _page_exclusion,
        "blank_to_null": _blank_to_null,
        "paid_case_quirk": _paid_case_quirk,
        "change_category": _change_category,
        "week_of_year": _week_of_year,
        "time_parts": _time_parts,
        "quarter_calendar": _quarter_calendar,
        "cohort_split": _cohort_split,
        "json_decode": _json_decode,
        "message_encode": _message_encode,
        "replay_messages": _replay_messages,
        **{f"stream_ingest_{name}": _stream_ingest(name) for name in TOPICS},
        "stream_rejects": _stream_rejects,
        "stream_dedup": _stream_dedup,
        "stream_dedup_restart": _stream_dedup_restart,
        "stream_top_songs": _stream_top_songs,
        "stream_sessions": _stream_sessions,
        "ingest_counts": _ingest_counts,
        "paced_replay": _paced_replay,
        "changed_days": _changed_days,
        "changed_days_tables": _changed_days_tables,
        "qoq_from_sets": _qoq_from_sets,
        "listeners_from_sets": _listeners_from_sets,
        "cohort_quarters": _cohort_quarters,
        "user_activity_bucketed": _user_activity_bucketed,
        "dq_observed": _dq_observed,
        "layer_creation": _layer_creation,
        "bronze_between": _bronze_between,
        "silver_dedup": _silver_dedup,
        "wap_run": _wap_run,
        "undated_daily": _undated_gold("gold_daily_listening_stats"),
        "undated_artists": _undated_gold("gold_top_artists_daily"),
        "undated_songs": _undated_gold("gold_top_songs_daily"),
        "undated_activity": _undated_gold("gold_user_activity_daily"),
        "dq_undated": _dq_undated,
        "top_songs_top1": _top(gold.top_songs_daily, 1),
        "presented_order": _presented_order,
        "json_bad_lines": _json_bad_lines,
        "json_all_lines": _json_all_lines,
        "replay_bad_lines": _replay_bad_lines,
        "replay_order": _replay_order,
        "stream_restart": _stream_restart,
        "wap_empty_topic": _wap_empty_topic,
        "status_readiness": _status_readiness,
        "selected_run": _selected_run,
        "republish": _republish,
        "table_copy": _table_copy,
    }


def _pinned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Python workers import the package from here, whatever folder they start in.
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return query(require_utc(spark), sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Listening per day: plays, listeners, hours, paid share."""
    return queries()["daily_listening_stats"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per model or operator; each takes (spark, sf_dir)."""
    registered = _registered()
    if llm_queries:
        registered |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return {name: _pinned(query) for name, query in registered.items()}


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the test tables."""
    return oracles.oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})
