"""Streaming ingest from files: lenient decode, restart, late rows, rejects, snapshots, replay."""

import datetime
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tempolake.schemas import AUTH, LISTEN, PAGE_VIEW, TOPICS
from tempolake.sources import files, kafka
from tempolake.sources.bronze import FileSinkTable, between
from tempolake.streaming.decode import decode, to_bronze
from tempolake.streaming.ingest import await_all, start_all, start_ingest
from tempolake.streaming.progress import ProgressCounters, summarize

ONCE = {"availableNow": True}
LINES = [
    "bad",
    "",
    "  ",
    '[{"userId":1}]',
    "5",
    "null",
    '{"userId":1,"ts":5}{"userId":2,"ts":6}',
    '{"userId":"zz","ts":5,"level":"paid"}',
    '{"userId":"12","ts":5}',
    '{"userId":99999999999,"ts":1}',
    '{"userId":3,"ts":null}',
    '{"userId":4,"ts":1735689599999}',
    '{"userId":4,"ts":1735689600000,"duration":277.15873}',
    '{"userId":7.0,"ts":1735689600000.0}',
]
EXPECTED = {
    (1, 5, "1970-01-01"),
    (None, 5, "1970-01-01"),
    (12, 5, "1970-01-01"),
    (None, 1, "1970-01-01"),
    (3, None, "None"),
    (4, 1735689599999, "2024-12-31"),
    (4, 1735689600000, "2025-01-01"),
    (7, 1735689600000, "2025-01-01"),
}


def triples(frame):
    return {(r.userId, r.ts, str(r.event_date)) for r in frame.collect()}


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_batch_decode_edge_rows(spark, tmp_path):
    put(tmp_path, "listen_events", *LINES)
    rows = to_bronze(decode(spark.read.text(str(tmp_path)), LISTEN), LISTEN)
    assert rows.schema == LISTEN.bronze_schema
    assert triples(rows) == EXPECTED
    assert rows.filter("length = 277.15873").count() == 1
    assert rows.filter("level = 'paid' and userId is null").count() == 1


def test_decode_parses_each_line_once(spark, tmp_path):
    put(tmp_path, "listen_events", *LINES)
    rows = to_bronze(decode(spark.read.text(str(tmp_path)), LISTEN), LISTEN)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_booleans(spark):
    lines = [(json.dumps({"ts": 1, "success": v}),) for v in (True, False, "true", "no", None)]
    rows = decode(spark.createDataFrame(lines, "value string"), AUTH)
    assert [r.success for r in rows.collect()] == [True, False, True, False, None]


def counted_run(spark, query):
    """Totals of a query's progress, as the listener adds them up."""
    totals = {"rows": 0, "lines": 0, "malformed": 0, "rejected": 0}
    for progress in query.recentProgress:
        totals["rows"] += progress.numInputRows
        for metrics in progress.observedMetrics.values():
            for name in ("lines", "malformed", "rejected"):
                totals[name] += metrics[name]
    return totals


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    put(tmp_path / "in", "listen_events", *LINES)
    table = FileSinkTable(spark, str(tmp_path / "bronze"), LISTEN)

    def ingest():
        lines = files.stream_lines(spark, str(tmp_path / "in"))
        query = start_ingest(lines, table, str(tmp_path / "cp"), ONCE)
        query.awaitTermination()
        return counted_run(spark, query)

    counted = ingest()
    assert (counted["lines"], counted["malformed"], counted["rejected"]) == (12, 4, 1)
    assert triples(table.dated()) == {t for t in EXPECTED if t[1] is not None}
    assert triples(table.rejects()) == {(3, None, "None")}
    assert triples(table.read()) == EXPECTED
    assert table.read().schema == LISTEN.bronze_schema

    # Resume: only the new file is read, and a row 55 years late is kept.
    put(tmp_path / "in", "more", '{"userId":50,"ts":1}', '{"userId":51,"ts":1767225600000}')
    assert ingest()["rows"] == 2
    late = triples(table.read()) - EXPECTED
    assert late == {(50, 1, "1970-01-01"), (51, 1767225600000, "2026-01-01")}
    assert ingest()["rows"] == 0
    assert table.dated().count() == 9


def test_stream_and_batch_read_the_same_files(spark, tmp_path):
    put(tmp_path / "in" / "auth_events", "part-0", '{"userId":1,"ts":1}', '{"userId":2,"ts":2}')
    put(tmp_path / "in", "auth_events.json", '{"userId":9,"ts":9}')
    put(tmp_path / "in" / "more", "auth_events", '{"userId":3,"ts":3}')
    batch = files.topic_lines(spark, str(tmp_path / "in")).filter("topic = 'auth_events'")
    table = FileSinkTable(spark, str(tmp_path / "bronze"), AUTH)
    lines = files.stream_lines(spark, str(tmp_path / "in"), AUTH)
    start_ingest(lines, table, str(tmp_path / "cp"), ONCE).awaitTermination()
    assert batch.count() == table.read().count() == 3


def test_lengths_that_are_no_numbers(spark):
    lines = [(f'{{"userId":1,"ts":1,"duration":{d}}}',) for d in ('"NaN"', '"Infinity"', "1.5")]
    rows = to_bronze(decode(spark.createDataFrame(lines, "value string"), LISTEN), LISTEN)
    assert sorted(str(r["length"]) for r in rows.collect()) == ["1.5", "None", "None"]


def test_all_topics_at_once(spark, tmp_path):
    folder = tmp_path / "in" / "2025_Q1_control.json"
    for i, name in enumerate(TOPICS):
        put(folder, name, *['{"userId":1,"ts":1735689600000}'] * (i + 1))
    put(folder, "unrelated", "x")
    counters = ProgressCounters()
    spark.streams.addListener(counters)
    try:
        queries = start_all(
            spark,
            lambda topic: files.stream_lines(spark, str(tmp_path / "in"), topic),
            str(tmp_path / "bronze"),
            str(tmp_path / "cp"),
            trigger=ONCE,
        )
        await_all(queries)
    finally:
        spark.streams.removeListener(counters)
    for i, (name, topic) in enumerate(TOPICS.items()):
        table = FileSinkTable(spark, str(tmp_path / "bronze"), topic)
        assert table.read().count() == i + 1
        assert counters.totals[name]["rows"] == counters.totals[name]["lines"] == i + 1
        assert set(summarize(queries[name])) == {"rows_per_second", "watermark"}
    assert not counters.failures


def test_date_range_prunes_partitions(spark, tmp_path):
    put(tmp_path / "in", "f", *[f'{{"userId":1,"ts":{d * 86400000}}}' for d in range(5)])
    table = FileSinkTable(spark, str(tmp_path / "bronze"), LISTEN)
    lines = files.stream_lines(spark, str(tmp_path / "in"))
    start_ingest(lines, table, str(tmp_path / "cp"), ONCE).awaitTermination()
    days = between(table.read(), "1970-01-02", "1970-01-03")
    assert days.count() == 2
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_replay_order_is_stable(spark, tmp_path):
    put(tmp_path / "a", "listen_events", '{"userId":1,"ts":9}', '{"userId":2,"ts":3}', "junk", "")
    put(tmp_path / "b", "auth_events", '{"userId":3,"ts":3}', '{"ts":3}', '{"userId":4}')
    put(tmp_path / "b", "notes.txt", '{"userId":99,"ts":0}')
    messages = files.replay_messages(files.topic_lines(spark, str(tmp_path)))
    got = [(r.key, r.topic, r.ts) for r in files.replay_order(messages).collect()]
    assert got == [
        ("4", "auth-events", 0),
        ("2", "listen-events", 3),
        ("3", "auth-events", 3),
        ("", "auth-events", 3),
        ("1", "listen-events", 9),
    ]


def test_replay_reads_folders_named_after_a_topic(spark, tmp_path):
    put(tmp_path / "page_view_events", "part-0", '{"userId":1,"ts":1}')
    lines = files.topic_lines(spark, str(tmp_path))
    assert [r.topic for r in lines.collect()] == ["page_view_events"]


def test_replay_without_topic_files_fails(spark, tmp_path):
    put(tmp_path, "other", "x")
    with pytest.raises(FileNotFoundError):
        files.topic_lines(spark, str(tmp_path))


def test_messages(spark):
    schema = PAGE_VIEW.message_schema
    rows = [{"userId": 5, "page": "Home", "ts": 1}, {"page": "Help"}]
    frame = spark.createDataFrame([[r.get(n) for n in schema.names] for r in rows], schema)
    got = kafka.to_messages(frame, PAGE_VIEW).collect()
    assert [(r.key, r.topic) for r in got] == [("5", "page-view-events"), ("", "page-view-events")]
    assert json.loads(got[0].value) == {"userId": 5, "page": "Home", "ts": 1}
    back = decode(kafka.to_messages(frame, PAGE_VIEW).select("value"), PAGE_VIEW)
    assert back.collect() == frame.collect()


def test_bus_options():
    options = kafka.source_options("host:9092", PAGE_VIEW, max_offsets=10, min_partitions=4)
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "page-view-events",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "4",
    }
    named = kafka.source_options("host:9092", PAGE_VIEW, group_prefix="raw")
    assert named["kafka.group.id"] == "raw-page-view-events"
    assert kafka.PRODUCER_OPTIONS["kafka.compression.type"] == "snappy"


def test_bus_needs_its_connector(spark):
    with pytest.raises(AnalysisException):
        kafka.stream(spark, "host:9092", LISTEN)


def test_replay_pace():
    assert files.trigger_for_speed(3600, 100) == {"processingTime": "36000 milliseconds"}
    assert files.trigger_for_speed(3600, 0) == {"availableNow": True}


def test_max_files_per_trigger_paces_a_backfill(spark, tmp_path):
    for i in range(4):
        put(tmp_path / "in", f"f{i}", f'{{"userId":{i},"ts":{i}}}')
    table = FileSinkTable(spark, str(tmp_path / "bronze"), LISTEN)
    lines = files.stream_lines(spark, str(tmp_path / "in"), max_files=2)
    query = start_ingest(lines, table, str(tmp_path / "cp"), ONCE)
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [2, 2]
    assert table.read().count() == 4


def test_watermark_is_declared(spark, tmp_path):
    put(tmp_path / "in", "a", '{"userId":1,"ts":1735689600000}')
    table = FileSinkTable(spark, str(tmp_path / "bronze"), LISTEN)
    for name, ts in (("b", 5), ("c", 1735689600001)):
        lines = files.stream_lines(spark, str(tmp_path / "in"))
        query = start_ingest(lines, table, str(tmp_path / "cp"), ONCE)
        query.awaitTermination()
        put(tmp_path / "in", name, f'{{"userId":1,"ts":{ts}}}')
    assert summarize(query)["watermark"].startswith("2024-12-31T23:59:30")
    dates = {r.event_date for r in table.read().collect()}
    assert dates == {datetime.date(2025, 1, 1), datetime.date(1970, 1, 1)}


def test_no_shuffle_in_ingest(spark, tmp_path):
    put(tmp_path, "listen_events", *LINES)
    rows = to_bronze(decode(spark.read.text(str(tmp_path)), LISTEN), LISTEN)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.filter(F.col("event_date").isNull()).count() == 1
