"""Runs that rebuild the days that new rows belong to, and tables made of several runs' days."""

import datetime
import json
import threading

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL
from tempolake import Warehouse
from tempolake.operators.quality import AuditFailed
from tempolake.plans.wap import ChangedDays
from tempolake.plans.warehouse import on_days
from tempolake.schemas import AUTH, LISTEN
from tempolake.sources.bronze import BatchTable
from tempolake.streaming.decode import decode, to_bronze

DAY = 86_400_000
JUNE = 1_717_200_000_000  # 2024-06-01


def date(n):
    return datetime.date(2024, 6, 1 + n)


def write(table, batch_id, *events):
    lines = table.spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    counts = Observation()
    table.write_batch(to_bronze(decode(lines, table.topic, counts), table.topic), batch_id, counts)


def sign_in(user, day):
    ts = None if day is None else JUNE + day * DAY
    return {"userId": user, "sessionId": 1, "level": "free", "ts": ts, "success": True}


def play(user, day, artist="a"):
    return sign_in(user, day) | {"artist": artist, "song": "s", "duration": 60.0}


def run_auth(warehouse, table):
    run = ChangedDays(warehouse, {AUTH.name: table})
    run.write_silver("silver_auth_events")
    run.publish_silver()
    return run


def users_by_run(warehouse, runs):
    rows = warehouse.read("silver", "silver_auth_events", origin="file").collect()
    number = {f"run_id={run.run_id}/": i for i, run in enumerate(runs)}
    return sorted(
        (r.event_date, r.user_id, next(i for mark, i in number.items() if mark in r.file))
        for r in rows
    )


def test_only_touched_days_are_written(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/bronze", AUTH)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    write(table, 0, sign_in(1, 0), sign_in(2, 1), sign_in(3, 2))
    runs = [run_auth(warehouse, table)]
    write(table, 1, sign_in(4, 1))
    write(table, 2, sign_in(5, 3))
    runs.append(run_auth(warehouse, table))
    assert users_by_run(warehouse, runs) == [
        (date(0), 1, 0), (date(1), 2, 1), (date(1), 4, 1), (date(2), 3, 0), (date(3), 5, 1),
    ]
    # Nothing new: no build, no publication.
    before = warehouse.published("silver")
    again = run_auth(warehouse, table)
    assert again.days == {"silver_auth_events": []} and warehouse.published("silver") == before
    write(table, 3, sign_in(6, 1), sign_in(7, 0))
    runs.append(run_auth(warehouse, table))
    expected = [
        (date(0), 1, 2), (date(0), 7, 2), (date(1), 2, 2), (date(1), 4, 2), (date(1), 6, 2),
        (date(2), 3, 0), (date(3), 5, 1),
    ]
    assert users_by_run(warehouse, runs) == expected
    warehouse.create_views("silver")
    seen = spark.sql("SELECT event_date, user_id FROM silver.silver_auth_events").collect()
    assert sorted(map(tuple, seen)) == [row[:2] for row in expected]
    spark.sql("DROP VIEW silver.silver_auth_events")
    warehouse.compact("silver", "silver_auth_events", 99)
    assert len(warehouse.published("silver")["silver_auth_events"]) == 1
    rows = warehouse.read("silver", "silver_auth_events").collect()
    assert sorted((r.event_date, r.user_id) for r in rows) == [row[:2] for row in expected]
    assert warehouse.built_upto("silver", "silver_auth_events") == 3


def test_rows_without_a_day_are_a_day_of_their_own(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/bronze", AUTH)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    write(table, 0, sign_in(1, 0), sign_in(2, None))
    runs = [run_auth(warehouse, table)]
    write(table, 1, sign_in(3, None))
    runs.append(run_auth(warehouse, table))
    rows = warehouse.read("silver", "silver_auth_events", origin="file").collect()
    got = {(r.user_id, f"run_id={runs[1].run_id}/" in r.file) for r in rows}
    assert got == {(1, False), (2, True), (3, True)} and len(rows) == 3


def test_a_failed_audit_publishes_nothing(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/bronze", LISTEN)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    write(table, 0, play(1, 0), play(2, 1))

    def run():
        one = ChangedDays(warehouse, {LISTEN.name: table})
        one.write_silver("silver_listen_events")
        one.audit_silver()
        one.publish_silver()
        one.build_gold("gold_top_artists_daily", "gold_qoq_listener_growth")
        return one

    run()
    write(table, 1, play(3, 1, " "))
    with pytest.raises(AuditFailed):
        run()
    assert warehouse.read("silver", "silver_listen_events").count() == 2
    # The batch is still to be done: the next run has its day again.
    assert warehouse.built_upto("silver", "silver_listen_events") == 0
    artists = warehouse.read("gold", "gold_top_artists_daily").collect()
    assert {(r.event_date, r.play_count) for r in artists} == {(date(0), 1), (date(1), 1)}


def test_gold_days_follow_silver(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/bronze", LISTEN)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")

    def run():
        one = ChangedDays(warehouse, {LISTEN.name: table})
        one.write_silver("silver_listen_events")
        one.publish_silver()
        one.build_gold("gold_daily_listening_stats", "gold_qoq_listener_growth")
        return one

    write(table, 0, play(1, 0), play(2, 1))
    run()
    write(table, 1, play(3, 1), play(3, 2))
    second = run()
    rows = warehouse.read("gold", "gold_daily_listening_stats", origin="file").collect()
    new = f"run_id={second.run_id}/"
    assert sorted((r.event_date, r.total_plays, new in r.file) for r in rows) == [
        (date(0), 1, False), (date(1), 2, True), (date(2), 1, True),
    ]
    growth = warehouse.read("gold", "gold_qoq_listener_growth").first()
    assert growth.unique_listeners == 3


def test_a_part_reads_its_own_days_only(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/bronze", AUTH)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    write(table, 0, *[sign_in(n, n) for n in range(6)])
    run_auth(warehouse, table)
    write(table, 1, sign_in(9, 2))
    run = run_auth(warehouse, table)
    assert run.days == {"silver_auth_events": [date(2)]}
    plan = warehouse.read("silver", "silver_auth_events")._jdf.queryExecution().toString()
    assert plan.count("PartitionFilters: [") >= 2 and "PartitionFilters: []" not in plan


def test_conditions_of_days(spark):
    rows = spark.createDataFrame([(date(0),), (date(1),), (None,)], "event_date date")
    for days in ([], [date(0)], [None], [None, date(1), date(0)]):
        got = [r[0] for r in rows.filter(F.expr(on_days(days))).collect()]
        assert set(got) == set(days) and len(got) == len(days)


def test_topics_come_in_at_the_same_time(spark, monkeypatch):
    """No topic's ingest waits for the end of another's."""
    together, start = threading.Barrier(3, timeout=60), entry.start_counted_ingest

    def started(*args):
        together.wait()
        return start(*args)

    monkeypatch.setattr(entry, "start_counted_ingest", started)
    rows = entry.queries()["changed_days"](spark, SMALL)
    assert {r.rebuilt for r in rows.select("rebuilt").distinct().collect()} == {True, False}
