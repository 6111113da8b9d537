"""Tables stored in buckets, and checks counted while tables are written."""

import datetime
import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tempolake import Pipeline, Warehouse
from tempolake.operators import gold, quality
from tempolake.plans import wap
from tempolake.plans.buckets import store_bucketed
from tempolake.sources import testdata

JAN = datetime.date(2024, 1, 1)


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def silver(spark):
    """Random rows of three silver tables, with nulls, and a user with most of them."""
    draw = random.Random(12)

    def user():
        return draw.choice([None, 1, 1, 1, 1, 2, 3, 4])

    def date():
        return draw.choice([None, *[JAN + datetime.timedelta(days=n) for n in range(3)]])

    listens = [
        (date(), user(), draw.choice([None, 1, 2, 3]), draw.choice([None, "a", "b", "c"]),
         float(draw.randrange(1, 99)), draw.choice(["x", None]), "l", "f", "free")
        for _ in range(300)
    ]
    views = [
        (date(), user(), draw.choice([None, 1, 2]), draw.choice([None, "Home", "Help"]))
        for _ in range(200)
    ]
    changes = [(date(), user(), draw.choice(["upgrade", "downgrade", "other"])) for _ in range(60)]
    return (
        spark.createDataFrame(
            listens,
            "event_date date, user_id long, session_id long, artist string, "
            "duration_seconds double, first_name string, last_name string, gender string, "
            "level string",
        ),
        spark.createDataFrame(views, "event_date date, user_id long, session_id long, page string"),
        spark.createDataFrame(changes, "event_date date, user_id long, change_category string"),
    )


def brute(listens, views, changes):
    def by_key(rows):
        found = {}
        for row in rows.collect():
            found.setdefault((row.event_date, row.user_id), []).append(row)
        return found

    def different(rows, name):
        return len({r[name] for r in rows} - {None})

    views, changes = by_key(views), by_key(changes)
    out = set()
    for key, rows in by_key(listens).items():
        whole = None not in key  # null keys meet nothing in a join
        seen, changed = (side.get(key, []) if whole else [] for side in (views, changes))
        out.add(
            (
                *key, max((r.first_name for r in rows if r.first_name), default=None), len(rows),
                different(rows, "session_id"), different(rows, "artist"), len(seen),
                different(seen, "page"), different(seen, "session_id"),
                sum(r.change_category == "upgrade" for r in changed),
                sum(r.change_category == "downgrade" for r in changed), 0,
            )
        )
    return out


COLUMNS = [
    "event_date", "user_id", "first_name", "play_count", "sessions_with_plays", "unique_artists",
    "page_view_count", "unique_pages_visited", "sessions_with_page_views", "upgrade_count",
    "downgrade_count", "churn_events",
]


def test_activity_equals_brute_force_stored_or_not(spark, silver, tmp_path):
    expected = brute(*silver)
    plain = gold.user_activity_daily(*silver).select(*COLUMNS).collect()
    assert set(map(tuple, plain)) == expected and len(plain) == len(expected)
    names = ("bucketed_l", "bucketed_v", "bucketed_c")
    stored = store_bucketed(dict(zip(names, silver)), "bucketed_test", str(tmp_path), 4)
    rows = gold.user_activity_daily(*[stored[n] for n in names], co_located=True)
    got = rows.select(*COLUMNS).collect()
    assert set(map(tuple, got)) == expected and len(got) == len(expected)
    spark.sql("DROP DATABASE bucketed_test CASCADE")


def test_nothing_is_shuffled_over_buckets(spark, silver, tmp_path):
    names = ("bucketed_l", "bucketed_v", "bucketed_c")
    stored = store_bucketed(dict(zip(names, silver)), "bucketed_plan", str(tmp_path), 4)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        rows = gold.user_activity_daily(*[stored[n] for n in names], co_located=True)
        plan = plan_of(rows)
    finally:
        spark.conf.set(threshold, before)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    assert plan.count("FileScan") == 3 and plan.count("Bucketed: true") == 3
    spark.sql("DROP DATABASE bucketed_plan CASCADE")


def test_unstored_tables_are_gathered_once(spark, silver):
    plan = plan_of(gold.user_activity_daily(*silver))
    # Plays and views: one shuffle to collapse them, one by key; changes: one by key.
    assert plan.count("Exchange hashpartitioning") <= 5 and "Expand" not in plan


def checks(column="a"):
    return [
        quality.Check("t", column, "not_null"),
        quality.Check("t", "b", "accepted_values", ("x", "y")),
        quality.Check("t", column, "unique"),
        quality.Check("other", "a", "not_null"),
    ]


@pytest.mark.parametrize(
    "rows",
    [[], [(1, "x")], [(None, None), (1, "x"), (1, "z"), (2, "z"), (None, "q"), (3, None)]],
)
def test_watched_checks_equal_the_audit(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "a int, b string")
    watched = quality.WatchedChecks("t", checks())
    watched.watch(frame).write.parquet(f"{tmp_path}/t")
    assert watched.rows == len(rows)
    stored = spark.read.parquet(f"{tmp_path}/t")
    results = list(watched.results())
    if watched.left:
        results += [r.asDict() for r in quality.audit({"t": stored}, watched.left).collect()]
    expected = quality.audit({"t": stored}, watched.checks).collect()
    assert sorted(map(str, results)) == sorted(str(r.asDict()) for r in expected)
    outside = any(b not in (None, "x", "y") for _, b in rows)
    assert [c.test for c in watched.left] == ["accepted_values"] * outside + ["unique"]


def test_counting_survives_a_shuffle_below(spark, tmp_path):
    watched = quality.WatchedChecks("t", checks())
    frame = spark.range(1000).selectExpr("IF(id % 4 = 0, null, int(id)) AS a", "'x' AS b")
    Warehouse(spark, str(tmp_path)).write(
        frame.withColumn("event_date", F.current_date()), "silver", 1, "t", True, True, watched
    )
    assert watched.rows == 1000 and watched.results()[0]["failures"] == 250


def test_silver_is_written_and_audited_in_one_scan(spark, tmp_path, monkeypatch):
    raw = testdata.event_tables(spark, SMALL, blank_artist="Indie")

    def no_second_look(*args):
        raise AssertionError("the audit read a table again")

    monkeypatch.setattr(wap, "audit", no_second_look)
    run = Pipeline(Warehouse(spark, str(tmp_path)), raw)
    run.write_silver()
    run.audit_silver()
    assert len(run.report.silver_audit) == len(quality.SILVER_CHECKS)
    assert all(r["failures"] == 0 for r in run.report.silver_audit)
    listens = run.watched["silver_listen_events"]
    staged = run.warehouse.read_run("silver_staging", run.run_id, "silver_listen_events")
    assert listens.rows == staged.count()


def test_failures_found_while_writing_stop_the_run(spark, tmp_path):
    run = Pipeline(Warehouse(spark, str(tmp_path)), testdata.event_tables(spark, SMALL))
    run.write_silver()
    with pytest.raises(quality.AuditFailed) as failure:
        run.audit_silver()
    expected = entry_module.queries()["dq_silver_audit"](spark, SMALL).filter("failures > 0")
    assert sorted(map(str, failure.value.failed)) == sorted(
        str(r.asDict()) for r in expected.collect()
    )
