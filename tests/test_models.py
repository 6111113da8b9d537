"""Silver and gold models on literal rows: NULLs, blanks, ties, gaps, missing sides."""

import datetime
import random
from collections import Counter, defaultdict

from conftest import SMALL
from pyspark.sql import functions as F

from tempolake.operators import gold, silver
from tempolake.operators.ranking import top_n
from tempolake.schemas import LISTEN, PAGE_VIEW, TOPICS
from tempolake.sources.testdata import event_tables

D = datetime.date


def raw(spark, topic, *rows):
    """Raw rows from dicts; other columns are NULL."""
    schema = topic.bronze_schema
    return spark.createDataFrame([[r.get(n) for n in schema.names] for r in rows], schema)


def test_silver_schemas(spark):
    expected = {
        "listen_events": "user_id bigint, session_id bigint, item_in_session int, artist string, "
        "song string, duration_seconds double, level string, is_paid boolean, gender string, "
        "first_name string, last_name string, user_agent string, registration bigint, "
        "event_timestamp timestamp, event_date date, hour_of_day int, day_of_week int, "
        "week_of_year int",
        "page_view_events": "user_id bigint, session_id bigint, item_in_session int, page string, "
        "level string, is_paid boolean, gender string, first_name string, last_name string, "
        "user_agent string, event_timestamp timestamp, event_date date, hour_of_day int, "
        "day_of_week int, http_method string, http_status int, auth string, registration bigint",
        "auth_events": "user_id bigint, session_id bigint, item_in_session int, "
        "is_successful boolean, level string, is_paid boolean, gender string, "
        "first_name string, last_name string, registration bigint, event_timestamp timestamp, "
        "event_date date, hour_of_day int, day_of_week int",
        "status_change_events": "user_id bigint, session_id bigint, item_in_session int, "
        "level string, change_category string, auth_status string, gender string, "
        "first_name string, last_name string, registration bigint, event_timestamp timestamp, "
        "event_date date, hour_of_day int, day_of_week int",
    }
    for name, columns in expected.items():
        model = getattr(silver, f"silver_{name}")
        got = model(raw(spark, TOPICS[name])).schema
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in got) == columns


def test_gold_schemas(spark):
    tables = event_tables(spark, "/root/testdata/sf0.001")
    plays = silver.silver_listen_events(tables["listen_events"])
    views = silver.silver_page_view_events(tables["page_view_events"])
    changes = silver.silver_status_change_events(tables["status_change_events"])
    expected = {
        gold.daily_listening_stats(plays): "event_date date, total_plays bigint, "
        "unique_listeners bigint, unique_artists bigint, unique_songs bigint, "
        "unique_sessions bigint, total_listening_hours double, "
        "avg_track_duration_minutes double, paid_plays bigint, free_plays bigint, "
        "paid_play_pct double",
        gold.top_artists_daily(plays): "event_date date, artist string, play_count bigint, "
        "unique_listeners bigint, unique_songs bigint, total_listening_hours double, "
        "daily_rank bigint",
        gold.top_songs_daily(plays): "event_date date, song string, artist string, "
        "play_count bigint, unique_listeners bigint, avg_duration_minutes double, "
        "daily_rank bigint",
        gold.user_activity_daily(plays, views, changes): "event_date date, user_id bigint, "
        "first_name string, last_name string, gender string, level string, play_count bigint, "
        "sessions_with_plays bigint, unique_artists bigint, total_listening_minutes double, "
        "page_view_count bigint, unique_pages_visited bigint, sessions_with_page_views bigint, "
        "upgrade_count bigint, downgrade_count bigint, churn_events bigint",
        gold.hourly_listening_heatmap(plays): "day_of_week int, hour_of_day int, "
        "play_count bigint, unique_listeners bigint, avg_duration_minutes double",
        gold.qoq_listener_growth(plays): "quarter_start date, quarter_label string, "
        "unique_listeners bigint, prev_quarter_listeners bigint, qoq_growth_pct double, "
        "trend string",
    }
    for frame, columns in expected.items():
        got = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
        assert got == columns


def test_listen_filters_look_at_raw_text(spark):
    base = {"userId": 1, "song": "s", "artist": "a", "ts": 0, "event_date": D(1970, 1, 1)}
    rows = raw(
        spark,
        LISTEN,
        base,
        base | {"artist": "  "},
        base | {"artist": "\t"},
        base | {"artist": None},
        base | {"song": None},
        base | {"userId": None},
    )
    assert [r.artist for r in silver.silver_listen_events(rows).collect()] == ["a", None, None]


def test_paid_flag_uses_the_raw_level(spark):
    base = {"userId": 1, "song": "s", "artist": "a", "ts": 0}
    rows = raw(spark, LISTEN, *[base | {"level": v} for v in ("paid", "PAID", "free", None)])
    got = [(r.level, r.is_paid) for r in silver.silver_listen_events(rows).collect()]
    assert got == [("paid", True), ("paid", False), ("free", False), (None, None)]


def test_page_exclusion_uses_the_cleaned_page(spark):
    pages = ["Home", " Save Settings ", "  ", None, "Error", " Help", "error"]
    rows = raw(spark, PAGE_VIEW, *[{"userId": 1, "ts": 0, "page": p} for p in pages])
    assert [r.page for r in silver.silver_page_view_events(rows).collect()] == [
        "Home", "Help", "error",
    ]


def test_dedup_is_off_by_default(spark):
    rows = raw(spark, LISTEN, *[{"userId": 1, "song": "s", "artist": "a", "ts": 0}] * 3)
    assert silver.silver_listen_events(rows).count() == 3
    assert silver.silver_listen_events(rows, dedup_keys=["userId", "ts"]).count() == 1


def test_null_level_counts_as_neither_paid_nor_free(listens):
    rows = listens(
        [
            ("2025-01-01", 1, 1, "a", "s", 60.0, True),
            ("2025-01-01", 1, 1, "a", "s", 60.0, False),
            ("2025-01-01", 2, 2, "b", "s", None, None),
        ]
    )
    row = gold.daily_listening_stats(rows).first()
    assert (row.total_plays, row.paid_plays, row.free_plays, row.paid_play_pct) == (3, 1, 1, 33.3)
    assert (row.unique_listeners, row.unique_artists, row.unique_songs) == (2, 2, 1)
    assert (row.total_listening_hours, row.avg_track_duration_minutes) == (0.03, 1.0)


def test_rank_has_gaps_after_ties(listens):
    plays = ["a"] * 3 + ["b"] * 2 + ["c"] * 2 + ["d"]
    rows = listens([("2025-01-01", 1, 1, a, "s", 1.0, True) for a in plays])
    ranks = {r.artist: r.daily_rank for r in gold.top_artists_daily(rows).collect()}
    assert ranks == {"a": 1, "b": 2, "c": 2, "d": 4}
    assert top_n(gold.top_artists_daily(rows), 2).count() == 3


def test_songs_keep_a_missing_artist(listens):
    rows = listens(
        [
            ("2025-01-01", 1, 1, None, "s", 1.0, True),
            ("2025-01-01", 2, 1, None, "s", 1.0, True),
            ("2025-01-01", 1, 1, "a", "s", 1.0, True),
            ("2025-01-01", 1, 1, "a", None, 1.0, True),
        ]
    )
    got = {(r.song, r.artist, r.play_count, r.daily_rank) for r in gold.top_songs_daily(rows).collect()}
    assert got == {("s", None, 2, 1), ("s", "a", 1, 2)}


def test_ranks_and_distincts_on_a_skewed_day(listens):
    """One day, one artist and one user hold most rows; compared with plain Python."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        day = "2025-01-01" if i % 3 else f"2025-01-{rng.randint(2, 20):02d}"
        artist = "hot" if rng.random() < 0.4 else f"a{rng.randint(0, 60)}"
        user = 0 if rng.random() < 0.4 else rng.randint(1, 80)
        data.append((day, user, rng.randint(0, 500), artist, f"s{rng.randint(0, 99)}", 1.0, True))
    counts, users, songs = Counter(), defaultdict(set), defaultdict(set)
    for day, user, _, artist, song, _, _ in data:
        counts[day, artist] += 1
        users[day, artist].add(user)
        songs[day, artist].add(song)
    expected = {
        (d, a, n, len(users[d, a]), len(songs[d, a]),
         1 + sum(1 for (d2, _), m in counts.items() if d2 == d and m > n))
        for (d, a), n in counts.items()
    }
    got = {
        (str(r.event_date), r.artist, r.play_count, r.unique_listeners, r.unique_songs, r.daily_rank)
        for r in gold.top_artists_daily(listens(data)).collect()
    }
    assert got == expected


def test_growth_skips_missing_quarters(listens):
    rows = [("2025-01-05", u, 1, "a", "s", 1.0, True) for u in range(10)]
    rows += [("2025-08-05", u, 1, "a", "s", 1.0, True) for u in range(10)]
    rows += [("2025-10-05", u, 1, "a", "s", 1.0, True) for u in range(3)]
    got = [tuple(r)[1:] for r in gold.qoq_listener_growth(listens(rows)).collect()]
    assert got == [
        ("2025-Q1", 10, None, None, "first quarter"),
        ("2025-Q3", 10, 10, 0.0, "flat"),
        ("2025-Q4", 3, 10, -70.0, "decline"),
    ]


def test_tiny_growth_is_flat(listens):
    rows = [("2025-01-05", u, 1, "a", "s", 1.0, True) for u in range(10_000)]
    rows += [("2025-04-05", u, 1, "a", "s", 1.0, True) for u in range(10_001)]
    last = gold.qoq_listener_growth(listens(rows)).collect()[-1]
    assert (last.qoq_growth_pct, last.trend) == (0.0, "flat")


def test_activity_keeps_listeners_only(spark, listens):
    plays = listens(
        [
            ("2025-01-01", 1, 1, "a", "s", 90.0, True),
            ("2025-01-01", 1, 2, "b", "s", 30.0, True),
            ("2025-01-02", 2, 3, "a", "s", None, None),
        ]
    )
    views = spark.createDataFrame(
        [(D(2025, 1, 1), 1, "Home", 1), (D(2025, 1, 1), 1, "Home", 2), (D(2025, 1, 1), 9, "Home", 3)],
        "event_date date, user_id bigint, page string, session_id bigint",
    )
    changes = spark.createDataFrame(
        [(D(2025, 1, 1), 1, "upgrade"), (D(2025, 1, 1), 1, "other"), (D(2025, 1, 2), 8, "upgrade")],
        "event_date date, user_id bigint, change_category string",
    )
    got = {r.user_id: r for r in gold.user_activity_daily(plays, views, changes).collect()}
    assert set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one.play_count, one.sessions_with_plays, one.unique_artists) == (2, 2, 2)
    assert one.total_listening_minutes == 2.0
    assert (one.page_view_count, one.unique_pages_visited, one.sessions_with_page_views) == (2, 1, 2)
    assert (one.upgrade_count, one.downgrade_count, one.churn_events) == (1, 0, 0)
    assert (two.page_view_count, two.upgrade_count, two.total_listening_minutes) == (0, 0, None)


def test_churn_is_never_counted(spark):
    tables = event_tables(spark, "/root/testdata/sf0.001")
    changes = silver.silver_status_change_events(tables["status_change_events"])
    assert changes.filter(F.col("change_category") == "churn").count() == 0


def test_status_rows_share_one_time(spark):
    tables = {name: spark.range(i) for i, name in enumerate(gold.STATUS_TABLES)}
    status = gold.pipeline_status(tables)
    rows = status.collect()
    assert [(r.table_name, r.rows_loaded) for r in rows] == [
        (name, i) for i, name in enumerate(gold.STATUS_TABLES)
    ]
    assert all(r.is_ready for r in rows) and len({r.refreshed_at for r in rows}) == 1
    assert gold.last_refresh(status).first()[0] is not None
    unready = status.withColumn("is_ready", F.col("table_name") != gold.STATUS_TABLES[0])
    assert gold.last_refresh(unready).first()[0] is None


def test_filtering_pages_parses_few_times(spark):
    views = event_tables(spark, SMALL)[PAGE_VIEW.name]
    plan = silver.silver_page_view_events(views)._jdf.queryExecution().optimizedPlan().toString()
    # Once for the filter, wherever it is pushed to, and once for the columns.
    assert 1 <= plan.count("get_json_object") <= 2
    names = {"Error", "Upgrade", " Save Settings ", "  ", "Home", " Help", "About", "Logout"}
    assert {r.page for r in views.select("page").distinct().collect()} == {*names, "NextSong"}
