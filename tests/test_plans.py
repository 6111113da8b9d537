"""Physical plans that have to hold at scale."""

import pytest

from tempolake.operators import gold, quality, silver
from tempolake.sources.testdata import event_tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw and silver tables on disk, so that plans start at a Parquet scan."""
    root = tmp_path_factory.mktemp("stored")
    raw = event_tables(spark, "/root/testdata/sf0.001")
    tables = {}
    for name in ("listen_events", "page_view_events", "status_change_events"):
        raw[name].write.parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
        model = getattr(silver, f"silver_{name}")
        model(tables[name]).write.parquet(f"{root}/silver_{name}")
        tables[f"silver_{name}"] = spark.read.parquet(f"{root}/silver_{name}")
    return tables


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(frame):
    return [line for line in plan(frame).splitlines() if "FileScan" in line]


def test_silver_is_narrow_and_filters_in_the_scan(stored):
    frame = silver.silver_listen_events(stored["listen_events"])
    assert "Exchange" not in plan(frame)
    (scan,) = scans(frame)
    assert "IsNotNull(userId), IsNotNull(song), IsNotNull(artist)" in scan
    assert "auth#" not in scan.split("]")[0]


def test_gold_reads_only_what_it_needs(stored):
    frame = gold.qoq_listener_growth(stored["silver_listen_events"])
    (scan,) = scans(frame)
    assert scan.split("[")[1].split("]")[0].count("#") == 2  # user_id, event_date


def test_several_distinct_counts_do_not_multiply_rows(stored):
    plays = stored["silver_listen_events"]
    for frame in (gold.daily_listening_stats(plays), gold.top_artists_daily(plays)):
        assert "Expand" not in plan(frame)


def test_ranks_never_sort_a_whole_day_in_one_task(stored):
    plays = stored["silver_listen_events"]
    for frame in (gold.top_artists_daily(plays), gold.top_songs_daily(plays)):
        text = plan(frame)
        assert "rank(" not in text
        window = text[text.index("Window [") :]
        # Below the window: one row per (day, count).
        assert "keys=[event_date" in window.split("HashAggregate(")[1]
        assert "play_count" in window.split("HashAggregate(")[1].split("]")[0]


def test_activity_hash_aggregates_the_events(stored):
    frame = gold.user_activity_daily(
        stored["silver_listen_events"],
        stored["silver_page_view_events"],
        stored["silver_status_change_events"],
    )
    lines = plan(frame).splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line:
            above = [x for x in lines[:i] if "Aggregate" in x][-1]
            assert "HashAggregate" in above


def test_activity_joins_reuse_the_aggregates_partitioning(stored):
    frame = gold.user_activity_daily(
        stored["silver_listen_events"],
        stored["silver_page_view_events"],
        stored["silver_status_change_events"],
    )
    text = plan(frame)
    # No shuffle sits directly under a join or its sort: both sides come from an aggregate.
    # (Plays and views are gathered below a window's sort, once, with the partitioning they keep.)
    lines = [line.lstrip(" :+-*") for line in text.splitlines()]
    for above, below in zip(lines, lines[1:]):
        if above.startswith("Sort [") and "false, 0" in above:
            if below.startswith("Exchange"):
                assert any(x in lines[lines.index(above) - 1] for x in ("Aggregate", "Window ["))


def test_activity_scans_each_table_once(stored):
    frame = gold.user_activity_daily(
        stored["silver_listen_events"],
        stored["silver_page_view_events"],
        stored["silver_status_change_events"],
    )
    assert len(scans(frame)) == 3


def test_audit_scans_each_table_once(stored):
    own = [c for c in quality.SILVER_CHECKS if c.table in stored]
    tables = {c.table: stored[c.table] for c in own}
    assert len(scans(quality.audit(tables, own))) == len(tables)


def test_rank_join_is_salted(stored):
    text = plan(gold.top_songs_daily(stored["silver_listen_events"]))
    assert "_salt" in text


def test_ranks_of_a_day_of_single_plays(spark, listens):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        rows = [("2024-01-01", i, 1, "a", f"s{i}", 1.0, True) for i in range(300)]
        rows += [("2024-01-01", 1, 1, "a", "hit", 1.0, True)] * 2
        ranks = gold.top_songs_daily(listens(rows)).collect()
        assert {(r.song == "hit", r.daily_rank) for r in ranks} == {(True, 1), (False, 2)}
        assert len(ranks) == 301
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
