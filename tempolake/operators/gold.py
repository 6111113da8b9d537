"""Gold models: daily, hourly, per-user and per-quarter aggregates of the silver tables.

Rows without a date form a group of their own, as in any grouping; the silver checks report them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolake.functions import (
    duration_sums,
    mean_minutes,
    percent,
    quarter_label,
    quarter_start,
    round_div,
    total_hours,
    total_minutes,
)
from tempolake.operators.distinct import aggregate
from tempolake.operators.ranking import lag_over_all, rank_by_count, rows_of, survivors
from tempolake.operators.sets import count_members

# The gold tables a status row is written for.
STATUS_TABLES = (
    "gold_daily_listening_stats",
    "gold_top_artists_daily",
    "gold_top_songs_daily",
    "gold_hourly_listening_heatmap",
    "gold_user_activity_daily",
    "gold_qoq_listener_growth",
)


# The order in which these tables are presented.
PRESENTED_BY = {
    "gold_daily_listening_stats": ("event_date",),
    "gold_hourly_listening_heatmap": ("day_of_week", "hour_of_day"),
    "gold_qoq_listener_growth": ("quarter_start",),
}


def presented(name: str, rows: DataFrame) -> DataFrame:
    """A gold table in its order. Stored tables are not sorted as a whole; readers order them."""
    order = PRESENTED_BY.get(name)
    return rows.orderBy(*order) if order else rows


def _durations() -> list[Column]:
    return duration_sums(F.col("duration_seconds"))


def _plays() -> Column:
    return F.count("*").alias("play_count")


def daily_listening_stats(listens: DataFrame) -> DataFrame:
    """Per day: plays, distinct listeners, artists, songs and sessions, hours, paid share."""
    days = aggregate(
        listens,
        ["event_date"],
        [
            F.count("*").alias("total_plays"),
            *_durations(),
            F.count_if("is_paid").alias("paid_plays"),
            F.count_if(~F.col("is_paid")).alias("free_plays"),
        ],
        {
            "unique_listeners": "user_id",
            "unique_artists": "artist",
            "unique_songs": "song",
            "unique_sessions": "session_id",
        },
    )
    return days.select(
        "event_date",
        "total_plays",
        "unique_listeners",
        "unique_artists",
        "unique_songs",
        "unique_sessions",
        total_hours().alias("total_listening_hours"),
        mean_minutes().alias("avg_track_duration_minutes"),
        "paid_plays",
        "free_plays",
        percent(F.col("paid_plays"), F.col("total_plays")).alias("paid_play_pct"),
    )


def top_artists_daily(listens: DataFrame, n: int | None = None) -> DataFrame:
    """Per day and artist: plays, listeners, songs, hours and the rank within the day.

    With ``n`` only artists that rank ``n`` or better, ties included; the plays of all others
    are dropped before listeners and songs are counted.
    """
    named = listens.filter(F.col("artist").isNotNull())
    keys = ["event_date", "artist"]
    counts = named.groupBy(*keys).agg(_plays())
    artists = aggregate(
        rows_of(named, survivors(counts, keys, "play_count", n)) if n else named,
        keys,
        [_plays(), *_durations()],
        {"unique_listeners": "user_id", "unique_songs": "song"},
    )
    return rank_by_count(artists, counts, "event_date", "play_count", "daily_rank").select(
        "event_date",
        "artist",
        "play_count",
        "unique_listeners",
        "unique_songs",
        total_hours().alias("total_listening_hours"),
        "daily_rank",
    )


def top_songs_daily(listens: DataFrame, n: int | None = None) -> DataFrame:
    """Per day, song and artist (which may be NULL): plays, listeners, length and rank.

    With ``n`` only songs that rank ``n`` or better, as for artists.
    """
    named = listens.filter(F.col("song").isNotNull())
    keys = ["event_date", "song", "artist"]
    counts = named.groupBy(*keys).agg(_plays())
    chosen = rows_of(named, survivors(counts, keys, "play_count", n)) if n else named
    songs = aggregate(chosen, keys, [_plays(), *_durations()], {"unique_listeners": "user_id"})
    return rank_by_count(songs, counts, "event_date", "play_count", "daily_rank").select(
        "event_date",
        "song",
        "artist",
        "play_count",
        "unique_listeners",
        mean_minutes().alias("avg_duration_minutes"),
        "daily_rank",
    )


def _different(columns: dict[str, str], keys: list[str]) -> tuple[list[Column], list[Column]]:
    """Marks and sums that count the different values of columns per key, without another shuffle.

    The first row of each value is marked within its key, which a partitioning by the keys already
    brings together; nulls don't count.
    """
    marks, sums = [], []
    for alias, column in columns.items():
        first = F.row_number().over(Window.partitionBy(*keys, column).orderBy(F.lit(0))) == 1
        marks.append((first & F.col(column).isNotNull()).alias(f"_first_{alias}"))
        sums.append(F.count_if(f"_first_{alias}").alias(alias))
    return marks, sums


def user_activity_daily(
    listens: DataFrame,
    page_views: DataFrame,
    status_changes: DataFrame,
    co_located: bool = False,
) -> DataFrame:
    """Per day and listening user: plays joined with page views and subscription changes.

    Each side is one row per (day, user) before the joins, so no join multiplies rows and
    a heavy user is already collapsed. Of the user's attributes any value will do; the
    largest one keeps results reproducible.

    ``co_located`` says that the tables are stored in buckets by day and user: then nothing is
    shuffled at all.
    """
    keys = ["event_date", "user_id"]
    attributes = ["first_name", "last_name", "gender", "level"]

    def gathered(rows: DataFrame) -> DataFrame:
        return rows if co_located else rows.repartition(*keys)

    # One scan per table. Plays are first collapsed to few rows per user and day, with map-side
    # sums; the rows of a user and day then meet once, for all that is counted and joined.
    collapsed = listens.groupBy(*keys, *attributes, "session_id", "artist").agg(
        _plays(), *_durations()
    )
    marks, sums = _different(
        {"sessions_with_plays": "session_id", "unique_artists": "artist"}, keys
    )
    plays = (
        gathered(collapsed)
        .select("*", *marks)
        .groupBy(*keys)
        .agg(
            *[F.max(c).alias(c) for c in attributes],
            *[F.sum(c).alias(c) for c in ("play_count", "_d_s", "_d_us", "_d_n")],
            *sums,
        )
    )
    viewed = page_views.groupBy(*keys, "page", "session_id").agg(F.count("*").alias("_views"))
    marks, sums = _different(
        {"unique_pages_visited": "page", "sessions_with_page_views": "session_id"}, keys
    )
    views = (
        gathered(viewed)
        .select("*", *marks)
        .groupBy(*keys)
        .agg(F.sum("_views").alias("page_view_count"), *sums)
    )
    category = F.col("change_category")
    changes = status_changes.groupBy(*keys).agg(
        F.count_if(category == "upgrade").alias("upgrade_count"),
        F.count_if(category == "downgrade").alias("downgrade_count"),
        F.count_if(category == "churn").alias("churn_events"),
    )

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return (
        plays.join(views, keys, "left")
        .join(changes, keys, "left")
        .select(
            *keys,
            "first_name",
            "last_name",
            "gender",
            "level",
            "play_count",
            "sessions_with_plays",
            "unique_artists",
            total_minutes().alias("total_listening_minutes"),
            or_zero("page_view_count"),
            or_zero("unique_pages_visited"),
            or_zero("sessions_with_page_views"),
            or_zero("upgrade_count"),
            or_zero("downgrade_count"),
            or_zero("churn_events"),
        )
    )


def hourly_listening_heatmap(listens: DataFrame) -> DataFrame:
    """Per weekday and hour over all dates: plays, listeners and mean length."""
    cells = aggregate(
        listens,
        ["day_of_week", "hour_of_day"],
        [_plays(), *_durations()],
        {"unique_listeners": "user_id"},
    )
    return cells.select(
        "day_of_week",
        "hour_of_day",
        "play_count",
        "unique_listeners",
        mean_minutes().alias("avg_duration_minutes"),
    )


def trend(growth_pct: Column) -> Column:
    """Direction of a (rounded) growth percentage."""
    return (
        F.when(growth_pct > 0, "growth")
        .when(growth_pct < 0, "decline")
        .when(growth_pct == 0, "flat")
        .otherwise("first quarter")
    )


def qoq_listener_growth(listens: DataFrame) -> DataFrame:
    """Distinct listeners per quarter and their growth over the previous existing quarter."""
    quarters = listens.groupBy(_quarter()).agg(
        F.count_distinct("user_id").alias("unique_listeners")
    )
    return _growth(quarters)


def qoq_growth_of_sets(sets: DataFrame) -> DataFrame:
    """The same from stored sets of listeners (see ``sets``), without their plays."""
    return _growth(count_members(sets, [_quarter()], "unique_listeners"))


def _quarter() -> Column:
    return quarter_start(F.col("event_date")).alias("quarter_start")


def _growth(listeners: DataFrame) -> DataFrame:
    quarters = listeners.select(
        "quarter_start",
        quarter_label(F.col("quarter_start")).alias("quarter_label"),
        "unique_listeners",
    )
    now, before = F.col("unique_listeners"), F.col("prev_quarter_listeners")
    grown = lag_over_all(
        quarters, "quarter_start", "unique_listeners", "prev_quarter_listeners"
    ).withColumn("qoq_growth_pct", round_div((now - before) * 100, before, 1))
    return grown.withColumn("trend", trend(F.col("qoq_growth_pct")))


def pipeline_status(tables: dict[str, DataFrame]) -> DataFrame:
    """One readiness row per gold table; all rows share one refresh time."""
    rows = [
        tables[name]
        .agg(F.count("*").alias("rows_loaded"))
        .select(
            F.lit(name).alias("table_name"),
            F.current_timestamp().alias("refreshed_at"),
            F.lit(True).alias("is_ready"),
            "rows_loaded",
        )
        for name in STATUS_TABLES
    ]
    return reduce(DataFrame.unionByName, rows)


def last_refresh(status: DataFrame) -> DataFrame:
    """The refresh time readers may rely on: NULL unless every table is ready."""
    return status.agg(
        F.when(F.every("is_ready"), F.max("refreshed_at")).alias("last_refreshed_at")
    )
