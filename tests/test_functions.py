"""Expression tests on literal rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from tempolake import functions as X
from tempolake.operators.gold import trend
from tempolake.operators.silver import change_category


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("  a b ", "a b"),
        ("\ta\n", "a"),
        (" a　", "a"),
        ("  ", None),
        ("\t", None),
        ("", None),
        (None, None),
        ("ab", "ab"),
    ],
)
def test_clean_text(spark, text, expected):
    assert values(spark, [(text,)], "x string", X.clean_text(F.col("x"))) == [expected]


def test_whitespace_is_the_unicode_property(spark):
    rows = [(i, chr(i)) for i in range(0x3100)]
    frame = spark.createDataFrame(rows, "id int, c string")
    ours = frame.filter(X.clean_text(F.col("c")).isNull())
    regex = frame.filter(F.regexp_replace("c", r"(?U)^\s+|\s+$", "") == "")
    assert ours.exceptAll(regex).count() == 0 and regex.exceptAll(ours).count() == 0


@pytest.mark.parametrize(
    "ms, date, hour, weekday",
    [
        (1735689599999, "2024-12-31", 23, 3),
        (1735689600000, "2025-01-01", 0, 4),
        (1, "1970-01-01", 0, 5),
        (-1, "1969-12-31", 23, 4),
        (-86400000, "1969-12-31", 0, 4),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_time_parts_ignore_the_session_zone(spark, ms, date, hour, weekday, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts = F.col("ts")
        row = (
            spark.createDataFrame([(ms,)], "ts bigint")
            .select(X.utc_date(ts), X.utc_hour(ts), X.day_of_week(X.utc_date(ts)))
            .first()
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (datetime.date.fromisoformat(date), hour, weekday)


def test_event_time_keeps_milliseconds(spark):
    (micros,) = values(
        spark, [(1735689599999,)], "ts bigint", F.unix_micros(X.event_time(F.col("ts")))
    )
    assert micros == 1735689599999000


def test_unusable_times(spark):
    rows = [(None,), (9_000_000_000_000_000_000,), (253_402_300_800_000,), (5,)]
    dates = values(spark, rows, "ts bigint", X.utc_date(X.valid_ms(F.col("ts"))))
    assert dates == [None, None, None, datetime.date(1970, 1, 1)]


def test_week_of_year_matches_strftime(spark):
    start = datetime.date(1995, 1, 1)
    rows = [(start + datetime.timedelta(days=i),) for i in range(0, 366 * 31)]
    weeks = values(spark, rows, "d date", X.week_of_year(F.col("d")))
    assert weeks == [int(d.strftime("%U")) for (d,) in rows]


def test_quarter_label(spark):
    rows = [(datetime.date(2025, 3, 31),), (datetime.date(987, 12, 1),)]
    assert values(spark, rows, "d date", X.quarter_label(F.col("d"))) == ["2025-Q1", "0987-Q4"]


def test_quarter_ranges_are_clipped(spark):
    d = datetime.date
    rows = [(d(2024, 2, 10), d(2024, 8, 5)), (d(2024, 5, 1), d(2024, 4, 1))]
    frame = spark.createDataFrame(rows, "s date, e date")
    found = frame.select(F.inline(X.quarter_ranges(F.col("s"), F.col("e")))).collect()
    assert [tuple(r) for r in found] == [
        (d(2024, 2, 10), d(2024, 3, 31), "2024_Q1"),
        (d(2024, 4, 1), d(2024, 6, 30), "2024_Q2"),
        (d(2024, 7, 1), d(2024, 8, 5), "2024_Q3"),
    ]


def test_round_div(spark):
    rows = [(1, 3), (-1, 3), (5, 1000), (-5, 1000), (4, 1000), (0, 7), (1, 0), (None, 1)]
    result = values(
        spark, rows, "a bigint, b bigint", X.round_div(F.col("a"), F.col("b"), 2)
    )
    assert result == [0.33, -0.33, 0.01, -0.01, 0.0, 0.0, None, None]


def test_durations_are_exact_and_do_not_overflow(spark):
    """Sums beyond the bigint range in microseconds, and values with five decimals."""
    frame = spark.range(4).select(
        F.when(F.col("id") < 3, F.lit(4e12)).otherwise(F.lit(277.15873)).alias("seconds")
    )
    row = frame.agg(*X.duration_sums(F.col("seconds"))).select(
        X.total_hours(), X.total_minutes(), X.mean_minutes()
    )
    hours, minutes, mean = row.first()
    assert hours == round((12e12 + 277.15873) / 3600, 2)
    assert minutes == round((12e12 + 277.15873) / 60, 2)
    assert mean == round((12e12 + 277.15873) / 240, 2)


def test_durations_without_values(spark):
    frame = spark.createDataFrame([(None,)], "seconds double")
    row = frame.agg(*X.duration_sums(F.col("seconds"))).select(X.total_hours(), X.mean_minutes())
    assert tuple(row.first()) == (None, None)


def test_cohort(spark):
    rows = [(1,), (10_000,), (10_001,), (None,)]
    assert values(spark, rows, "u bigint", X.cohort(F.col("u"))) == [
        "control", "control", "test", None,
    ]


def test_change_category(spark):
    rows = [("PAID",), ("free",), ("trial",), (None,)]
    assert values(spark, rows, "l string", change_category(F.col("l"))) == [
        "upgrade", "downgrade", "other", "other",
    ]


def test_trend(spark):
    rows = [(0.1,), (-0.1,), (0.0,), (None,)]
    assert values(spark, rows, "g double", trend(F.col("g"))) == [
        "growth", "decline", "flat", "first quarter",
    ]
