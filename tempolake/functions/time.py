"""Date and time expressions.

Everything is computed in UTC from epoch milliseconds with integer arithmetic, so no
result depends on the session time zone. Only the *display* of a timestamp does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000

# Epoch milliseconds of 0000-01-01T00:00:00.000 and 9999-12-31T23:59:59.999;
# an event time outside this range counts as missing.
MIN_EVENT_MS = -62_167_219_200_000
MAX_EVENT_MS = 253_402_300_799_999


def valid_ms(ts: Column) -> Column:
    """``ts`` where it is a representable event time, else NULL."""
    return F.when(ts.between(MIN_EVENT_MS, MAX_EVENT_MS), ts)


def event_time(ts: Column) -> Column:
    """Timestamp of an epoch-millisecond value, keeping the milliseconds."""
    return F.timestamp_millis(ts)


def utc_date(ts: Column) -> Column:
    """UTC calendar date of an epoch-millisecond value (floors before 1970, too)."""
    day = (ts - F.pmod(ts, F.lit(MS_PER_DAY))) / MS_PER_DAY
    return F.date_from_unix_date(day.cast("int"))


def utc_hour(ts: Column) -> Column:
    """UTC hour of day, 0-23."""
    return F.floor(F.pmod(ts, F.lit(MS_PER_DAY)) / MS_PER_HOUR).cast("int")


def day_of_week(date: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(date)


def week_of_year(date: Column) -> Column:
    """Sunday-based week number, 0-53; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(date) + 7 - F.dayofweek(date)) / 7).cast("int")


def quarter_start(date: Column) -> Column:
    return F.trunc(date, "quarter")


def quarter_label(date: Column) -> Column:
    """``2025-Q1`` for a date in that quarter."""
    return F.concat(
        F.lpad(F.year(date).cast("string"), 4, "0"), F.lit("-Q"), F.quarter(date).cast("string")
    )


def quarter_ranges(start: Column, end: Column) -> Column:
    """The calendar quarters that meet [start, end], clipped to it, as an array of structs.

    Each struct is (range_start, range_end, label) with labels like ``2025_Q1``. The array
    holds one entry per quarter, so it is bounded by the calendar; ``explode`` it for rows.
    """
    firsts = F.sequence(quarter_start(start), end, F.expr("interval 3 months"))

    def clip(first: Column) -> Column:
        last = F.date_sub(F.add_months(first, 3), 1)
        return F.struct(
            F.greatest(first, start).alias("range_start"),
            F.least(last, end).alias("range_end"),
            F.replace(quarter_label(first), F.lit("-"), F.lit("_")).alias("label"),
        )

    return F.when(start <= end, F.transform(firsts, clip))
