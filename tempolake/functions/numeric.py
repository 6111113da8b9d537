"""Exact sums, means and ratios, rounded half away from zero.

A sum of doubles depends on the order in which tasks finish, so a rounded total could
change between two runs over the same data. Durations are therefore summed as whole
seconds plus whole microseconds (two bigint sums, which neither overflow nor lose
anything at 10^12 rows per group) and only the rounded result is a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def _whole(numerator: Column, denominator: Column) -> Column:
    """Exact integer quotient of two integral columns, truncated."""
    return F.call_function("div", numerator, denominator)


def round_div(numerator: Column, denominator: Column, digits: int) -> Column:
    """round(numerator / denominator, digits) on integers; NULL for a zero denominator.

    The denominator must not be negative. Halves go away from zero.
    """
    scale = 10**digits
    den = F.nullif(denominator, F.lit(0))
    quotient = _whole(F.abs(numerator) * (2 * scale) + den, den * 2)
    return F.signum(numerator) * quotient / F.lit(float(scale))


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent with one digit; NULL when the whole is 0 or NULL."""
    return round_div(part * 100, whole, 1)


def duration_sums(seconds: Column, prefix: str = "_d") -> list[Column]:
    """Aggregate columns from which ``total_*`` and ``mean_minutes`` are derived."""
    # A length that is no finite number counts as none: it must not swallow the whole sum.
    seconds = F.when((F.abs(seconds) < float("inf")) & ~F.isnan(seconds), seconds)
    micros = F.floor(seconds * MICROS + 0.5)
    return [
        F.sum(_whole(micros, F.lit(MICROS))).alias(f"{prefix}_s"),
        F.sum(micros % MICROS).alias(f"{prefix}_us"),
        F.count(seconds).alias(f"{prefix}_n"),
    ]


def _total_micros(prefix: str) -> Column:
    return F.col(f"{prefix}_s").cast("decimal(38,0)") * MICROS + F.col(f"{prefix}_us")


def total_hours(prefix: str = "_d") -> Column:
    return round_div(_total_micros(prefix), F.lit(3600 * MICROS), 2)


def total_minutes(prefix: str = "_d") -> Column:
    return round_div(_total_micros(prefix), F.lit(60 * MICROS), 2)


def mean_minutes(prefix: str = "_d") -> Column:
    return round_div(_total_micros(prefix), F.col(f"{prefix}_n") * (60 * MICROS), 2)
