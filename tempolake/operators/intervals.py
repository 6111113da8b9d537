"""Joins of dates with date ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_ranges(
    points: DataFrame,
    ranges: DataFrame,
    date: str,
    start: str,
    end: str,
    on: Sequence[str] = (),
) -> DataFrame:
    """Points with every range (both ends included) that holds their date, by equal ``on``.

    A range is repeated for the months it meets, so the join is one of equal (``on``, month)
    and a filter on the dates; without the months each point would meet each range. Dates in no
    range, null dates and ranges without or with crossed ends give no rows.
    """
    first = F.trunc(start, "month")
    months = F.sequence(first, F.col(end), F.expr("interval 1 month"))
    valid = ranges.filter(F.col(start) <= F.col(end))
    binned = valid.withColumn("_month", F.explode(months))
    dated = points.withColumn("_month", F.trunc(date, "month"))
    joined = dated.join(binned, [*on, "_month"]).drop("_month")
    return joined.filter(F.col(date).between(F.col(start), F.col(end)))
