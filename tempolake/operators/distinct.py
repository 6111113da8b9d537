"""Exact distinct counts next to ordinary aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate(
    rows: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    distincts: dict[str, str],
) -> DataFrame:
    """``measures`` plus one exact distinct count per ``distincts`` entry (alias -> column).

    Several distinct counts in one aggregate make Spark copy each row once per counted
    column and hash copies that carry all of those columns. That is fine while the hash
    table fits a task, and slow once it spills. Here each column gets its own branch,
    which reads just the keys and that column and first shuffles on both, so one hot key
    spreads over all tasks. The branches meet again in a union with one row per key and
    branch, of which one more grouping takes the values; NULL is a key like any other.
    """
    named = list(distincts.items())
    if not named:
        return rows.groupBy(*keys).agg(*measures)
    alias, column = named[0]
    first = rows.groupBy(*keys).agg(*measures, F.count_distinct(column).alias(alias))
    if len(named) == 1:
        return first
    branches = [
        rows.groupBy(*keys).agg(F.count_distinct(column).alias(alias))
        for alias, column in named[1:]
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches, first)
    values = [c for c in together.columns if c not in keys]
    return together.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])
