"""Exact sets of listeners that can be stored once and united later.

A set is a bitmap per (day, hour, bucket of 64 ids), one whole number: a set never takes more rows
than it has users, however far apart their ids are, and is united in place in a hash table. Days,
weekdays and hours, quarters or any other span are unions of sets that were stored for their days,
so a new day adds its own sets and no play is read again. Ids are whole numbers, negative ones
included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("event_date", "hour_of_day")


def listener_sets(listens: DataFrame, user: str = "user_id") -> DataFrame:
    """(event_date, hour_of_day, bucket, users): the users of each hour of each day."""
    known = listens.filter(F.col(user).isNotNull())
    number = F.col(user).cast("bigint")
    place = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int")
    )
    return known.groupBy(*KEYS, F.shiftright(number, 6).alias("bucket")).agg(
        F.bit_or(place).alias("users")
    )


def unite(sets: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The sets of coarser groups: (keys, bucket, users)."""
    return sets.groupBy(*keys, "bucket").agg(F.bit_or("users").alias("users"))


def count_members(sets: DataFrame, keys: Sequence[str | Column], alias: str) -> DataFrame:
    """(keys, alias): how many different users each group has."""
    united = unite(sets, keys)
    names = [c for c in united.columns if c not in ("bucket", "users")]
    return united.groupBy(*names).agg(F.sum(F.bit_count("users")).alias(alias))
