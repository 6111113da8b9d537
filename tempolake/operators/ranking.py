"""Ranking inside a group without collecting the group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Parts that the rows of one partition with the same count are dealt into.
SALTS = 32


def _ranks(counts: DataFrame, partition: str, count: str, rank: str) -> DataFrame:
    """(partition, count, rank) of every count that occurs in a partition."""
    histogram = counts.groupBy(partition, count).agg(F.count("*").alias("_ties"))
    higher = (
        Window.partitionBy(partition)
        .orderBy(F.desc(count))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return histogram.select(
        partition,
        count,
        (F.coalesce(F.sum("_ties").over(higher), F.lit(0)) + 1).alias(rank),
    )


def survivors(counts: DataFrame, keys: Sequence[str], count: str, n: int) -> DataFrame:
    """The keys that rank ``n`` or better by ``count`` within the first key; ties all stay.

    The ranks of the counts that occur give each partition's smallest surviving count, one row
    per partition; the keys below it go before anything else is computed of them.
    """
    partition = keys[0]
    least = (
        _ranks(counts, partition, count, "_rank")
        .filter(F.col("_rank") <= n)
        .groupBy(F.col(partition).alias("_partition"))
        .agg(F.min(count).alias("_least"))
    )
    kept = counts.join(
        least,
        F.col(partition).eqNullSafe(F.col("_partition")) & (F.col(count) >= F.col("_least")),
        "left_semi",
    )
    return kept.select(*keys)


def rows_of(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose keys, nulls included, are among ``kept``."""
    renamed = kept.toDF(*[f"_kept_{c}" for c in kept.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_kept_{c}")) for c in kept.columns]
    return rows.join(renamed, same, "left_semi")


def rank_by_count(
    grouped: DataFrame, counts: DataFrame, partition: str, count: str, rank: str
) -> DataFrame:
    """Add ``rank``: RANK() within ``partition`` by ``count``, highest first, with gaps.

    A rank only depends on how many rows of the partition have a higher count. So the
    window runs over the histogram of counts, whose size per partition is at most the
    square root of twice its total count, instead of sorting every row of a partition in
    one task; the rank is then joined back by (partition, count). Most rows of a partition
    have a count of 1, so the join is salted: the few ranks are repeated for every salt.

    ``counts`` holds (partition, count) for every row of ``grouped``. It is passed
    separately so that it can be computed from a narrow scan.
    """
    ranks = _ranks(counts, partition, count, rank)
    spread = ranks.select(
        F.col(partition).alias("_partition"),
        F.col(count).alias("_count"),
        rank,
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_other_salt"),
    )
    # The ranked thing's name, which is all that many rows of a count differ in.
    name = next(c for c in grouped.columns if c not in (partition, count))
    salted = grouped.withColumn("_salt", F.pmod(F.xxhash64(name), F.lit(SALTS)))
    joined = salted.join(
        spread,
        (F.col("_salt") == F.col("_other_salt"))
        & (F.col(count) == F.col("_count"))
        & F.col(partition).eqNullSafe(F.col("_partition")),
    )
    return joined.select(*grouped.columns, rank)


def top_n(ranked: DataFrame, n: int, rank: str = "daily_rank") -> DataFrame:
    """Rows ranked ``n`` or better; ties at the limit all stay."""
    return ranked.filter(F.col(rank) <= n)


def lag_over_all(rows: DataFrame, order: str, value: str, alias: str) -> DataFrame:
    """Previous ``value`` in the order of a unique column, over all rows.

    One task sees every row, so this is for results bounded by the calendar.
    """
    previous: Column = F.lag(value, 1).over(Window.orderBy(order))
    return rows.withColumn(alias, previous)
