"""Silver models: one cleaned, typed table per event type.

Every model is a narrow projection and filter over its raw table: no shuffle, the not-null
filters reach the Parquet scan and only the referenced columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolake.functions import (
    clean_text,
    day_of_week,
    event_time,
    trim_all,
    utc_date,
    utc_hour,
    week_of_year,
)
from tempolake.schemas import EXCLUDED_PAGES


def _ids() -> list[Column]:
    return [
        F.col("userId").cast("bigint").alias("user_id"),
        F.col("sessionId").cast("bigint").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
    ]


def _level() -> Column:
    return F.lower("level").alias("level")


def _is_paid() -> Column:
    # Compares the raw level on purpose: 'PAID' is level 'paid' but not is_paid.
    return (F.col("level") == "paid").alias("is_paid")


def _person() -> list[Column]:
    return [
        F.col("gender"),
        clean_text(F.col("firstName")).alias("first_name"),
        clean_text(F.col("lastName")).alias("last_name"),
    ]


def _when() -> list[Column]:
    ts = F.col("ts")
    return [
        event_time(ts).alias("event_timestamp"),
        F.col("event_date"),
        utc_hour(ts).alias("hour_of_day"),
        day_of_week(utc_date(ts)).alias("day_of_week"),
    ]


def _known_users(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("userId").isNotNull())


def _one_per_key(rows: DataFrame, dedup_keys: Sequence[str] | None) -> DataFrame:
    """With ``dedup_keys`` one row per key (off by default), after all filters.

    The earliest row stays; the other columns in order break ties, so the choice does not
    depend on how the rows lie in files.
    """
    if not dedup_keys:
        return rows
    first = ["ts", "itemInSession"]
    order = [*first, *sorted(c for c in rows.columns if c not in first)]
    kept = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in dedup_keys]).agg(
        F.min(F.struct(*order)).alias("_row")
    )
    return kept.select("_row.*").select(*rows.columns)


def silver_listen_events(
    bronze: DataFrame, dedup_keys: Sequence[str] | None = None
) -> DataFrame:
    """Plays with a user, a song and an artist.

    The song and artist filters look at the raw text, so a blank artist passes and becomes
    NULL; the layer's not_null check is what reports it.
    """
    return (
        _one_per_key(
            _known_users(bronze).filter(F.col("song").isNotNull() & F.col("artist").isNotNull()),
            dedup_keys,
        ).select(
            *_ids(),
            clean_text(F.col("artist")).alias("artist"),
            clean_text(F.col("song")).alias("song"),
            F.col("length").cast("double").alias("duration_seconds"),
            _level(),
            _is_paid(),
            *_person(),
            F.col("userAgent").alias("user_agent"),
            F.col("registration"),
            *_when(),
            week_of_year(utc_date(F.col("ts"))).alias("week_of_year"),
        )
    )


def silver_page_view_events(
    bronze: DataFrame, dedup_keys: Sequence[str] | None = None
) -> DataFrame:
    """Page views of user-facing pages; rows without a page are dropped as well."""
    # Filtered by the trimmed text, which the condition then holds once, however far it is pushed.
    kept = _known_users(bronze).filter(~trim_all(F.col("page")).isin("", *EXCLUDED_PAGES))
    return (
        _one_per_key(kept.withColumn("page", clean_text(F.col("page"))), dedup_keys)
        .select(
            *_ids(),
            F.col("page"),
            _level(),
            _is_paid(),
            *_person(),
            clean_text(F.col("userAgent")).alias("user_agent"),
            *_when(),
            F.col("method").alias("http_method"),
            F.col("status").alias("http_status"),
            F.col("auth"),
            F.col("registration"),
        )
    )


def silver_auth_events(bronze: DataFrame, dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """Sign-in attempts with their outcome."""
    return _one_per_key(_known_users(bronze), dedup_keys).select(
        *_ids(),
        F.col("success").alias("is_successful"),
        _level(),
        _is_paid(),
        *_person(),
        F.col("registration"),
        *_when(),
    )


def change_category(level: Column) -> Column:
    """Direction of a subscription change, read off the resulting level."""
    new_level = F.lower(level)
    return (
        F.when(new_level == "paid", "upgrade")
        .when(new_level == "free", "downgrade")
        .otherwise("other")
    )


def silver_status_change_events(
    bronze: DataFrame, dedup_keys: Sequence[str] | None = None
) -> DataFrame:
    """Subscription changes with their direction."""
    return _one_per_key(_known_users(bronze), dedup_keys).select(
        *_ids(),
        _level(),
        change_category(F.col("level")).alias("change_category"),
        F.col("auth").alias("auth_status"),
        *_person(),
        F.col("registration"),
        *_when(),
    )
