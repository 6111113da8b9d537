"""Data-quality checks. Each counts failures; a table passes when all counts are zero."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    test: str  # not_null | unique | accepted_values
    values: tuple[str, ...] = ()


# The checks of each layer.
SILVER_CHECKS = (
    Check("silver_listen_events", "user_id", "not_null"),
    Check("silver_listen_events", "artist", "not_null"),
    Check("silver_listen_events", "song", "not_null"),
    Check("silver_listen_events", "duration_seconds", "not_null"),
    Check("silver_listen_events", "level", "accepted_values", ("paid", "free")),
    Check("silver_listen_events", "event_timestamp", "not_null"),
    Check("silver_listen_events", "event_date", "not_null"),
    Check("silver_page_view_events", "user_id", "not_null"),
    Check("silver_page_view_events", "event_date", "not_null"),
    Check("silver_auth_events", "user_id", "not_null"),
    Check("silver_auth_events", "event_date", "not_null"),
    Check("silver_status_change_events", "user_id", "not_null"),
    Check(
        "silver_status_change_events",
        "change_category",
        "accepted_values",
        ("upgrade", "downgrade", "churn", "other"),
    ),
)
GOLD_CHECKS = (
    Check("gold_daily_listening_stats", "event_date", "not_null"),
    Check("gold_daily_listening_stats", "event_date", "unique"),
    Check("gold_daily_listening_stats", "total_plays", "not_null"),
    Check("gold_top_artists_daily", "event_date", "not_null"),
    Check("gold_top_artists_daily", "artist", "not_null"),
    Check("gold_top_songs_daily", "event_date", "not_null"),
    Check("gold_top_songs_daily", "song", "not_null"),
    Check("gold_user_activity_daily", "event_date", "not_null"),
    Check("gold_user_activity_daily", "user_id", "not_null"),
    Check("gold_hourly_listening_heatmap", "day_of_week", "not_null"),
    Check("gold_hourly_listening_heatmap", "hour_of_day", "not_null"),
    Check("gold_qoq_listener_growth", "quarter_start", "not_null"),
    Check("gold_qoq_listener_growth", "quarter_start", "unique"),
    Check("gold_qoq_listener_growth", "quarter_label", "not_null"),
    Check("gold_qoq_listener_growth", "unique_listeners", "not_null"),
)


class AuditFailed(Exception):
    """Raised when a check of an audited layer reports failures."""

    def __init__(self, failed: list[dict]):
        self.failed = failed
        lines = [f"{r['table']}.{r['column']} {r['test']}: {r['failures']}" for r in failed]
        super().__init__("; ".join(lines))


def not_null(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, failures): rows with NULL, for all columns in one pass."""
    columns = list(columns)
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns]
    )
    return counts.select(F.inline(pairs))


def unique(rows: DataFrame, column: str) -> DataFrame:
    """(column, failures): distinct non-NULL values that occur more than once."""
    repeated = (
        rows.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("_n"))
        .filter("_n > 1")
    )
    return _count_as_failures(repeated, column)


def accepted_values(rows: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """(column, failures): distinct values outside the list; NULL passes."""
    outside = rows.filter(~F.col(column).isin(*values)).select(column).distinct()
    return _count_as_failures(outside, column)


def _count_as_failures(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.count("*").alias("failures")).select(
        F.lit(column).alias("column"), "failures"
    )


def _in_one_pass(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """(column, test, failures) of not_null and accepted_values checks, in one scan."""
    counts = []
    for i, check in enumerate(checks):
        column = F.col(check.column)
        if check.test == "not_null":
            failures = F.count_if(column.isNull())
        else:
            failures = F.count_distinct(F.when(~column.isin(*check.values), column))
        counts.append(failures.alias(f"_{i}"))
    rows_of = [
        F.struct(
            F.lit(check.column).alias("column"),
            F.lit(check.test).alias("test"),
            F.col(f"_{i}").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return rows.agg(*counts).select(F.inline(F.array(*rows_of)))


def audit(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """(table, column, test, failures), one row per check.

    All checks of a table but those for uniqueness share one scan of just the checked columns;
    these add one narrow aggregate each. Everything runs as one query.
    """
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)

    def tagged(result: DataFrame, table: str) -> DataFrame:
        return result.select(F.lit(table).alias("table"), "column", "test", "failures")

    parts = []
    for table, own in by_table.items():
        rows = tables[table]
        together = [c for c in own if c.test != "unique"]
        if together:
            parts.append(tagged(_in_one_pass(rows, together), table))
        for check in own:
            if check.test == "unique":
                result = unique(rows, check.column).withColumn("test", F.lit("unique"))
                parts.append(tagged(result, table))
    return reduce(DataFrame.unionByName, parts)


class WatchedChecks:
    """The checks of one table, counted while it is written.

    ``watch`` adds the counts to the rows on their way to the sink. Afterwards ``results`` has
    all checks that need no other look at the table; ``left`` are those that do: uniqueness, and
    accepted values of which some row was outside, whose different values are still to be counted.
    """

    def __init__(self, table: str, checks: Iterable[Check]):
        self.checks = [c for c in checks if c.table == table]
        self._observation = Observation()
        self._counts: dict[str, int] | None = None

    def watch(self, rows: DataFrame) -> DataFrame:
        counts = [F.count("*").alias("rows")]
        for i, check in enumerate(self.checks):
            column = F.col(check.column)
            if check.test == "not_null":
                counts.append(F.count_if(column.isNull()).alias(f"_{i}"))
            elif check.test == "accepted_values":
                counts.append(F.count_if(~column.isin(*check.values)).alias(f"_{i}"))
        return rows.observe(self._observation, *counts)

    def _seen(self) -> dict[str, int]:
        if self._counts is None:
            self._counts = self._observation.get
        return self._counts

    @property
    def rows(self) -> int:
        """How many rows were written."""
        return self._seen()["rows"]

    def _is_left(self, number: int, check: Check) -> bool:
        if check.test == "unique":
            return True
        return check.test == "accepted_values" and self._seen()[f"_{number}"] > 0

    @property
    def left(self) -> list[Check]:
        return [c for i, c in enumerate(self.checks) if self._is_left(i, c)]

    def results(self) -> list[dict]:
        """(table, column, test, failures) of all checks but those that are ``left``."""
        return [
            {"table": c.table, "column": c.column, "test": c.test, "failures": self._seen()[f"_{i}"]}
            for i, c in enumerate(self.checks)
            if not self._is_left(i, c)
        ]


def failures_of(results: Iterable[dict]) -> None:
    """Raise ``AuditFailed`` if any of the results has failures."""
    failed = [r for r in results if r["failures"] > 0]
    if failed:
        raise AuditFailed(failed)


def require_passed(audited: DataFrame) -> list[dict]:
    """Run an audit (one row per check) and raise ``AuditFailed`` on any failure."""
    rows = [r.asDict() for r in audited.collect()]
    failures_of(rows)
    return rows
