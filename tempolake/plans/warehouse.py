"""Tables on shared storage: every build goes to its own run folder, readers follow a pointer.

``<root>/<layer>/run_id=<n>/<table>/`` holds the data. ``<root>/<layer>_published`` is an
append-only list of (table, run_id, location, sequence, days, batch) rows; the run of a table that
was published last is the current one. Publishing appends one file with all tables of a run, so
they become visible together, nothing is copied, and readers of the previous run are not disturbed.

A run that built some days only is published for these ``days``: the others stay with the runs
that built them. Unlike an overwrite of partitions in place, this leaves no moment in which a
reader sees some of the new days, or none of a day. ``batch`` says up to which batch of the ingest
a table was built.
"""

from __future__ import annotations

import datetime
import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolake.operators.quality import WatchedChecks
from tempolake.plans.registry import MODELS, schema_of

LAYERS = ("bronze", "silver", "gold")


class NotPublished(LookupError):
    """The table has no published run yet."""


Day = datetime.date | None


def on_days(days: Iterable[Day]) -> str:
    """The condition that a row's event_date is one of ``days``, None being no date."""
    known = sorted(d for d in days if d is not None)
    parts = [f"event_date IN ({', '.join(f'DATE {str(d)!r}' for d in known)})"] if known else []
    if None in days:
        parts.append("event_date IS NULL")
    return f"({' OR '.join(parts)})" if parts else "FALSE"


@dataclass(frozen=True)
class Part:
    """The days of a table that one run built: ``days``, or all but ``other``."""

    location: str
    days: tuple[Day, ...] | None
    other: tuple[Day, ...] = ()

    @property
    def condition(self) -> str | None:
        if self.days is not None:
            return on_days(self.days)
        # Not true or unknown: rows without a date are kept unless None is among the others.
        return f"NOT coalesce({on_days(self.other)}, FALSE)" if self.other else None


class Warehouse:
    _POINTER = (
        "table string, run_id bigint, location string, sequence bigint, "
        "days array<date>, batch bigint"
    )

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @staticmethod
    def new_run_id() -> int:
        return time.time_ns() // 1_000

    def path(self, layer: str, run_id: int, table: str) -> str:
        return f"{self.root}/{layer}/run_id={run_id}/{table}"

    def create_layers(self, layers: Iterable[str] = LAYERS) -> None:
        """Create the layers' databases; existing ones are left alone."""
        for layer in layers:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")

    def write(
        self,
        rows: DataFrame,
        layer: str,
        run_id: int,
        table: str,
        by_day: bool = False,
        rebalance: bool = False,
        watched: WatchedChecks | None = None,
    ) -> None:
        """Replace a table of a run in full.

        The rebalance groups rows by day for few files per day, and splits days that are
        larger than a target file, so no day is written by a single task. ``watched`` checks are
        counted by the tasks that write, which count once however often a stage before runs.
        """
        if rebalance:
            rows = rows.hint("rebalance", "event_date")
        if watched:
            rows = watched.watch(rows)
        writer = rows.write.mode("overwrite")
        if by_day:
            writer = writer.partitionBy("event_date")
        writer.parquet(self.path(layer, run_id, table))

    def _load(self, location: str, table: str) -> DataFrame:
        """A stored table with its columns in order; a table of no rows has no file to ask."""
        if table not in MODELS:
            return self.spark.read.parquet(location)
        schema = schema_of(self.spark, table)
        return self.spark.read.schema(schema).parquet(location).select(*schema.names)

    def _load_parts(self, parts: list[Part], table: str, origin: str | None) -> DataFrame:
        rows = []
        for part in parts:
            own = self._load(part.location, table)
            if part.condition:
                own = own.filter(part.condition)
            if origin:
                own = own.select("*", F.col("_metadata.file_path").alias(origin))
            rows.append(own)
        return reduce(DataFrame.unionByName, rows)

    def read_run(self, layer: str, run_id: int, table: str) -> DataFrame:
        return self._load(self.path(layer, run_id, table), table)

    def publish(
        self,
        layer: str,
        run_id: int,
        tables: Iterable[str],
        built_in: str | None = None,
        days: Mapping[str, Iterable[Day]] | None = None,
        batches: Mapping[str, int] | None = None,
    ) -> None:
        """Make a run's tables the current ones of ``layer``, all at once.

        ``built_in`` names the layer they were written to, if another (a staging layer). An
        older run that is published again becomes current again. Tables in ``days`` are
        replaced for these days only. ``batches`` notes the batch a table was built up to.
        """
        now = time.time_ns()
        rows = [
            (
                t,
                run_id,
                self.path(built_in or layer, run_id, t),
                now,
                list(days[t]) if days and t in days else None,
                (batches or {}).get(t),
            )
            for t in tables
        ]
        entries = self.spark.createDataFrame(rows, self._POINTER)
        entries.coalesce(1).write.mode("append").parquet(f"{self.root}/{layer}_published")

    def _log(self, layer: str) -> DataFrame:
        try:
            return self.spark.read.schema(self._POINTER).parquet(f"{self.root}/{layer}_published")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], self._POINTER)
            raise

    def published(self, layer: str) -> dict[str, list[Part]]:
        """The parts of the current version of each table of a layer.

        Collects the publications since each table's last full one, a handful of rows.
        """
        order = F.struct("sequence", "run_id")
        log = self._log(layer)
        full = log.filter("days IS NULL").groupBy("table").agg(F.max(order).alias("full"))
        since = log.join(full, "table").filter(F.struct("sequence", "run_id") >= F.col("full"))
        found: dict[str, list[Part]] = {}
        for entry in since.orderBy(F.desc("sequence"), F.desc("run_id")).collect():
            parts = found.setdefault(entry.table, [])
            newer = [d for part in parts for d in part.days]
            if entry.days is None:
                parts.append(Part(entry.location, None, tuple(newer)))
            else:
                own = tuple(d for d in entry.days if d not in newer)
                if own:
                    parts.append(Part(entry.location, own))
        return found

    def built_upto(self, layer: str, table: str) -> int:
        """The batch of the ingest up to which a table was built; -1 if there is none."""
        last = self._log(layer).filter(F.col("table") == table).agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def read_all(
        self, layer: str, tables: Iterable[str], origin: str | None = None
    ) -> dict[str, DataFrame]:
        """The current versions of several tables, as of one moment.

        ``origin`` names an additional column with the file that a row comes from.
        """
        current = self.published(layer)
        missing = [t for t in tables if t not in current]
        if missing:
            raise NotPublished(f"{layer}: {', '.join(missing)}")
        return {t: self._load_parts(current[t], t, origin) for t in tables}

    def read(self, layer: str, table: str, origin: str | None = None) -> DataFrame:
        return self.read_all(layer, [table], origin)[table]

    def compact(self, layer: str, table: str, run_id: int) -> None:
        """Write the current version of a table that is stored by day as one run.

        Every publication of some days adds a part that readers have to union; this starts anew.
        """
        batch = self.built_upto(layer, table)
        self.write(self.read(layer, table), layer, run_id, table, by_day=True, rebalance=True)
        self.publish(layer, run_id, [table], batches={table: batch})

    def copy(self, source: tuple[str, int, str], target: tuple[str, int, str]) -> None:
        """Force-copy a table: the target is replaced in full."""
        rows = self.read_run(*source)
        by_day = "event_date" in rows.columns
        writer = rows.write.mode("overwrite")
        (writer.partitionBy("event_date") if by_day else writer).parquet(self.path(*target))

    def create_views(self, layer: str) -> list[str]:
        """Expose the current tables to SQL as ``<layer>.<table>``; rerun after publishing."""
        self.create_layers([layer])
        current = self.published(layer)
        for table, parts in current.items():
            columns = "*"
            if table in MODELS:
                columns = ", ".join(f"`{c}`" for c in schema_of(self.spark, table).names)
            selects = [
                f"SELECT {columns} FROM parquet.`{part.location}`"
                + (f" WHERE {part.condition}" if part.condition else "")
                for part in parts
            ]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {layer}.{table} AS {' UNION ALL '.join(selects)}"
            )
        return sorted(current)
