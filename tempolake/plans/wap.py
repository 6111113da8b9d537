"""Write - audit - publish: raw tables to checked silver and gold tables and a ready signal."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tempolake.operators.quality import (
    GOLD_CHECKS,
    SILVER_CHECKS,
    Check,
    WatchedChecks,
    audit,
    failures_of,
)
from tempolake.plans.registry import MODELS, Model, layer_for, schema_of, select_models
from tempolake.plans.warehouse import Day, Warehouse, on_days
from tempolake.sources.bronze import BatchTable

STATUS = "gold_pipeline_status"


@dataclass
class RunReport:
    run_id: int
    silver_audit: list[dict] = field(default_factory=list)
    gold_audit: list[dict] = field(default_factory=list)


class Pipeline:
    """The steps of a run. Each raises on failure, which stops the steps after it.

    ``bronze`` maps raw table names to DataFrames. With ``stage_gold`` the gold tables,
    too, only become current after their audit; otherwise they are current as soon as they
    are built, and only the status table waits for the audit.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        bronze: Mapping[str, DataFrame],
        stage_gold: bool = False,
        dedup_keys: Mapping[str, list[str]] | None = None,
        run_id: int | None = None,
        threads: int = 4,
    ):
        self.warehouse = warehouse
        self.bronze = bronze
        self.stage_gold = stage_gold
        self.dedup_keys = dedup_keys or {}
        self.threads = threads
        self.report = RunReport(run_id or warehouse.new_run_id())
        self._built: dict[str, list[str]] = {"silver": [], "gold": []}
        #: By table, its checks, counted while it was written.
        self.watched: dict[str, WatchedChecks] = {}

    @property
    def run_id(self) -> int:
        return self.report.run_id

    def _build(self, model: Model, target: str, inputs: Mapping[str, DataFrame]) -> None:
        options = {}
        if model.name in self.dedup_keys:
            options["dedup_keys"] = self.dedup_keys[model.name]
        watched = WatchedChecks(model.name, [*SILVER_CHECKS, *GOLD_CHECKS])
        self.warehouse.write(
            model.build(*[inputs[name] for name in model.inputs], **options),
            layer_for(model.layer, target),
            self.run_id,
            model.name,
            model.by_day,
            model.rebalance,
            watched,
        )
        self.watched[model.name] = watched

    def _build_all(
        self, models: list[Model], target: str, inputs: Mapping[str, DataFrame]
    ) -> None:
        """Build models that do not depend on each other, a few at a time.

        Their jobs share the executors, so the tail of one build does not idle the cluster.
        """
        with ThreadPoolExecutor(self.threads) as pool:
            builds = [pool.submit(self._build, m, target, inputs) for m in models]
            for build in builds:
                build.result()
        for model in models:
            self._built[model.layer].append(model.name)

    def _of_this_run(self, layer: str, tables: Iterable[str]) -> dict[str, DataFrame]:
        return {t: self.warehouse.read_run(layer, self.run_id, t) for t in tables}

    def audited(
        self, layer: str, built_in: str, checks: Iterable[Check], again: bool = False
    ) -> list[dict]:
        """The results of all checks of what this run built, in the order of ``checks``.

        Most were counted while the tables were written and only the others read them, unless
        all are to be checked ``again``, as they are stored now.
        """
        own = [c for c in checks if c.table in self._built[layer]]
        results, left = [], own
        if not again:
            results = [r for t in self._built[layer] for r in self.watched[t].results()]
            left = [c for t in self._built[layer] for c in self.watched[t].left]
        if left:
            tables = self._of_this_run(built_in, dict.fromkeys(c.table for c in left))
            results += [r.asDict() for r in audit(tables, left).collect()]
        by_check = {(r["table"], r["column"], r["test"]): r for r in results}
        return [by_check[c.table, c.column, c.test] for c in own]

    def write_silver(self, *selectors: str) -> None:
        """Build silver models (all by default) into the staging area."""
        self._build_all(select_models(*(selectors or ("silver",))), "staging", self.bronze)

    def audit_silver(self) -> None:
        """Check what was staged, as far as possible by what was counted while it was written."""
        staging = layer_for("silver", "staging")
        self.report.silver_audit = self.audited("silver", staging, SILVER_CHECKS)
        failures_of(self.report.silver_audit)

    def publish_silver(self) -> None:
        """Make the staged silver tables current."""
        staging = layer_for("silver", "staging")
        self.warehouse.publish("silver", self.run_id, self._built["silver"], staging)

    def build_gold(self, *selectors: str) -> None:
        """Build gold models (all by default) from the published silver tables."""
        models = select_models(*(selectors or ("gold",)))
        needed = dict.fromkeys(name for m in models for name in m.inputs)
        silver = self.warehouse.read_all("silver", needed)
        self._build_all(models, "dev", silver)
        if not self.stage_gold:
            self._publish_gold()

    def audit_gold(self) -> None:
        """Check the gold tables as they are stored; they are small and already visible."""
        self.report.gold_audit = self.audited("gold", "gold", GOLD_CHECKS, again=True)
        failures_of(self.report.gold_audit)
        if self.stage_gold:
            self._publish_gold()

    def _publish_gold(self) -> None:
        self.warehouse.publish("gold", self.run_id, self._built["gold"])

    def signal(self) -> None:
        """Write the status table, which tells readers that gold is safe to use."""
        status = MODELS[STATUS]
        self._build(status, "dev", self.warehouse.read_all("gold", status.inputs))
        self.warehouse.publish(status.layer, self.run_id, [STATUS])

    def run(self) -> RunReport:
        self.write_silver()
        self.audit_silver()
        self.publish_silver()
        self.build_gold()
        self.audit_gold()
        self.signal()
        return self.report


class ChangedDays(Pipeline):
    """A run that rebuilds the days for which the ingest brought rows since the last run.

    ``tables`` are raw tables with a ledger, which says what days each batch touched. A day is
    rebuilt from all its raw rows, late ones and old ones. Silver tables, and gold tables that
    hold a row's day, get new files for these days only and keep the others; the audit reads
    what this run wrote. The remaining gold tables span all days and are built in full. Tables
    that were never built are built from everything.
    """

    def __init__(self, warehouse: Warehouse, tables: Mapping[str, BatchTable], **options):
        super().__init__(warehouse, {}, **options)
        self.tables = tables
        #: By model, the days this run builds; models that are built in full are left out.
        self.days: dict[str, list[Day]] = {}
        self._batches: dict[str, int] = {}

    def write_silver(self, *selectors: str) -> None:
        models = []
        for model in select_models(*(selectors or ("silver",))):
            table = self.tables[model.inputs[0]]
            last, upto = self.warehouse.built_upto("silver", model.name), table.last_batch()
            rows = table.read(upto)
            if last >= 0:
                # As many as there are days in the calendar, at most.
                days = [r[0] for r in table.days_after(last, upto).collect()]
                self.days[model.name] = days
                if not days:
                    continue
                rows = rows.filter(on_days(days))
            self.bronze = {**self.bronze, model.inputs[0]: rows}
            self._batches[model.name] = upto
            models.append(model)
        self._build_all(models, "staging", self.bronze)

    def publish_silver(self) -> None:
        built = self._built["silver"]
        if built:
            days = {name: d for name, d in self.days.items() if name in built}
            staging = layer_for("silver", "staging")
            self.warehouse.publish("silver", self.run_id, built, staging, days, self._batches)

    def build_gold(self, *selectors: str) -> None:
        models = select_models(*(selectors or ("gold",)))
        silver = self.warehouse.read_all(
            "silver", dict.fromkeys(name for m in models for name in m.inputs)
        )
        current = self.warehouse.published("gold")
        part, whole = [], []
        for model in models:
            changed = {d for name in model.inputs for d in self.days.get(name, [])}
            partial = all(name in self.days for name in model.inputs) and model.name in current
            if partial and not changed:
                continue
            if partial and "event_date" in schema_of(self.warehouse.spark, model.name).names:
                self.days[model.name] = sorted(changed, key=lambda d: (d is not None, d))
                part.append(model)
            else:
                whole.append(model)
        for model in part:
            own = on_days(self.days[model.name])
            self._build_all([model], "dev", {n: silver[n].filter(own) for n in model.inputs})
        self._build_all(whole, "dev", silver)
        if not self.stage_gold:
            self._publish_gold()

    def _publish_gold(self) -> None:
        built = self._built["gold"]
        if built:
            days = {name: self.days[name] for name in built if name in self.days}
            self.warehouse.publish("gold", self.run_id, built, days=days)


def run_wap(warehouse: Warehouse, bronze: Mapping[str, DataFrame], **options) -> RunReport:
    """One full run; see ``Pipeline`` for the options."""
    return Pipeline(warehouse, bronze, **options).run()
