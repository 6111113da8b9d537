"""The models, their inputs, and how they are selected and routed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempolake.operators import gold, silver
from tempolake.schemas import TOPICS


@dataclass(frozen=True)
class Model:
    """A table built from other tables.

    ``build`` takes the inputs in order. ``by_day`` tables are stored by ``event_date``;
    ``rebalance`` says whether rows have to be brought together by day first (results of a
    shuffle) or already come day by day (projections of a raw table).
    """

    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    by_day: bool = False
    rebalance: bool = False


_ALL = (
    Model("silver_listen_events", "silver", ("listen_events",), silver.silver_listen_events, by_day=True),
    Model("silver_auth_events", "silver", ("auth_events",), silver.silver_auth_events, by_day=True),
    Model(
        "silver_page_view_events",
        "silver",
        ("page_view_events",),
        silver.silver_page_view_events,
        by_day=True,
    ),
    Model(
        "silver_status_change_events",
        "silver",
        ("status_change_events",),
        silver.silver_status_change_events,
        by_day=True,
    ),
    Model(
        "gold_daily_listening_stats",
        "gold",
        ("silver_listen_events",),
        gold.daily_listening_stats,
    ),
    Model(
        "gold_top_artists_daily",
        "gold",
        ("silver_listen_events",),
        gold.top_artists_daily,
        by_day=True,
        rebalance=True,
    ),
    Model(
        "gold_top_songs_daily",
        "gold",
        ("silver_listen_events",),
        gold.top_songs_daily,
        by_day=True,
        rebalance=True,
    ),
    Model(
        "gold_hourly_listening_heatmap",
        "gold",
        ("silver_listen_events",),
        gold.hourly_listening_heatmap,
    ),
    Model(
        "gold_user_activity_daily",
        "gold",
        ("silver_listen_events", "silver_page_view_events", "silver_status_change_events"),
        gold.user_activity_daily,
        by_day=True,
        rebalance=True,
    ),
    Model(
        "gold_qoq_listener_growth",
        "gold",
        ("silver_listen_events",),
        gold.qoq_listener_growth,
    ),
    Model(
        "gold_pipeline_status",
        "status",
        gold.STATUS_TABLES,
        lambda *tables: gold.pipeline_status(dict(zip(gold.STATUS_TABLES, tables, strict=True))),
    ),
)
MODELS: dict[str, Model] = {m.name: m for m in _ALL}


def schema_of(spark: SparkSession, name: str) -> T.StructType:
    """The columns of a model, or of a raw table, in order, whether or not it has rows."""
    if name in TOPICS:
        return TOPICS[name].bronze_schema
    model = MODELS[name]
    inputs = [spark.createDataFrame([], schema_of(spark, i)) for i in model.inputs]
    return model.build(*inputs).schema


def select_models(*selectors: str) -> list[Model]:
    """Models by layer (``silver``, ``gold``) or by name, inputs before their users.

    The status model is no part of the gold layer: it is only built by name, after the
    gold checks have passed.
    """
    chosen = []
    for selector in selectors:
        found = [m for m in MODELS.values() if selector in (m.name, m.layer)]
        if not found:
            raise KeyError(f"no model or layer named {selector!r}")
        chosen += found
    return [m for m in MODELS.values() if m in chosen]


def layer_for(layer: str | None, target: str, default: str = "dev") -> str:
    """Where a layer's tables go for a target: staging re-routes silver, nothing else."""
    if layer is None:
        return default
    name = layer.strip()
    return "silver_staging" if target == "staging" and name == "silver" else name
