"""Event analytics on Spark: raw event streams to checked silver and gold tables."""

from tempolake.plans.registry import MODELS, Model, layer_for, select_models
from tempolake.plans.wap import Pipeline, RunReport, run_wap
from tempolake.plans.warehouse import NotPublished, Warehouse
from tempolake.schemas import TOPICS, Topic
from tempolake.session import build_session, require_utc

__all__ = [
    "MODELS",
    "TOPICS",
    "Model",
    "NotPublished",
    "Pipeline",
    "RunReport",
    "Topic",
    "Warehouse",
    "build_session",
    "layer_for",
    "require_utc",
    "run_wap",
    "select_models",
]
