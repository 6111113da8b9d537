"""Session helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "tempolake", master: str | None = None, **conf: str):
    """A session with the settings the jobs are written for; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC and fail when that does not take effect."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != "UTC":
        raise RuntimeError(f"session time zone is {zone!r}, need UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, else that of the warehouse.

    Both have to be shared by all executors, so on a cluster a warehouse on a local disk will
    not do.
    """
    checkpoints = spark.conf.get("spark.checkpoint.dir", None)
    if checkpoints:
        return checkpoints.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = warehouse.startswith(("/", "file:")) or ":" not in warehouse
    if local and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set spark.checkpoint.dir: executors do not share {warehouse}")
    return warehouse.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the shared one.

    What runs write lies in ``<folder>/tempolake/``, whose owner decides how long to keep it.
    """
    return f"{shared_dir(spark)}/tempolake/{purpose}-{uuid.uuid4().hex}"
