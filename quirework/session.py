"""Session builder and table readers shared by every query."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[1])


def build_session(app: str = "quirework", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE and skew-join handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read lazily so that pruning and pushdown reach the scan.

    Python workers of a session that was started elsewhere find this package by the path set here; on a cluster, install
    it or ship it with ``--py-files``.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new folder below the one that all executors share; only a single-JVM session may fall back to a local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and (not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{found or 'file:///tmp/checkpoints'}/quirework/{what}-{uuid.uuid4().hex}"
