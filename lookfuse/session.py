"""Session settings the plans are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app_name: str = "lookfuse", settings: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on; ``settings`` are further Spark settings by full name."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which a cluster sets to storage all executors share.

    Where it is unset, a local session uses a new folder below the system's temporary one, which all its tasks see; on
    a cluster that would be another folder on every machine, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"run-{purpose}-")
