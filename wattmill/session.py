"""Session settings that the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "wattmill", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; `conf` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": os.environ.get("WATTMILL_UI", "false"),
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Calendar arithmetic silently shifts under another session zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")
