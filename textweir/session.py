"""The session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "textweir", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; `conf` overrides single settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
