"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "gondola", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; pass extra settings as ``key=value``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The JVM compiles no method above 8000 bytes; wider row pipelines run faster split up.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
