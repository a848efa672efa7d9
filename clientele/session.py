"""Session settings for the jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot key of a large join over several tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where the split costs one more shuffle after it: that one moves partly aggregated rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # A batch limit above this sorts and spills, rather than keeping a heap per task; its rows still end in one task.
    "spark.sql.execution.topKSortFallbackThreshold": "1000000",
    # Call-site capture costs several round trips to the JVM for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
