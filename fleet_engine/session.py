"""Session construction and per-subsystem job tags."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that hold at any size; everything about cluster size is left to the cluster's own settings.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "fleet_engine", master: str | None = None, event_log: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build or reuse a session. ``event_log`` is a folder; it makes ``query_history`` possible later."""
    settings = dict(DEFAULTS)
    if event_log:
        settings.update({
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": event_log,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        })
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def tagged(spark: SparkSession, tag: str, description: str = ""):
    """Run the jobs of the block under ``tag`` so that they can be charged to one subsystem."""
    spark.sparkContext.setJobGroup(tag, description or tag)
    try:
        yield spark
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
