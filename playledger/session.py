"""Session settings that the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution picks join strategies and partition counts from run-time sizes, and splits
#: skewed join partitions. A shuffle starts with many partitions, and
#: those that turn out small are merged.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.metricsEnabled": "true",
}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``settings`` adds to them or overrides them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (SETTINGS | (settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
