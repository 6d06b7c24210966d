"""A Spark session with the settings the loader is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan from measured sizes: split hot buckets, join small ones, pick join strategies.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of a writer's share, and so of a file before compression.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Text without a zone means UTC.
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with ``SETTINGS``; keyword arguments override, with ``__`` for a dot in the key."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
