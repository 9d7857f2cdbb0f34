"""Spark session with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def build_session(name: str = "perkflow", **settings: str) -> SparkSession:
    """Session with UTC time and adaptive execution.

    The number of shuffle partitions is left to the cluster: it has to grow with the data, and
    adaptive execution merges the small ones.
    """
    builder = SparkSession.builder.appName(name)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
