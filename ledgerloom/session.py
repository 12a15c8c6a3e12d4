"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # joins whose shuffled partitions all turn out this small hash instead of sorting
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
