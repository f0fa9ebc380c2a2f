"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning is what splits hot join keys and rebalances written
# partitions, so the plans rely on it being on.  UTC keeps string -> timestamp
# parsing independent of where the driver runs.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "ringlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; the cluster's own configuration wins where it is not named here.

    Extra settings are passed with underscores for dots, for example
    ``spark_sql_shuffle_partitions="2000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
