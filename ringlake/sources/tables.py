"""Silver and gold tables in the session catalog or in a V2 catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ringlake.schemas import SILVER_COLUMNS, SILVER_PARTITIONS


def has_v2_catalog(spark: SparkSession, table: str) -> bool:
    """Whether the first part of a three-part name is a configured catalog plugin."""
    parts = table.split(".")
    return len(parts) == 3 and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None


def with_partitions(silver: DataFrame) -> DataFrame:
    """Add the derived year that the built-in catalog partitions by."""
    return silver.withColumn("activation_year", F.year("activation_date")).hint("rebalance", *SILVER_PARTITIONS)


def replace_silver(silver: DataFrame, table: str, path: str | None = None) -> None:
    """Create or replace the silver table, partitioned by package type, zone and activation year.

    A V2 catalog gets a year transform.  The built-in catalog has none, so there a
    derived column is stored; ``read_silver`` leaves it out again.
    """
    if has_v2_catalog(silver.sparkSession, table):
        year = F.partitioning.years("activation_date")
        silver.writeTo(table).partitionedBy(F.col("package_type"), F.col("zone"), year).createOrReplace()
    else:
        save(with_partitions(silver), table, path, partition_by=SILVER_PARTITIONS)


def append_silver(silver: DataFrame, table: str) -> None:
    if has_v2_catalog(silver.sparkSession, table):
        silver.writeTo(table).append()
    else:
        with_partitions(silver).write.mode("append").format("parquet").partitionBy(*SILVER_PARTITIONS).saveAsTable(table)


def read_silver(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*SILVER_COLUMNS)


def save(df: DataFrame, table: str, path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Create or overwrite a table and return it as read from storage."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def ensure_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
