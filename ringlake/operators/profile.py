"""Batch profile: frequent packages and flag counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ringlake.functions.rules import is_true
from ringlake.operators.filters import all_present
from ringlake.schemas import REQUIRED_COLUMNS


def top_values(rows: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-null values; ties go to the smaller value."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc(column))
        .limit(k)
    )


def flag_counts(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_true(F.col("is_anomaly"))).alias("anomalies"),
        F.count_if(is_true(F.col("status") == "cancelled")).alias("cancelled"),
    )


def stage_counts(bronze: DataFrame) -> DataFrame:
    """Row counts before and after validation, from one pass."""
    counts = bronze.agg(
        F.count(F.lit(1)).alias("bronze"),
        F.count_if(all_present(REQUIRED_COLUMNS)).alias("silver"),
    )
    return counts.select(F.stack(F.lit(2), F.lit("bronze"), "bronze", F.lit("silver"), "silver").alias("stage", "rows"))
