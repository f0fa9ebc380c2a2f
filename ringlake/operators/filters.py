"""Row validity filters.  Null tests on plain columns reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ringlake.schemas import REQUIRED_COLUMNS


def all_present(columns: list[str]):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def valid_subscriptions(bronze: DataFrame) -> DataFrame:
    return bronze.where(all_present(REQUIRED_COLUMNS))


def dated(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("activation_date").isNotNull())
