"""Subscription dimension and daily registration fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ringlake.functions import rules
from ringlake.operators.filters import dated
from ringlake.operators.ranking import ranked_rows
from ringlake.schemas import FACT_KEYS, SILVER_COLUMNS

def newest_first():
    """Newest activation first, then creation time and id; rows alike in these may swap places."""
    return [
        F.col("activation_date").desc_nulls_last(),
        F.col("created_at").desc_nulls_last(),
        F.col("subscription_id").asc_nulls_last(),
    ]


def subscription_details(silver: DataFrame) -> DataFrame:
    """Dated silver rows with expiry status and price per GB; row-wise."""
    return (
        dated(silver)
        .select(*SILVER_COLUMNS)
        .withColumns(
            {
                "expiry_status": rules.expiry_status(F.col("days_until_expiry")),
                "price_per_gb": rules.price_per_gb(F.col("price_monthly_vnd"), F.col("data_limit_gb")),
            }
        )
    )


def dim_subscriptions(silver: DataFrame, **ranking: int) -> DataFrame:
    """``ranking`` is passed to ``ranked_rows``: from which size on a customer is split, and into how many runs."""
    return ranked_rows(
        subscription_details(silver), "customer_id", newest_first(), "customer_subscription_rank", **ranking
    )


def fact_daily(details: DataFrame) -> DataFrame:
    """Registrations per day and product cell.

    The one distinct count is planned as two partial aggregations, first on (cell,
    customer), so a cell that holds most rows is spread over its customers.
    """

    def rows_where(condition):
        return F.count_if(rules.is_true(condition))

    return (
        details.withColumn("registration_date", F.to_date("created_at"))
        .groupBy(*FACT_KEYS)
        .agg(
            F.count(F.lit(1)).alias("total_registrations"),
            rows_where(F.col("status") == "cancelled").alias("cancelled_registrations"),
            rows_where(F.col("is_suspicious")).alias("suspicious_registrations"),
            rows_where(F.col("auto_renewal")).alias("auto_renewal_registrations"),
            F.avg("price_monthly_vnd").alias("avg_price"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
