"""Customer lifetime aggregates and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ringlake.functions import rules
from ringlake.functions.clock import Clock


def customer_lifetime(details: DataFrame, clock: Clock = Clock(), latest_package: bool = False) -> DataFrame:
    """One row per customer.

    ``current_package`` is the alphabetically last package name; with
    ``latest_package`` it is the package of the newest subscription.
    """
    newest = F.struct("activation_date", "created_at", "subscription_id")
    package = F.max_by("package_name", newest) if latest_package else F.max("package_name")
    return (
        details.groupBy("customer_id")
        .agg(
            F.min("activation_date").alias("first_subscription_date"),
            F.max("activation_date").alias("last_subscription_date"),
            F.count_distinct("subscription_id").alias("total_subscriptions"),
            F.count_if(rules.is_true(F.col("status") == "cancelled")).alias("total_cancellations"),
            F.avg("price_monthly_vnd").alias("avg_spending"),
            package.alias("current_package"),
            F.max("auto_renewal").alias("is_auto_renewal"),
        )
        .withColumn("customer_lifetime_days", F.datediff(clock.date(), F.col("first_subscription_date")))
    )


def customer_behavior(details: DataFrame, clock: Clock = Clock(), latest_package: bool = False) -> DataFrame:
    lifetime = customer_lifetime(details, clock, latest_package)
    segment = rules.lifetime_segment(
        F.col("customer_lifetime_days"),
        F.col("total_subscriptions"),
        F.col("avg_spending"),
        F.col("total_cancellations"),
    )
    customer, *measures = lifetime.columns
    return lifetime.select(customer, segment.alias("customer_segment"), *measures)
