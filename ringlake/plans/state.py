"""Mergeable state of the models: small rows per landed day that add up to fact, customers and bursts.

A part of the landed tree replaces the state of its days.  A model is merged from the state
of all days, for the registration dates or customers that those days concern.  All
measures add up exactly: counts and sums of whole numbers, minima, maxima, and one row
for everything that is counted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ringlake.functions import rules
from ringlake.operators.trailing import trailing_counts
from ringlake.plans.silver import BURST_COLUMN, BURST_KEYS, BurstRule
from ringlake.schemas import FACT_KEYS

# Stored with silver beside its contract: where a row landed, that as a day, and its flag without bursts.
LANDED, LANDED_DAY, FLAGGED = "landed", "landed_day", "flagged"
BUCKET = "customer_bucket"


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int").alias(BUCKET)


def _rows_where(condition: Column) -> Column:
    return F.count_if(rules.is_true(condition))


def _dated(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("activation_date").isNotNull())


# --- bursts ---------------------------------------------------------------------------
ARRIVAL_CELL = [*FACT_KEYS[1:], "created_at"]


def arrivals(rows: DataFrame) -> DataFrame:
    """Registrations per product cell and instant; ``plain`` are dated and not flagged by themselves."""
    plain = F.col("activation_date").isNotNull() & ~F.col(FLAGGED)
    return rows.groupBy(F.to_date("created_at").alias("registration_date"), LANDED_DAY, *ARRIVAL_CELL).agg(
        F.count(F.lit(1)).alias("arrivals"), _rows_where(plain).alias("plain")
    )


def bursts(near: DataFrame, rule: BurstRule) -> DataFrame:
    """(package, zone, instant) above the threshold, from the ``arrivals`` of the days around."""
    counts = trailing_counts(near, BURST_KEYS, "created_at", rule.seconds, BURST_COLUMN, weight="arrivals")
    over = counts.where(F.col(BURST_COLUMN) > rule.threshold)
    return over.select(*BURST_KEYS, "created_at", F.to_date("created_at").alias("registration_date"))


def burst_rows(near: DataFrame, over: DataFrame) -> DataFrame:
    """What bursts add to the fact: plain registrations at their instants, in the columns of ``fact_state``."""
    on = [*BURST_KEYS, "created_at"]
    right = over.select(*[F.col(c).alias(f"__{c}") for c in on])
    hit = near.where("plain > 0").join(right, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on], "left_semi")
    zero = F.lit(0).cast("long")
    return hit.groupBy(*FACT_KEYS).agg(F.sum("plain").alias("suspicious")).select(
        *FACT_KEYS, F.lit(None).cast("string").alias("customer_id"), "suspicious",
        *[zero.alias(c) for c in ("total", "cancelled", "renewals", "price_sum", "price_n")],
    )


# --- fact -----------------------------------------------------------------------------
FACT_SUMS = ["total", "cancelled", "suspicious", "renewals", "price_sum", "price_n"]


def fact_state(rows: DataFrame) -> DataFrame:
    """Counts per landed day, cell and customer."""
    return (
        _dated(rows)
        .withColumn("registration_date", F.to_date("created_at"))
        .groupBy(LANDED_DAY, *FACT_KEYS, "customer_id")
        .agg(
            F.count(F.lit(1)).alias("total"),
            _rows_where(F.col("status") == "cancelled").alias("cancelled"),
            _rows_where(F.col(FLAGGED)).alias("suspicious"),
            _rows_where(F.col("auto_renewal")).alias("renewals"),
            F.coalesce(F.sum("price_monthly_vnd"), F.lit(0)).alias("price_sum"),
            F.count("price_monthly_vnd").alias("price_n"),
        )
    )


def merged_fact(state: DataFrame, added: DataFrame | None = None) -> DataFrame:
    """The fact of the dates that ``state`` holds, with what bursts add."""
    columns = [*FACT_KEYS, "customer_id", *FACT_SUMS]
    rows = state.select(*columns)
    if added is not None:
        rows = rows.unionByName(added.select(*columns))
    each = rows.groupBy(*FACT_KEYS, "customer_id").agg(*[F.sum(c).alias(c) for c in FACT_SUMS])
    sums = each.groupBy(*FACT_KEYS).agg(
        *[F.sum(c).alias(c) for c in FACT_SUMS], F.count_if(F.col("customer_id").isNotNull()).alias("unique_customers")
    )
    return sums.select(
        *FACT_KEYS,
        F.col("total").alias("total_registrations"),
        F.col("cancelled").alias("cancelled_registrations"),
        F.col("suspicious").alias("suspicious_registrations"),
        F.col("renewals").alias("auto_renewal_registrations"),
        F.try_divide(F.col("price_sum").cast("double"), F.col("price_n")).alias("avg_price"),
        "unique_customers",
    )


# --- customers ------------------------------------------------------------------------
def customer_state(rows: DataFrame, buckets: int) -> DataFrame:
    """Figures per landed day, customer and subscription."""
    newest = F.struct("activation_date", "created_at", "subscription_id", "package_name")
    return (
        _dated(rows)
        .groupBy(bucket(buckets), LANDED_DAY, "customer_id", "subscription_id")
        .agg(
            F.min("activation_date").alias("first"),
            F.max("activation_date").alias("last"),
            _rows_where(F.col("status") == "cancelled").alias("cancelled"),
            F.coalesce(F.sum("price_monthly_vnd"), F.lit(0)).alias("price_sum"),
            F.count("price_monthly_vnd").alias("price_n"),
            F.max("package_name").alias("package"),
            F.max(newest).alias("newest"),
            F.max("auto_renewal").alias("renewal"),
        )
    )


def merged_lifetimes(state: DataFrame, latest_package: bool = False) -> DataFrame:
    """One row per customer, without what depends on the clock.  Subscriptions are merged first, so each counts once."""
    merged = {
        "first": F.min("first"), "last": F.max("last"), "cancelled": F.sum("cancelled"), "price_sum": F.sum("price_sum"),
        "price_n": F.sum("price_n"), "package": F.max("package"), "newest": F.max("newest"), "renewal": F.max("renewal"),
    }
    each = state.groupBy(BUCKET, "customer_id", "subscription_id").agg(*[c.alias(k) for k, c in merged.items()])
    return (
        each.groupBy(BUCKET, "customer_id")
        .agg(F.count(F.lit(1)).alias("subscriptions"), *[c.alias(k) for k, c in merged.items()])
        .select(
            "customer_id",
            F.col("first").alias("first_subscription_date"),
            F.col("last").alias("last_subscription_date"),
            F.col("subscriptions").alias("total_subscriptions"),
            F.col("cancelled").alias("total_cancellations"),
            F.try_divide(F.col("price_sum").cast("double"), F.col("price_n")).alias("avg_spending"),
            (F.col("newest.package_name") if latest_package else F.col("package")).alias("current_package"),
            F.col("renewal").alias("is_auto_renewal"),
            BUCKET,
        )
    )
