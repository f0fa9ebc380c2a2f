"""Bronze registrations to the typed, enriched silver table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ringlake.functions import rules
from ringlake.functions.clock import Clock
from ringlake.operators.filters import valid_subscriptions
from ringlake.operators.trailing import attach_counts, trailing_counts
from ringlake.schemas import BURST_SECONDS, BURST_THRESHOLD, SILVER_COLUMNS

BURST_KEYS = ["package_name", "zone"]
BURST_COLUMN = "registration_count"


@dataclass(frozen=True)
class BurstRule:
    """More than ``threshold`` registrations of a package and zone within ``seconds`` is suspicious."""

    threshold: int = BURST_THRESHOLD
    seconds: int = BURST_SECONDS


def typed_subscriptions(bronze: DataFrame, clock: Clock = Clock()) -> DataFrame:
    """Valid rows with dates and timestamps parsed; text that does not parse becomes NULL."""
    return valid_subscriptions(bronze).withColumns(
        {
            "activation_date": F.try_to_date(F.col("activation_date")),
            "expiry_date": F.try_to_date(F.col("expiry_date")),
            "created_at": F.try_to_timestamp(F.col("created_at")),
            "last_updated": clock.timestamp(),
        }
    )


def burst_counts(typed: DataFrame, rule: BurstRule) -> DataFrame:
    """Trailing registrations per package, zone and instant; reads three columns only."""
    return trailing_counts(typed, BURST_KEYS, "created_at", rule.seconds, BURST_COLUMN)


def with_burst_count(typed: DataFrame, rule: BurstRule) -> DataFrame:
    return attach_counts(typed, burst_counts(typed, rule), BURST_KEYS, "created_at", BURST_COLUMN)


def burst_instants(bronze: DataFrame, rule: BurstRule) -> DataFrame:
    """The packages, zones and instants whose trailing count exceeds the threshold."""
    return burst_counts(typed_subscriptions(bronze), rule).where(F.col(BURST_COLUMN) > rule.threshold)


def to_silver(
    bronze: DataFrame,
    clock: Clock = Clock(),
    burst: BurstRule | None = None,
    bursts: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The 25 silver columns, and those to ``keep``.  Without ``burst`` every step is row-wise, hence streamable.

    Only instants above the threshold are joined to the rows.  ``bursts`` takes them
    from a table written earlier: when its files are small they are broadcast, and
    the wide rows are not shuffled at all.
    """
    rows = typed_subscriptions(bronze, clock)
    suspicious = rules.is_true(F.col("is_anomaly"))
    if burst is not None:
        bursts = burst_instants(bronze, burst) if bursts is None else bursts
        rows = attach_counts(rows, bursts, BURST_KEYS, "created_at", BURST_COLUMN)
        suspicious = F.col(BURST_COLUMN).isNotNull() | suspicious
    return rows.withColumns(
        {
            "subscription_duration_days": F.datediff("expiry_date", "activation_date"),
            "days_until_expiry": F.datediff(F.col("expiry_date"), clock.date()),
            "usage_percentage": rules.usage_percentage(F.col("total_used_gb"), F.col("data_limit_gb")),
            "customer_segment": rules.price_segment(F.col("price_monthly_vnd")),
            "is_suspicious": suspicious,
        }
    ).select(*SILVER_COLUMNS, *keep)
