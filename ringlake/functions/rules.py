"""Business rules as column expressions.  All are built-in expressions, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ringlake.schemas import LANDING_PARTITIONS


def _first_true(cases: list[tuple[Column, str]], fallback: str) -> Column:
    """Label of the first condition that holds; NULL conditions do not hold."""
    (condition, label), *rest = cases
    chain = F.when(condition, F.lit(label))
    return reduce(lambda acc, case: acc.when(case[0], F.lit(case[1])), rest, chain).otherwise(F.lit(fallback))


def is_true(condition: Column) -> Column:
    """The condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def price_segment(price: Column) -> Column:
    # Tier floors in VND.
    tiers = [(500_000, "premium"), (200_000, "standard")]
    return _first_true([(price >= floor, name) for floor, name in tiers], "basic")


def usage_percentage(used_gb: Column, limit_gb: Column) -> Column:
    """Share of the allowance used, in percent; packages without an allowance give 0."""
    unlimited = F.coalesce(limit_gb, F.lit(0.0)) == 0.0
    return F.when(unlimited, F.lit(0.0)).otherwise(F.try_divide(used_gb, limit_gb) * 100.0)


def expiry_status(days_left: Column) -> Column:
    return _first_true([(days_left < 0, "expired"), (days_left <= 7, "expiring_soon")], "active")


def price_per_gb(price: Column, limit_gb: Column) -> Column:
    return F.try_divide(price.cast("double"), limit_gb)


def lifetime_segment(days: Column, subscriptions: Column, spending: Column, cancellations: Column) -> Column:
    """Order matters: a long-standing customer is loyal whatever they spend or cancel."""
    return _first_true(
        [
            ((days > 365) & (subscriptions > 3), "loyal"),
            (spending > 300_000, "high_value"),
            (cancellations > 0, "churn_risk"),
            (days < 30, "new"),
        ],
        "regular",
    )


def sigma_label(value: Column, mean: Column, deviation: Column, sigmas: float = 2.0) -> Column:
    """Which side of the ``sigmas`` band a value falls on; an unknown band is normal."""
    return _first_true(
        [
            (value > mean + sigmas * deviation, "high_anomaly"),
            (value < mean - sigmas * deviation, "low_anomaly"),
        ],
        "normal",
    )


def percent(part: Column, whole: Column) -> Column:
    """Double-typed on purpose: a decimal literal would widen to decimal arithmetic."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def hours_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def landing_fields(at: Column) -> dict[str, Column]:
    """Path and file fields of a landed batch; path parts are zero-padded text."""
    parts = {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour": F.hour(at)}
    padded = {
        name: F.lpad(part.cast("string"), 4 if name == "year" else 2, "0") for name, part in parts.items()
    }
    return {"minute": F.minute(at).cast("long"), **{name: padded[name] for name in LANDING_PARTITIONS}}
