"""Daily figures: totals, top cells and rolling two-sigma labels over the fact.

All of these read the fact, whose size is days x product cells.  It is used more
than once per model, so callers pass a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ringlake.functions import rules
from ringlake.functions.clock import Clock
from ringlake.operators.rolling import trailing_rows
from ringlake.schemas import ROLLING_ROWS, WATCHED_PACKAGES

DAY = "registration_date"
CELL_ORDER = ["package_name", "zone", "package_type", "device_type", "payment_method"]


def nulls_last(*columns: str) -> list[Column]:
    """Fields for a struct whose minimum is the first row in ascending order, nulls last."""
    return [field for c in columns for field in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]


def daily_kpis(fact: DataFrame) -> DataFrame:
    """Totals per day with the package and zone of the largest cell.

    ``new_customers`` counts the cells that served exactly one customer.
    """
    largest_first = F.struct((-F.col("total_registrations")).alias("size"), *nulls_last(*CELL_ORDER))
    day = fact.groupBy(DAY).agg(
        F.sum("total_registrations").alias("total_subscriptions"),
        F.sum("cancelled_registrations").alias("total_cancellations"),
        F.sum("suspicious_registrations").alias("total_suspicious"),
        F.min(largest_first).alias("top"),
        F.count_if(F.col("unique_customers") == 1).alias("new_customers"),
        F.sum(F.col("total_registrations") * F.col("avg_price")).alias("estimated_revenue"),
    )
    return day.select(
        DAY,
        "total_subscriptions",
        "total_cancellations",
        "total_suspicious",
        F.col("top.package_name").alias("top_package"),
        F.col("top.zone").alias("top_zone"),
        rules.percent(F.col("total_cancellations"), F.col("total_subscriptions")).alias("cancellation_rate"),
        "new_customers",
        "estimated_revenue",
    )


def daily_top_by_sum(fact: DataFrame, column: str = "package_name", name: str = "top_package") -> DataFrame:
    """The value of ``column`` with most registrations per day over all its cells."""
    sums = fact.groupBy(DAY, column).agg(F.sum("total_registrations").alias("registrations"))
    ordered = [F.col(column).isNull().alias("no_value"), F.col(column).alias("value")]
    best = F.min(F.struct((-F.col("registrations")).alias("size"), *ordered))
    return (
        sums.groupBy(DAY)
        .agg(best.alias("best"))
        .select(DAY, F.col("best.value").alias(name), (-F.col("best.size")).alias("registrations"))
    )


def rolling_anomalies(
    fact: DataFrame,
    per_day: bool = False,
    packages: list[str] = WATCHED_PACKAGES,
    depth: int = ROLLING_ROWS,
) -> DataFrame:
    """Watched registrations against mean and deviation of the ``depth`` rows before.

    By default a row is a fact cell and all cells form one sequence.  With ``per_day``
    the cells of a package are summed per day and each package has its own sequence.
    """
    watched = fact.where(F.col("package_name").isin(packages))
    total = F.col("total_registrations")
    stats = {"avg_7day": F.avg(total), "std_7day": F.stddev_samp(total)}
    if per_day:
        daily = watched.groupBy(DAY, "package_name").agg(F.sum(total).alias("total_registrations"))
        # One row per calendar day and package.
        frame = Window.partitionBy("package_name").orderBy(F.col(DAY).asc_nulls_last()).rowsBetween(-depth, -1)
        compared = daily.withColumns({name: stat.over(frame) for name, stat in stats.items()})
    else:
        order = [F.col(c).asc_nulls_last() for c in CELL_ORDER]
        compared = trailing_rows(watched, DAY, order, depth, stats)
    label = rules.sigma_label(total, F.col("avg_7day"), F.col("std_7day"))
    return compared.where(F.col("avg_7day").isNotNull()).withColumn("anomaly_status", label)


def daily_summary(fact: DataFrame, clock: Clock = Clock(), per_day: bool = False) -> DataFrame:
    """Daily totals with the day's anomalies; a day without any appears once."""
    flagged = (
        rolling_anomalies(fact, per_day)
        .where(F.col("anomaly_status") != "normal")
        .select(
            DAY,
            F.col("package_name").alias("anomaly_package"),
            "anomaly_status",
            F.col("total_registrations").alias("anomaly_package_registrations"),
        )
    )
    return daily_kpis(fact).join(flagged, DAY, "left").withColumn("generated_at", clock.timestamp())
