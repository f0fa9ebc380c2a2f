"""Table checks and column contracts.

Every check of a table is one measure of the same global aggregate, so a report
scans the table once.  Only one measure is a distinct count; it is pre-aggregated
by id before anything reaches the final task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ringlake.functions.clock import Clock
from ringlake.functions.rules import hours_between, is_true
from ringlake.schemas import CRITICAL_COLUMNS, FRESH_HOURS, PRICE_RANGE, STATUSES, USAGE_RANGE, ZONES

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


@dataclass(frozen=True)
class Check:
    """A named measure over a table; more than zero violations give ``severity``.

    ``violations`` and ``severity`` are aggregate expressions (a severity is mostly constant).
    """

    check: str
    column: str
    severity: Column
    violations: Column

    def measures(self, position: int) -> list[Column]:
        return [self.violations.cast("long").alias(f"found{position}"), self.severity.alias(f"severity{position}")]

    def row(self, position: int) -> Column:
        found, severity = F.col(f"found{position}"), F.col(f"severity{position}")
        return F.struct(
            F.lit(self.check).alias("check"),
            F.lit(self.column).alias("column"),
            severity.alias("severity"),
            found.alias("violations"),
            F.when(found > 0, severity).otherwise(PASS).alias("status"),
        )


def run_checks(table: DataFrame, checks: list[Check]) -> DataFrame:
    """One report row per check from one aggregate over the table."""
    measured = table.agg(*[measure for i, c in enumerate(checks) for measure in c.measures(i)])
    return measured.select(F.inline(F.array(*[c.row(i) for i, c in enumerate(checks)])))


def _outside(column: str, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return (F.col(column) < low) | (F.col(column) > high)


def _count(condition: Column) -> Column:
    return F.count_if(is_true(condition))


def null_checks(columns: list[str] = CRITICAL_COLUMNS) -> list[Check]:
    return [Check("null_count", c, F.lit(FAIL), _count(F.col(c).isNull())) for c in columns]


def not_empty_check(table: str) -> Check:
    return Check("row_count", table, F.lit(FAIL), F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))


def duplicate_check(column: str = "subscription_id") -> Check:
    """Rows beyond the number of distinct ids; rows without an id count as duplicates."""
    return Check("duplicates", column, F.lit(WARN), F.count(F.lit(1)) - F.count_distinct(column))


def range_checks() -> list[Check]:
    """A NULL is not out of range."""
    return [
        Check("value_range", "price_monthly_vnd", F.lit(FAIL), _count(_outside("price_monthly_vnd", PRICE_RANGE))),
        Check("value_range", "usage_percentage", F.lit(WARN), _count(_outside("usage_percentage", USAGE_RANGE))),
    ]


def domain_checks() -> list[Check]:
    """A NULL is not outside the domain."""
    return [
        Check("domain", "zone", F.lit(FAIL), _count(~F.col("zone").isin(ZONES))),
        Check("domain", "status", F.lit(FAIL), _count(~F.col("status").isin(STATUSES))),
    ]


def freshness_check(clock: Clock = Clock(), max_hours: float = FRESH_HOURS) -> Check:
    """Stale rows warn; no ``last_updated`` at all fails."""
    age = _hours_ago(clock)
    return Check(
        "freshness",
        "last_updated",
        F.when(age.isNull(), FAIL).otherwise(WARN),
        F.when(is_true(age < max_hours), 0).otherwise(1),
    )


def _hours_ago(clock: Clock) -> Column:
    return hours_between(F.max("last_updated"), clock.timestamp())


def dim_report(dim: DataFrame, clock: Clock = Clock()) -> DataFrame:
    checks = [
        *null_checks(),
        not_empty_check("dim_subscriptions"),
        duplicate_check(),
        *range_checks(),
        *domain_checks(),
        freshness_check(clock),
    ]
    return run_checks(dim, checks)


def row_count_report(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of both tables; an empty one fails."""

    def counted(table: DataFrame, name: str) -> DataFrame:
        rows = table.agg(F.count(F.lit(1)).alias("rows"))
        status = F.when(F.col("rows") > 0, PASS).otherwise(FAIL)
        return rows.select(F.lit(name).alias("table"), "rows", status.alias("status"))

    return counted(dim, "dim_subscriptions").unionByName(counted(fact, "fact_daily_registrations"))


def freshness(dim: DataFrame, clock: Clock = Clock(), max_hours: float = FRESH_HOURS) -> DataFrame:
    """Newest ``last_updated``, its age in hours and the status of that age."""
    age = F.col("hours_ago")
    return dim.agg(F.max("last_updated").alias("last_updated"), _hours_ago(clock).alias("hours_ago")).withColumn(
        "status", F.when(age.isNull(), FAIL).when(age >= max_hours, WARN).otherwise(PASS)
    )


def quality_report(dim: DataFrame, fact: DataFrame, clock: Clock = Clock()) -> DataFrame:
    """All checks as rows; the caller decides what a warning or failure means."""
    return dim_report(dim, clock).unionByName(run_checks(fact, [not_empty_check("fact_daily_registrations")]))


# --- column contracts of the silver table ---------------------------------------


def contract_not_null(silver: DataFrame, columns: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    return run_checks(silver, null_checks(columns)).select("column", "violations")


def contract_unique(silver: DataFrame, column: str = "subscription_id") -> DataFrame:
    """Number of non-null values that occur more than once."""
    repeated = silver.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(column).alias("column"), "violations")


def contract_accepted_values(silver: DataFrame, accepted: dict[str, list[str]] | None = None) -> DataFrame:
    """Values per contracted column with their rows and whether they are accepted.

    One pass: each row yields its (column, value) pairs, which are counted before
    the exchange.  NULL is accepted, as in a SQL ``NOT IN`` test.
    """
    accepted = accepted or {"status": STATUSES, "zone": ZONES}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in accepted])
    allowed = F.lit(False)
    for column, values in accepted.items():
        allowed = allowed | ((F.col("column") == column) & F.col("value").isin(values))
    return (
        silver.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("accepted", allowed)
    )
