"""Small hand-made inputs."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ringlake.functions.clock import Clock
from ringlake.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA, SILVER_COLUMNS
from ringlake.plans.silver import to_silver

CLOCK = Clock(date(2024, 1, 31), datetime(2024, 1, 31, 12))

DEFAULTS = {
    "subscription_id": "VT1", "customer_id": "KH1", "package_name": "Mimax", "package_type": "combo",
    "data_limit_gb": 100.0, "daily_limit_mb": 1024, "speed_mbps": 50, "price_monthly_vnd": 350000,
    "activation_date": "2024-01-01T08:00:00", "expiry_date": "2024-03-01T08:00:00", "auto_renewal": True,
    "status": "active", "device_type": "router", "payment_method": "cash",
    "created_at": "2024-01-10T10:00:00.000001", "last_updated": "2024-01-10T10:00:00", "zone": "north",
    "is_anomaly": False, "anomaly_reason": None, "total_used_gb": 25.0, "remaining_gb": 75.0,
}


def bronze_rows(spark, *changes):
    schema = type(BRONZE_SCHEMA)([f for f in BRONZE_SCHEMA if f.name in BRONZE_COLUMNS])
    rows = [{**DEFAULTS, **change} for change in changes]
    return spark.createDataFrame([tuple(row[c] for c in BRONZE_COLUMNS) for row in rows], schema)


def silver_rows(spark, *changes, **options):
    return to_silver(bronze_rows(spark, *changes), CLOCK, **options)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fact_rows(spark, rows):
    """Fact cells from (day, package, zone, total, unique customers) tuples."""
    schema = (
        "registration_date date, package_name string, package_type string, zone string, device_type string, "
        "payment_method string, total_registrations long, cancelled_registrations long, "
        "suspicious_registrations long, auto_renewal_registrations long, avg_price double, unique_customers long"
    )
    data = [(d, p, "combo", z, "router", "cash", n, 0, 0, 0, 100.0, u) for d, p, z, n, u in rows]
    return spark.createDataFrame(data, schema)


def same_rows(left, right):
    order = sorted(left.columns)
    assert order == sorted(right.columns)
    missing = left.select(*order).exceptAll(right.select(*order))
    extra = right.select(*order).exceptAll(left.select(*order))
    return missing.isEmpty() and extra.isEmpty()


__all__ = ["F", "CLOCK", "SILVER_COLUMNS", "bronze_rows", "silver_rows", "plan", "fact_rows", "same_rows"]
