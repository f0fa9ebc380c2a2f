"""Column contracts of the layers, and the fixed business values they use."""

from __future__ import annotations

from pyspark.sql import types as T

# The column contracts below have to match for right results.
# --- bronze: what the landed Parquet files hold --------------------------------
_STR, _LONG, _DBL, _BOOL, _INT = (
    T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType(),
)

_BRONZE_TYPES = {
    "subscription_id": _STR,
    "customer_id": _STR,
    "package_name": _STR,
    "package_type": _STR,
    "data_limit_gb": _DBL,
    "daily_limit_mb": _LONG,
    "speed_mbps": _LONG,
    "price_monthly_vnd": _LONG,
    "activation_date": _STR,
    "expiry_date": _STR,
    "auto_renewal": _BOOL,
    "status": _STR,
    "device_type": _STR,
    "payment_method": _STR,
    "created_at": _STR,
    "last_updated": _STR,
    "zone": _STR,
    "is_anomaly": _BOOL,
    "anomaly_reason": _STR,
    "total_used_gb": _DBL,
    "remaining_gb": _DBL,
}

BRONZE_COLUMNS = list(_BRONZE_TYPES)
LANDING_PARTITIONS = ["year", "month", "day", "hour"]

# An explicit schema spares a footer-reading pass over every file and keeps a
# nullable column typed even when one batch holds no value for it.
BRONZE_SCHEMA = T.StructType(
    [T.StructField(name, dtype) for name, dtype in _BRONZE_TYPES.items()]
    + [T.StructField("minute", _LONG)]
    + [T.StructField(name, _INT) for name in LANDING_PARTITIONS]
)

# --- silver: fixed, ordered projection ------------------------------------------
SILVER_COLUMNS = [
    "subscription_id", "customer_id", "package_name", "package_type", "data_limit_gb",
    "daily_limit_mb", "speed_mbps", "price_monthly_vnd", "activation_date", "expiry_date",
    "auto_renewal", "status", "device_type", "payment_method", "zone", "customer_segment",
    "subscription_duration_days", "days_until_expiry", "total_used_gb", "remaining_gb",
    "usage_percentage", "is_suspicious", "anomaly_reason", "created_at", "last_updated",
]
SILVER_PARTITIONS = ["package_type", "zone", "activation_year"]

REQUIRED_COLUMNS = ["subscription_id", "customer_id", "package_name"]
CRITICAL_COLUMNS = ["subscription_id", "customer_id", "package_name", "activation_date"]

FACT_KEYS = [
    "registration_date", "package_name", "package_type", "zone", "device_type", "payment_method",
]

# Accepted domains, watch-list and limits, as the results require them.
ZONES = ["north", "central", "south"]
STATUSES = ["active", "expired", "suspended", "cancelled", "pending"]
WATCHED_PACKAGES = ["Data Tốc Cao", "Mimax"]
PRICE_RANGE = (0, 10_000_000)
USAGE_RANGE = (0, 200)
FRESH_HOURS = 2
BURST_THRESHOLD = 100
BURST_SECONDS = 3600
ROLLING_ROWS = 7
