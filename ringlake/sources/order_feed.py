"""Bronze registrations derived from the star-schema test tables.

Every order becomes one registration; the rules are those of FIXTURES.md.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ringlake.functions.clock import Clock
from ringlake.schemas import BRONZE_COLUMNS, ZONES

AS_OF = Clock(date(2024, 1, 31), datetime(2024, 1, 31, 12))

# The ten packages as (name, type, price in VND, limit in GB; 0 is unlimited).
PACKAGES = [
    ("Data Tốc Cao", "data_only", 199000, 50),
    ("Mimax", "combo", 350000, 120),
    ("ST Super", "data_only", 149000, 30),
    ("Data Pro", "data_only", 299000, 100),
    ("Cước Thả Ga", "unlimited", 499000, 0),
    ("Gói Ngày", "daily", 10000, 2),
    ("Data Student", "data_only", 179000, 70),
    ("Business Pro", "combo", 599000, 200),
    ("Gói Tuần", "weekly", 70000, 10),
    ("Data Cơ Bản", "data_only", 99000, 20),
]
# Choices that a registration draws from.
SPEEDS = [30, 50, 70, 100, 120, 150, 200]
DURATIONS = [30, 60, 90, 180, 365]
DEVICES = ["smartphone", "tablet", "modem", "router"]
PAYMENTS = ["credit_card", "bank_transfer", "momo", "cash", "scratch_card"]
ZONE_CYCLE = ZONES  # in this order
REASONS = ["high_frequency", "unusual_package", "suspicious_device"]


# Declared, so that no job has to read file footers before a query is planned.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
    "customer": "c_custkey long, c_nationkey int",
    "lineitem": "l_orderkey long, l_quantity double",
}


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _pick(values: list, position: str) -> str:
    """A choice by zero-based position."""
    return f"element_at(array({', '.join(_literal(v) for v in values)}), cast({position} as int) + 1)"


def _iso(moment: str) -> str:
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss\")"


# Values that several columns share are columns of their own: each is computed once,
# and the generated code stays small enough for the JVM to compile it.
SHARED = {
    "k": "o_orderkey",
    "ck": "o_custkey",
    "odd_one": "o_orderkey % 1000 = 13",
    "even_customer": "o_custkey % 2 = 0",
    "tens": "o_orderkey div 10",
    "active": f"""
        CASE WHEN o_orderkey % 499 = 3 THEN NULL
             ELSE date_sub(DATE '{AS_OF.today}', cast(
                 CASE WHEN o_custkey % 8 = 0 THEN (o_orderkey * 31) % 25
                      ELSE (o_custkey % 8) * 60 + (o_orderkey * 31) % 60 END AS int)) END""",
    "landed": _iso("TIMESTAMP '2024-01-12 00:00:00' + make_dt_interval(0, 0, 0, (o_orderkey * 7919) % 1728000)"),
    "used_gb": "round(quantity * CASE WHEN data_limit_gb > 0 THEN data_limit_gb ELSE 500D END / 150D, 2)",
}

COLUMNS = {
    "subscription_id": "'VT' || (100000 + k - CASE WHEN k % 97 = 1 THEN 1 ELSE 0 END)",
    "customer_id": "CASE WHEN k % 211 <> 5 THEN 'KH' || (10000 + ck) END",
    "package_name": """
        CASE WHEN k % 307 = 7 THEN NULL WHEN odd_one AND even_customer THEN 'Mimax'
             WHEN odd_one THEN 'Data Tốc Cao' ELSE p_name END""",
    "daily_limit_mb": "CASE WHEN data_limit_gb <> 0 THEN 512 * (1 + k % 6) END",
    "speed_mbps": f"cast({_pick(SPEEDS, 'tens % 7')} as long)",
    "activation_date": _iso("active"),
    "expiry_date": _iso(f"date_add(active, {_pick(DURATIONS, 'tens % 5')})"),
    "auto_renewal": "even_customer",
    "status": """
        CASE WHEN odd_one THEN 'active' WHEN tens % 20 = 0 THEN 'cancelled' WHEN o_orderstatus = 'O' THEN 'active'
             WHEN o_orderstatus = 'F' THEN 'expired' WHEN o_orderstatus = 'P' THEN 'suspended' END""",
    "device_type": _pick(DEVICES, "ck % 4"),
    "payment_method": _pick(PAYMENTS, "cast(left(o_orderpriority, 1) as int) - 1"),
    "created_at": "landed",
    "last_updated": "landed",
    "zone": f"CASE WHEN odd_one THEN 'north' ELSE {_pick(ZONE_CYCLE, 'c_nationkey % 3')} END",
    "is_anomaly": "odd_one",
    "anomaly_reason": f"CASE WHEN odd_one THEN {_pick(REASONS, 'k % 3')} END",
    "total_used_gb": "used_gb",
    "remaining_gb": "CASE WHEN data_limit_gb <> 0 THEN greatest(data_limit_gb - used_gb, 0D) END",
}


def _packages(spark: SparkSession) -> DataFrame:
    """Ten literal rows, so the broadcast below has a fixed size."""
    rows = ", ".join(f"({i}L, '{n}', '{t}', {price}L, {gb}D)" for i, (n, t, price, gb) in enumerate(PACKAGES))
    columns = "i, p_name, package_type, price_monthly_vnd, data_limit_gb"
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS packages({columns})"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    return (
        _table(spark, sf_dir, "orders")
        .join(_table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(used, F.expr("o_orderkey = l_orderkey"), "left")
        .join(_packages(spark), F.expr("o_orderkey % 10 = i"))
        .selectExpr("*", *[f"{rule} AS {name}" for name, rule in SHARED.items()])
        .selectExpr(*[f"{COLUMNS.get(name, name)} AS {name}" for name in BRONZE_COLUMNS])
    )
