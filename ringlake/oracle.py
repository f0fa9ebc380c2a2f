"""The same results as plain SQL for an independent engine (DuckDB dialect).

Written against the contract, not against the Spark plans: windows stay windows,
and nothing is split, carried or chunked here.
"""

from __future__ import annotations

from ringlake.schemas import BRONZE_COLUMNS, SILVER_COLUMNS, STATUSES, WATCHED_PACKAGES, ZONES
from ringlake.sources.order_feed import (
    DEVICES, DURATIONS, PACKAGES, PAYMENTS, REASONS, SPEEDS, ZONE_CYCLE,
)

TODAY = "DATE '2024-01-31'"
NOW = "TIMESTAMP '2024-01-31 12:00:00'"
EARLIER = "TIMESTAMP '2024-01-10 09:00:00'"
LATER = "TIMESTAMP '2024-01-31 15:30:00'"


def _text(value: str) -> str:
    return "'" + value + "'"


def _values(items: list) -> str:
    return ", ".join(_text(i) if isinstance(i, str) else str(i) for i in items)


def _pick(items: list, position: str) -> str:
    """A choice by zero-based position."""
    return f"([{_values(items)}])[({position}) + 1]"


_PACKAGE_ROWS = ", ".join(f"({i}, {_values([n, t, p])}, {g}.0)" for i, (n, t, p, g) in enumerate(PACKAGES))
_ISO = "'%Y-%m-%dT%H:%M:%S'"

STEPS = {
    "packages": f"""
        SELECT CAST(i AS BIGINT) AS i, p_name, package_type, CAST(price AS BIGINT) AS price_monthly_vnd,
               CAST(gb AS DOUBLE) AS data_limit_gb
        FROM (VALUES {_PACKAGE_ROWS}) AS v(i, p_name, package_type, price, gb)""",
    "usage_by_order": "SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey",
    "feed": f"""
        SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus, o_orderpriority, c_nationkey, p.*,
               o_orderkey % 1000 = 13 AS odd_one,
               TIMESTAMP '2024-01-12 00:00:00' + to_seconds((o_orderkey * 7919) % 1728000) AS landed,
               CASE WHEN o_orderkey % 499 = 3 THEN NULL
                    WHEN o_custkey % 8 = 0 THEN {TODAY} - CAST((o_orderkey * 31) % 25 AS INTEGER)
                    ELSE {TODAY} - CAST((o_custkey % 8) * 60 + (o_orderkey * 31) % 60 AS INTEGER) END AS active,
               round(quantity * CASE WHEN data_limit_gb > 0 THEN data_limit_gb ELSE 500.0 END / 150.0, 2) AS used
        FROM orders
        JOIN customer ON o_custkey = c_custkey
        LEFT JOIN usage_by_order ON l_orderkey = o_orderkey
        JOIN packages p ON p.i = o_orderkey % 10""",
    "bronze": f"""
        SELECT 'VT' || (100000 + k - CASE WHEN k % 97 = 1 THEN 1 ELSE 0 END) AS subscription_id,
               CASE WHEN k % 211 = 5 THEN NULL ELSE 'KH' || (10000 + ck) END AS customer_id,
               CASE WHEN k % 307 = 7 THEN NULL
                    WHEN odd_one AND ck % 2 = 0 THEN 'Mimax'
                    WHEN odd_one THEN 'Data Tốc Cao' ELSE p_name END AS package_name,
               package_type, data_limit_gb,
               CASE WHEN data_limit_gb = 0 THEN NULL ELSE 512 * (1 + k % 6) END AS daily_limit_mb,
               CAST({_pick(SPEEDS, '(k // 10) % 7')} AS BIGINT) AS speed_mbps,
               price_monthly_vnd,
               strftime(CAST(active AS TIMESTAMP), {_ISO}) AS activation_date,
               strftime(CAST(active + {_pick(DURATIONS, '(k // 10) % 5')} AS TIMESTAMP), {_ISO}) AS expiry_date,
               ck % 2 = 0 AS auto_renewal,
               CASE WHEN odd_one THEN 'active' WHEN (k // 10) % 20 = 0 THEN 'cancelled'
                    WHEN o_orderstatus = 'O' THEN 'active' WHEN o_orderstatus = 'F' THEN 'expired'
                    WHEN o_orderstatus = 'P' THEN 'suspended' END AS status,
               {_pick(DEVICES, 'ck % 4')} AS device_type,
               {_pick(PAYMENTS, 'CAST(left(o_orderpriority, 1) AS INTEGER) - 1')} AS payment_method,
               strftime(landed, {_ISO}) AS created_at,
               strftime(landed, {_ISO}) AS last_updated,
               CASE WHEN odd_one THEN 'north' ELSE {_pick(ZONE_CYCLE, 'c_nationkey % 3')} END AS zone,
               odd_one AS is_anomaly,
               CASE WHEN odd_one THEN {_pick(REASONS, 'k % 3')} END AS anomaly_reason,
               used AS total_used_gb,
               CASE WHEN data_limit_gb = 0 THEN NULL ELSE greatest(data_limit_gb - used, 0.0) END AS remaining_gb
        FROM feed""",
    "valid": """
        SELECT * FROM bronze
        WHERE subscription_id IS NOT NULL AND customer_id IS NOT NULL AND package_name IS NOT NULL""",
    "typed": f"""
        SELECT * REPLACE (CAST(left(activation_date, 10) AS DATE) AS activation_date,
                          CAST(left(expiry_date, 10) AS DATE) AS expiry_date,
                          CAST(created_at AS TIMESTAMP) AS created_at,
                          {NOW} AS last_updated)
        FROM valid""",
    "counted": """
        SELECT *, count(*) OVER (PARTITION BY package_name, zone ORDER BY created_at
                                 RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS registration_count
        FROM typed""",
    "measured": f"""
        SELECT *,
               CASE WHEN price_monthly_vnd >= 500000 THEN 'premium'
                    WHEN price_monthly_vnd >= 200000 THEN 'standard' ELSE 'basic' END AS customer_segment,
               CAST(expiry_date - activation_date AS INTEGER) AS subscription_duration_days,
               CAST(expiry_date - {TODAY} AS INTEGER) AS days_until_expiry,
               CASE WHEN coalesce(data_limit_gb, 0) = 0 THEN 0.0
                    ELSE round(total_used_gb / data_limit_gb * 100, 6) END AS usage_percentage,
               coalesce(is_anomaly, FALSE) AS plain_flag,
               registration_count > 3 OR coalesce(is_anomaly, FALSE) AS burst_flag
        FROM counted""",
    "silver": f"SELECT {', '.join(SILVER_COLUMNS).replace('is_suspicious', 'plain_flag AS is_suspicious')} FROM measured",
    "silver_burst": f"SELECT {', '.join(SILVER_COLUMNS).replace('is_suspicious', 'burst_flag AS is_suspicious')} FROM measured",
    "dim": """
        SELECT *,
               CASE WHEN days_until_expiry < 0 THEN 'expired'
                    WHEN days_until_expiry <= 7 THEN 'expiring_soon' ELSE 'active' END AS expiry_status,
               round(price_monthly_vnd / nullif(data_limit_gb, 0), 6) AS price_per_gb,
               CAST(row_number() OVER (PARTITION BY customer_id
                    ORDER BY activation_date DESC, created_at DESC NULLS LAST, subscription_id) AS INTEGER)
                    AS customer_subscription_rank
        FROM silver WHERE activation_date IS NOT NULL""",
    "fact_exact": """
        SELECT CAST(created_at AS DATE) AS registration_date, package_name, package_type, zone, device_type,
               payment_method,
               count(*) AS total_registrations,
               count(*) FILTER (status = 'cancelled') AS cancelled_registrations,
               count(*) FILTER (is_suspicious) AS suspicious_registrations,
               count(*) FILTER (auto_renewal) AS auto_renewal_registrations,
               avg(price_monthly_vnd) AS avg_price,
               count(DISTINCT customer_id) AS unique_customers
        FROM dim GROUP BY ALL""",
    "lifetime": f"""
        SELECT customer_id, min(activation_date) AS first_subscription_date,
               max(activation_date) AS last_subscription_date,
               count(DISTINCT subscription_id) AS total_subscriptions,
               count(*) FILTER (status = 'cancelled') AS total_cancellations,
               avg(price_monthly_vnd) AS avg_spending,
               max(package_name) AS current_package,
               bool_or(auto_renewal) AS is_auto_renewal,
               CAST({TODAY} - min(activation_date) AS INTEGER) AS customer_lifetime_days
        FROM dim GROUP BY customer_id""",
    "kpis": """
        SELECT registration_date,
               CAST(sum(total_registrations) AS BIGINT) AS total_subscriptions,
               CAST(sum(cancelled_registrations) AS BIGINT) AS total_cancellations,
               CAST(sum(suspicious_registrations) AS BIGINT) AS total_suspicious,
               round(100 * CAST(sum(cancelled_registrations) AS DOUBLE) / sum(total_registrations), 6)
                   AS cancellation_rate,
               count(*) FILTER (unique_customers = 1) AS new_customers,
               round(sum(total_registrations * avg_price), 2) AS estimated_revenue
        FROM fact_exact GROUP BY registration_date""",
    "largest_cell": """
        SELECT registration_date, package_name AS top_package, zone AS top_zone
        FROM fact_exact
        QUALIFY row_number() OVER (PARTITION BY registration_date ORDER BY total_registrations DESC,
            package_name, zone, package_type, device_type, payment_method) = 1""",
    "watched": f"SELECT * FROM fact_exact WHERE package_name IN ({_values(WATCHED_PACKAGES)})",
    "cell_stats": """
        SELECT registration_date, package_name, zone, package_type, device_type, payment_method,
               total_registrations, avg(total_registrations) OVER before AS avg_7day,
               stddev_samp(total_registrations) OVER before AS std_7day
        FROM watched
        WINDOW before AS (ORDER BY registration_date, package_name, zone, package_type, device_type, payment_method
                          ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "package_days": """
        SELECT registration_date, package_name, CAST(sum(total_registrations) AS BIGINT) AS total_registrations
        FROM watched GROUP BY ALL""",
    "day_stats": """
        SELECT registration_date, package_name, total_registrations,
               avg(total_registrations) OVER before AS avg_7day,
               stddev_samp(total_registrations) OVER before AS std_7day
        FROM package_days
        WINDOW before AS (PARTITION BY package_name ORDER BY registration_date
                          ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    **{
        f"{grain}_labels": f"""
        SELECT * REPLACE (round(avg_7day, 6) AS avg_7day, round(std_7day, 6) AS std_7day),
               CASE WHEN total_registrations > avg_7day + 2 * std_7day THEN 'high_anomaly'
                    WHEN total_registrations < avg_7day - 2 * std_7day THEN 'low_anomaly'
                    ELSE 'normal' END AS anomaly_status
        FROM {grain}_stats WHERE avg_7day IS NOT NULL"""
        for grain in ("cell", "day")
    },
    "checks": f"""
        SELECT 'null_count' AS "check", 'subscription_id' AS "column", 'FAIL' AS severity,
               count(*) FILTER (subscription_id IS NULL) AS violations FROM dim
        UNION ALL SELECT 'null_count', 'customer_id', 'FAIL', count(*) FILTER (customer_id IS NULL) FROM dim
        UNION ALL SELECT 'null_count', 'package_name', 'FAIL', count(*) FILTER (package_name IS NULL) FROM dim
        UNION ALL SELECT 'null_count', 'activation_date', 'FAIL', count(*) FILTER (activation_date IS NULL) FROM dim
        UNION ALL SELECT 'row_count', 'dim_subscriptions', 'FAIL', CASE count(*) WHEN 0 THEN 1 ELSE 0 END FROM dim
        UNION ALL SELECT 'row_count', 'fact_daily_registrations', 'FAIL',
                         CASE count(*) WHEN 0 THEN 1 ELSE 0 END FROM fact_exact
        UNION ALL SELECT 'duplicates', 'subscription_id', 'WARN', count(*) - count(DISTINCT subscription_id) FROM dim
        UNION ALL SELECT 'value_range', 'price_monthly_vnd', 'FAIL',
                         count(*) FILTER (price_monthly_vnd NOT BETWEEN 0 AND 10000000) FROM dim
        UNION ALL SELECT 'value_range', 'usage_percentage', 'WARN',
                         count(*) FILTER (usage_percentage NOT BETWEEN 0 AND 200) FROM dim
        UNION ALL SELECT 'domain', 'zone', 'FAIL', count(*) FILTER (zone NOT IN ({_values(ZONES)})) FROM dim
        UNION ALL SELECT 'domain', 'status', 'FAIL', count(*) FILTER (status NOT IN ({_values(STATUSES)})) FROM dim
        UNION ALL SELECT 'freshness', 'last_updated', CASE count(last_updated) WHEN 0 THEN 'FAIL' ELSE 'WARN' END,
                         CASE WHEN max(last_updated) > {LATER} - INTERVAL 2 HOUR THEN 0 ELSE 1 END FROM dim""",
    "graded": """
        SELECT "check", "column", severity, CAST(violations AS BIGINT) AS violations,
               CASE WHEN violations > 0 THEN severity ELSE 'PASS' END AS status
        FROM checks""",
}

# The same models over silver with burst flags.
for _name, _over, _of in (("dim", "silver_burst", "silver"), ("fact_exact", "dim_burst", "dim"), ("kpis", "fact_exact_burst", "fact_exact")):
    STEPS[f"{_name}_burst"] = STEPS[_name].replace(f"FROM {_of} ", f"FROM {_over} ")

_DETAIL_COLUMNS = ", ".join(SILVER_COLUMNS)
_LANDED = f"""
    SELECT {', '.join(BRONZE_COLUMNS)}, minute(landed) AS "minute", CAST(year(landed) AS INTEGER) AS "year",
           CAST(month(landed) AS INTEGER) AS "month", CAST(day(landed) AS INTEGER) AS "day",
           CAST(hour(landed) AS INTEGER) AS "hour"
    FROM (SELECT *, CAST(created_at AS TIMESTAMP) AS landed FROM bronze)"""
_LANDED_DAILY = _LANDED.replace("CAST(created_at AS TIMESTAMP) AS landed", "date_trunc('day', CAST(created_at AS TIMESTAMP)) AS landed")
_LIFETIME = """first_subscription_date, last_subscription_date, total_subscriptions, total_cancellations,
    round(avg_spending, 6) AS avg_spending, current_package, is_auto_renewal, customer_lifetime_days"""


def _summary(labels: str) -> str:
    return f"""
    SELECT k.*, top_package, top_zone, a.package_name AS anomaly_package, a.anomaly_status,
           a.total_registrations AS anomaly_package_registrations, {NOW} AS generated_at
    FROM kpis k JOIN largest_cell USING (registration_date)
    LEFT JOIN {labels} a ON a.registration_date = k.registration_date AND a.anomaly_status <> 'normal'"""


def _checks(name: str) -> str:
    return f"""SELECT * FROM graded WHERE "check" = '{name}'"""


FINAL = {
    "bronze_scan": "SELECT * FROM bronze",
    "bronze_scan_pruned": _LANDED + " WHERE day(landed) = 15",
    "bronze_merge_schema": _LANDED,
    "bronze_land_roundtrip": _LANDED,
    "silver_table_roundtrip": "SELECT * FROM silver",
    "silver_append": "SELECT * FROM silver",
    "silver_stream_ingest": "SELECT * FROM silver",
    "refreshed_tables": """
        SELECT 'silver.subscriptions' AS "table", count(*) AS "rows" FROM silver
        UNION ALL SELECT 'silver.dim_subscriptions', count(*) FROM dim
        UNION ALL SELECT 'silver.fact_daily_registrations', count(*) FROM fact_exact
        UNION ALL SELECT 'gold.customer_behavior', count(*) FROM lifetime
        UNION ALL SELECT 'gold.daily_summary', count(*) FROM (""" + _summary("cell_labels") + ")",
    "stage_row_counts": """
        SELECT 'bronze' AS stage, count(*) AS "rows" FROM bronze UNION ALL SELECT 'silver', count(*) FROM valid""",
    "valid_subscriptions": "SELECT subscription_id, customer_id, package_name, status FROM valid",
    "usage_metrics": """
        SELECT subscription_id, customer_id, data_limit_gb, total_used_gb, subscription_duration_days,
               days_until_expiry, usage_percentage FROM silver""",
    "price_segment": "SELECT subscription_id, customer_id, price_monthly_vnd, customer_segment FROM silver",
    "silver_subscriptions": "SELECT * FROM silver",
    "silver_subscriptions_burst": "SELECT * FROM silver_burst",
    "registration_burst": """
        SELECT subscription_id, customer_id, package_name, zone, created_at, registration_count FROM counted""",
    "burst_suspicious": "SELECT subscription_id, customer_id, created_at, is_suspicious FROM silver_burst",
    "event_burst": """
        SELECT event_id, event_type, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts
               RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS events_last_hour
        FROM events""",
    "dim_subscriptions": "SELECT * FROM dim",
    "customer_subscription_rank": """
        SELECT customer_id, subscription_id, activation_date, customer_subscription_rank FROM dim""",
    "fact_daily": "SELECT * REPLACE (round(avg_price, 6) AS avg_price) FROM fact_exact",
    "customer_lifetime": f"SELECT customer_id, {_LIFETIME} FROM lifetime",
    "customer_latest_package": """
        SELECT customer_id, arg_max(package_name, (activation_date, created_at, subscription_id)) AS current_package
        FROM dim GROUP BY customer_id""",
    "customer_behavior": f"""
        SELECT customer_id,
               CASE WHEN customer_lifetime_days > 365 AND total_subscriptions > 3 THEN 'loyal'
                    WHEN avg_spending > 300000 THEN 'high_value' WHEN total_cancellations > 0 THEN 'churn_risk'
                    WHEN customer_lifetime_days < 30 THEN 'new' ELSE 'regular' END AS customer_segment, {_LIFETIME}
        FROM lifetime""",
    "daily_kpis": "SELECT * FROM kpis",
    "daily_top_package": "SELECT registration_date, top_package FROM largest_cell",
    "daily_top_zone": "SELECT registration_date, top_zone FROM largest_cell",
    "daily_top_package_total": """
        SELECT registration_date, package_name AS top_package, CAST(n AS BIGINT) AS registrations
        FROM (SELECT registration_date, package_name, sum(total_registrations) AS n FROM fact_exact GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY registration_date ORDER BY n DESC, package_name) = 1""",
    "rolling_anomaly": "SELECT * FROM cell_labels",
    "rolling_anomaly_daily": "SELECT * FROM day_labels",
    "daily_summary": _summary("cell_labels"),
    "daily_summary_per_day": _summary("day_labels"),
    "package_top5": """
        SELECT package_name, count(*) AS "rows" FROM bronze WHERE package_name IS NOT NULL
        GROUP BY package_name ORDER BY count(*) DESC, package_name LIMIT 5""",
    "batch_profile": """
        SELECT count(*) AS "rows", count(*) FILTER (is_anomaly) AS anomalies,
               count(*) FILTER (status = 'cancelled') AS cancelled FROM bronze""",
    "dq_nulls": _checks("null_count"),
    "dq_row_count": """
        SELECT 'dim_subscriptions' AS "table", count(*) AS "rows",
               CASE count(*) WHEN 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM dim
        UNION ALL SELECT 'fact_daily_registrations', count(*),
               CASE count(*) WHEN 0 THEN 'FAIL' ELSE 'PASS' END FROM fact_exact""",
    "dq_duplicates": _checks("duplicates"),
    "dq_ranges": _checks("value_range"),
    "dq_domains": _checks("domain"),
    "dq_freshness": f"""
        SELECT last_updated, hours_ago,
               CASE WHEN hours_ago IS NULL THEN 'FAIL' WHEN hours_ago >= 2 THEN 'WARN' ELSE 'PASS' END AS status
        FROM (SELECT max(last_updated) AS last_updated,
                     round(date_diff('microsecond', max(last_updated), {LATER}) / 3.6e9, 6) AS hours_ago FROM dim)""",
    "dq_report": "SELECT * FROM graded",
    "contract_not_null": """
        SELECT 'subscription_id' AS "column", count(*) FILTER (subscription_id IS NULL) AS violations FROM silver
        UNION ALL SELECT 'customer_id', count(*) FILTER (customer_id IS NULL) FROM silver
        UNION ALL SELECT 'package_name', count(*) FILTER (package_name IS NULL) FROM silver
        UNION ALL SELECT 'activation_date', count(*) FILTER (activation_date IS NULL) FROM silver""",
    "contract_unique": """
        SELECT 'subscription_id' AS "column", count(*) AS violations
        FROM (SELECT subscription_id FROM silver WHERE subscription_id IS NOT NULL
              GROUP BY subscription_id HAVING count(*) > 1)""",
    "contract_accepted_values": f"""
        SELECT 'status' AS "column", status AS "value", count(*) AS "rows", status IN ({_values(STATUSES)}) AS accepted
        FROM silver WHERE status IS NOT NULL GROUP BY status
        UNION ALL
        SELECT 'zone', zone, count(*), zone IN ({_values(ZONES)}) FROM silver WHERE zone IS NOT NULL GROUP BY zone""",
}


FINAL |= {
    "refreshed_dim": FINAL["dim_subscriptions"],
    "refreshed_customers": FINAL["customer_behavior"],
    "refreshed_summary": FINAL["daily_summary"],
    "refreshed_row_counts": FINAL["stage_row_counts"],
    "refresh_of_nothing": "SELECT 'tables' AS stage, count(*) AS \"rows\" FROM bronze WHERE price_monthly_vnd < 0",
    "refresh_incremental": f"""
        SELECT * REPLACE (CASE WHEN auto_renewal THEN {EARLIER} ELSE {NOW} END AS last_updated) FROM silver_burst""",
    "refresh_two_clocks": "SELECT * EXCLUDE (last_updated) FROM dim_burst",
    "refresh_parts_fact": "SELECT * REPLACE (round(avg_price, 6) AS avg_price) FROM fact_exact_burst",
    "refresh_parts_customers": FINAL["customer_behavior"],
    "refresh_parts_summary": _summary("cell_labels").replace("FROM kpis k", "FROM kpis_burst k"),
    "refresh_parts_bursts": "SELECT DISTINCT package_name, zone, created_at FROM counted WHERE registration_count > 3",
    "refresh_rewritten": """
        SELECT package_type, zone, CAST(year(activation_date) AS INTEGER) AS activation_year,
               '2024-01-15' AS landed_day, count(*) AS "rows"
        FROM typed WHERE NOT auto_renewal AND date_trunc('week', created_at) = DATE '2024-01-15'
        GROUP BY ALL""",
    "bronze_mixed_types": _LANDED_DAILY,
    "bronze_compacted": f"""
        SELECT "year", "month", "day", "hour", count(*) AS "rows", CAST(1 AS BIGINT) AS files FROM ({_LANDED_DAILY}) GROUP BY ALL""",
    "daily_top_zone_nulls": """
        SELECT registration_date, package_name AS top_package, zone AS top_zone FROM (
          SELECT *, row_number() OVER (PARTITION BY registration_date ORDER BY total_registrations DESC,
                   package_name NULLS LAST, zone NULLS LAST, package_type NULLS LAST, device_type NULLS LAST,
                   payment_method NULLS LAST) AS place
          FROM (SELECT CAST(created_at AS DATE) AS registration_date, package_name, package_type, device_type, payment_method,
                       CASE WHEN CAST(substr(subscription_id, 3) AS BIGINT) % 3 <> 0 THEN zone END AS zone,
                       count(*) AS total_registrations
                FROM dim GROUP BY ALL))
        WHERE place = 1""",
}


def sql_by_query() -> dict[str, str]:
    steps = ",\n".join(f"{name} AS ({body})" for name, body in STEPS.items())
    return {name: f"WITH {steps}\n{final}" for name, final in FINAL.items()}
