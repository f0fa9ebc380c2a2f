from datetime import date, timedelta

from pyspark.sql import functions as F

from helpers import CLOCK, plan, silver_rows
from ringlake.functions import rules
from ringlake.plans.customers import customer_behavior, customer_lifetime
from ringlake.plans.subscriptions import fact_daily, subscription_details
from ringlake.operators.profile import flag_counts, stage_counts, top_values
from helpers import bronze_rows


def test_expiry_status_boundaries(spark):
    days = [-1, 0, 7, 8]
    rows = [{"subscription_id": f"VT{i}", "expiry_date": (CLOCK.today + timedelta(days=d)).isoformat()} for i, d in enumerate(days)]
    rows.append({"subscription_id": "VT9", "expiry_date": None})
    found = subscription_details(silver_rows(spark, *rows)).orderBy("subscription_id").collect()
    assert [r.expiry_status for r in found] == ["expired", "expiring_soon", "expiring_soon", "active", "active"]


def test_price_per_gb_and_undated_rows(spark):
    rows = [{"subscription_id": "VT0"}, {"subscription_id": "VT1", "data_limit_gb": 0.0},
            {"subscription_id": "VT2", "data_limit_gb": None}, {"subscription_id": "VT3", "activation_date": None}]
    found = subscription_details(silver_rows(spark, *rows)).orderBy("subscription_id").collect()
    assert [r.price_per_gb for r in found] == [3500.0, None, None]


def test_fact_measures(spark):
    rows = [
        {"customer_id": "KH1"}, {"customer_id": "KH1", "status": "cancelled", "auto_renewal": None},
        {"customer_id": "KH2", "status": None, "is_anomaly": True, "price_monthly_vnd": None},
        {"customer_id": "KH2", "created_at": None}, {"customer_id": "KH3", "device_type": "tablet"},
    ]
    fact = fact_daily(subscription_details(silver_rows(spark, *rows)))
    assert fact.count() == 3
    row = fact.where("registration_date is not null and device_type = 'router'").first()
    assert row.registration_date == date(2024, 1, 10)
    assert row.asDict() | {"avg_price": row.avg_price} == row.asDict()
    assert (row.total_registrations, row.cancelled_registrations, row.suspicious_registrations) == (3, 1, 1)
    assert (row.auto_renewal_registrations, row.unique_customers, row.avg_price) == (2, 2, 350000.0)
    assert fact.agg(F.sum("total_registrations")).first()[0] == 5


def test_fact_spreads_a_hot_cell_over_customers(spark):
    explained = plan(fact_daily(subscription_details(silver_rows(spark, {}))))
    exchanges = [line for line in explained.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and any("customer_id" in line for line in exchanges)
    assert "Expand" not in explained


def _lifetime_row(spark, days, subscriptions, spending, cancellations):
    df = spark.createDataFrame([(days, subscriptions, spending, cancellations)], "a int, b long, c double, d long")
    return df.select(rules.lifetime_segment(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0]


def test_lifetime_segment_precedence(spark):
    assert _lifetime_row(spark, 366, 4, 400000.0, 2) == "loyal"
    assert _lifetime_row(spark, 365, 4, 300001.0, 2) == "high_value"
    assert _lifetime_row(spark, 366, 3, 300000.0, 1) == "churn_risk"
    assert _lifetime_row(spark, 29, 1, 300000.0, 0) == "new"
    assert _lifetime_row(spark, 30, 1, 300000.0, 0) == "regular"
    assert _lifetime_row(spark, 366, 4, None, 0) == "loyal"
    assert _lifetime_row(spark, 100, 4, None, 0) == "regular"


def test_customer_lifetime(spark):
    rows = [
        {"subscription_id": "VT1", "package_name": "Mimax", "activation_date": "2024-01-02", "auto_renewal": False},
        {"subscription_id": "VT1", "package_name": "Data Pro", "activation_date": "2024-01-20", "status": "cancelled",
         "auto_renewal": True, "price_monthly_vnd": 50000},
        {"subscription_id": "VT2", "customer_id": "KH2", "auto_renewal": None},
    ]
    silver = silver_rows(spark, *rows)
    row = customer_lifetime(silver, CLOCK).where("customer_id = 'KH1'").first()
    assert (row.first_subscription_date, row.last_subscription_date) == (date(2024, 1, 2), date(2024, 1, 20))
    assert (row.total_subscriptions, row.total_cancellations, row.avg_spending) == (1, 1, 200000.0)
    assert (row.current_package, row.is_auto_renewal, row.customer_lifetime_days) == ("Mimax", True, 29)
    latest = customer_lifetime(silver, CLOCK, latest_package=True).where("customer_id = 'KH1'").first()
    assert latest.current_package == "Data Pro"
    behavior = customer_behavior(silver, CLOCK)
    assert behavior.columns[:2] == ["customer_id", "customer_segment"]
    assert {r.customer_id: r.customer_segment for r in behavior.collect()} == {"KH1": "churn_risk", "KH2": "high_value"}


def test_profile(spark):
    names = ["B", "B", "A", "A", "C", "D", "E", "F", None]
    bronze = bronze_rows(spark, *[{"package_name": n, "is_anomaly": n == "A", "status": "cancelled" if n == "C" else None} for n in names])
    assert [(r.package_name, r.rows) for r in top_values(bronze, "package_name").collect()] == [
        ("A", 2), ("B", 2), ("C", 1), ("D", 1), ("E", 1),
    ]
    assert "TakeOrderedAndProject" in plan(top_values(bronze, "package_name"))
    assert tuple(flag_counts(bronze).first()) == (9, 2, 1)
    assert {r.stage: r.rows for r in stage_counts(bronze).collect()} == {"bronze": 9, "silver": 8}
