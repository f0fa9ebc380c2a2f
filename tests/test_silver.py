from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import CLOCK, bronze_rows, plan, silver_rows
from ringlake.plans.silver import BurstRule, to_silver
from ringlake.schemas import SILVER_COLUMNS


def _values(df, column):
    return [row[column] for row in df.orderBy("subscription_id").collect()]


def _ids(values, key):
    return [{"subscription_id": f"VT{i}", key: value} for i, value in enumerate(values)]


def test_contract_columns_and_types(spark):
    silver = silver_rows(spark, {})
    assert silver.columns == SILVER_COLUMNS
    types = dict(silver.dtypes)
    assert types["activation_date"] == types["expiry_date"] == "date"
    assert types["created_at"] == types["last_updated"] == "timestamp"
    assert types["subscription_duration_days"] == types["days_until_expiry"] == "int"
    assert types["usage_percentage"] == "double" and types["is_suspicious"] == "boolean"
    row = silver.first()
    assert (row.activation_date, row.expiry_date) == (date(2024, 1, 1), date(2024, 3, 1))
    assert row.created_at == datetime(2024, 1, 10, 10, 0, 0, 1)
    assert row.last_updated == datetime(2024, 1, 31, 12)
    assert (row.subscription_duration_days, row.days_until_expiry) == (60, 30)


@pytest.mark.parametrize("column", ["subscription_id", "customer_id", "package_name"])
def test_required_columns(spark, column):
    assert silver_rows(spark, {}, {column: None}).count() == 1


def test_unreadable_dates_become_null(spark):
    bad = {"activation_date": "soon", "expiry_date": None, "created_at": "2024-13-45"}
    row = silver_rows(spark, bad).first()
    assert row.activation_date is None and row.expiry_date is None and row.created_at is None
    assert row.subscription_duration_days is None and row.days_until_expiry is None


def test_price_segment_boundaries(spark):
    prices = [199999, 200000, 499999, 500000, None]
    segments = _values(silver_rows(spark, *_ids(prices, "price_monthly_vnd")), "customer_segment")
    assert segments == ["basic", "standard", "standard", "premium", "basic"]


def test_usage_percentage(spark):
    cases = [
        {"subscription_id": "VT0", "data_limit_gb": 0.0},
        {"subscription_id": "VT1", "data_limit_gb": None},
        {"subscription_id": "VT2", "total_used_gb": None},
        {"subscription_id": "VT3", "data_limit_gb": 50.0},
        {"subscription_id": "VT4", "data_limit_gb": 0.0, "total_used_gb": None},
    ]
    assert _values(silver_rows(spark, *cases), "usage_percentage") == [0.0, 0.0, None, 50.0, 0.0]


def test_anomaly_flag(spark):
    assert _values(silver_rows(spark, *_ids([True, False, None], "is_anomaly")), "is_suspicious") == [True, False, False]


def test_burst_rule_edges(spark):
    times = ["2024-01-10T10:00:00", "2024-01-10T10:30:00", "2024-01-10T11:00:00", "2024-01-10T11:00:00.000001"]
    flags = _values(silver_rows(spark, *_ids(times, "created_at"), burst=BurstRule(2)), "is_suspicious")
    # The third row still sees the first, exactly an hour ago; the fourth does not, but counts three as well.
    assert flags == [False, False, True, True]
    flags = _values(silver_rows(spark, *_ids(times, "created_at"), burst=BurstRule(3)), "is_suspicious")
    assert flags == [False, False, False, False]


def test_burst_keeps_rows_without_zone_or_time(spark):
    rows = [
        {"subscription_id": "VT0", "zone": None}, {"subscription_id": "VT1", "zone": None},
        {"subscription_id": "VT2", "created_at": None}, {"subscription_id": "VT3", "created_at": "bad"},
        {"subscription_id": "VT4"}, {"subscription_id": "VT5", "is_anomaly": True, "zone": "south"},
    ]
    assert _values(silver_rows(spark, *rows, burst=BurstRule(1)), "is_suspicious") == [True, True, True, True, False, True]


def test_wall_clock_is_the_default(spark):
    row = to_silver(bronze_rows(spark, {})).select("last_updated", F.current_date().alias("today"), "days_until_expiry").first()
    assert row.last_updated.date() == row.today
    assert row.days_until_expiry == (date(2024, 3, 1) - row.today).days


def test_row_wise_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze_rows(spark, {}).write.parquet(path)
    explained = plan(to_silver(spark.read.parquet(path), CLOCK))
    assert "Exchange" not in explained
    for column in ("subscription_id", "customer_id", "package_name"):
        assert f"IsNotNull({column})" in explained
    assert "last_updated:" not in explained.split("ReadSchema")[1]
