from datetime import datetime

from helpers import CLOCK, plan, silver_rows
from ringlake.functions.clock import Clock
from ringlake.operators import quality
from ringlake.plans.subscriptions import fact_daily

BAD = [
    {"zone": "west"}, {"zone": None}, {"price_monthly_vnd": -1}, {"price_monthly_vnd": 10000001},
    {"price_monthly_vnd": 10000000}, {"price_monthly_vnd": None}, {"status": "unknown"}, {"status": "pending"},
    {"total_used_gb": 200.01}, {"total_used_gb": 200.0}, {"total_used_gb": -1.0}, {"activation_date": None},
]


def _rows(spark, *changes):
    return silver_rows(spark, *[{"subscription_id": f"VT{i}", **c} for i, c in enumerate(changes)])


def _report(df):
    return {(r.check, r.column): (r.violations, r.status) for r in df.collect()}


def test_seeded_violations(spark):
    dim = _rows(spark, *BAD).unionByName(_rows(spark, {}))
    report = _report(quality.quality_report(dim, fact_daily(dim), CLOCK))
    assert report == {
        ("null_count", "subscription_id"): (0, "PASS"),
        ("null_count", "customer_id"): (0, "PASS"),
        ("null_count", "package_name"): (0, "PASS"),
        ("null_count", "activation_date"): (1, "FAIL"),
        ("row_count", "dim_subscriptions"): (0, "PASS"),
        ("row_count", "fact_daily_registrations"): (0, "PASS"),
        ("duplicates", "subscription_id"): (1, "WARN"),
        ("value_range", "price_monthly_vnd"): (2, "FAIL"),
        ("value_range", "usage_percentage"): (2, "WARN"),
        ("domain", "zone"): (1, "FAIL"),
        ("domain", "status"): (1, "FAIL"),
        ("freshness", "last_updated"): (0, "PASS"),
    }


def test_empty_tables_fail(spark):
    dim = _rows(spark, {}).limit(0)
    report = _report(quality.quality_report(dim, fact_daily(dim), CLOCK))
    assert report["row_count", "dim_subscriptions"] == (1, "FAIL")
    assert report["row_count", "fact_daily_registrations"] == (1, "FAIL")
    assert report["freshness", "last_updated"] == (1, "FAIL")
    assert report["null_count", "customer_id"] == (0, "PASS")
    assert {r.table: (r.rows, r.status) for r in quality.row_count_report(dim, fact_daily(dim)).collect()} == {
        "dim_subscriptions": (0, "FAIL"), "fact_daily_registrations": (0, "FAIL"),
    }


def test_freshness_limit(spark):
    dim = _rows(spark, {})
    for now, status in ((datetime(2024, 1, 31, 13, 59, 59), "PASS"), (datetime(2024, 1, 31, 14), "WARN")):
        clock = Clock(CLOCK.today, now)
        assert quality.freshness(dim, clock).first().status == status
        assert _report(quality.dim_report(dim, clock))["freshness", "last_updated"][1] == status


def test_missing_ids_count_as_duplicates_but_not_as_repeated(spark):
    rows = _rows(spark, {}, {}, {}).selectExpr("if(subscription_id = 'VT0', 'VT0', null) subscription_id")
    assert _report(quality.run_checks(rows, [quality.duplicate_check()]))["duplicates", "subscription_id"] == (2, "WARN")
    assert quality.contract_unique(rows).first().violations == 0


def test_contracts(spark):
    rows = _rows(spark, {}, {"zone": "west"}, {"zone": None}, {"status": "gone", "activation_date": None})
    rows = rows.unionByName(rows.where("subscription_id = 'VT1'")).unionByName(rows.where("subscription_id = 'VT1'"))
    assert quality.contract_unique(rows).first().violations == 1
    assert {r.column: r.violations for r in quality.contract_not_null(rows).collect()}["activation_date"] == 1
    values = {(r.column, r.value): (r.rows, r.accepted) for r in quality.contract_accepted_values(rows).collect()}
    assert values == {
        ("zone", "north"): (2, True), ("zone", "west"): (3, False), ("status", "active"): (5, True), ("status", "gone"): (1, False),
    }


def test_report_scans_the_table_once(spark, tmp_path):
    path = str(tmp_path / "dim")
    _rows(spark, {}).write.parquet(path)
    explained = plan(quality.dim_report(spark.read.parquet(path), CLOCK))
    assert explained.count("FileScan parquet") == 1 and "Expand" not in explained
