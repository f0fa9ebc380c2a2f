from datetime import date, timedelta
import random

import pytest
from pyspark.sql import Window, functions as F

from helpers import CLOCK, fact_rows, same_rows
from ringlake.operators.rolling import trailing_rows
from ringlake.plans.daily import daily_kpis, daily_summary, daily_top_by_sum, rolling_anomalies

DAY = date(2024, 1, 1)


def _days(spark, totals, package="Mimax"):
    """One cell per day."""
    return fact_rows(spark, [(DAY + timedelta(days=i), package, "north", n, 1) for i, n in enumerate(totals)])


def _labels(df):
    return [r.anomaly_status for r in df.orderBy("registration_date").collect()]


@pytest.mark.parametrize("per_day", [False, True])
def test_two_sigma_labels(spark, per_day):
    # Row 2 has one row before it: no deviation, normal.  Then two equal rows: deviation 0.
    labels = _labels(rolling_anomalies(_days(spark, [5, 5, 6, 5, 1, 40]), per_day))
    assert labels == ["normal", "high_anomaly", "normal", "low_anomaly", "high_anomaly"]


def test_constant_series_is_normal(spark):
    assert _labels(rolling_anomalies(_days(spark, [4, 4, 4, 4]))) == ["normal"] * 3


def test_only_seven_rows_count(spark):
    found = rolling_anomalies(_days(spark, [1000] + [1] * 7 + [2])).orderBy("registration_date").collect()
    assert found[-1].avg_7day == 1.0 and found[-1].std_7day == 0.0
    assert found[-2].avg_7day > 100


def test_other_packages_are_left_out(spark):
    assert rolling_anomalies(_days(spark, [1, 2, 3], package="Data Pro")).isEmpty()


def test_per_day_sums_cells_and_separates_packages(spark):
    fact = fact_rows(
        spark,
        [(DAY, "Mimax", "north", 2, 1), (DAY, "Mimax", "south", 3, 1), (DAY, "Data Tốc Cao", "north", 50, 1),
         (DAY + timedelta(days=1), "Mimax", "north", 9, 1)],
    )
    row = rolling_anomalies(fact, per_day=True).first()
    assert (row.package_name, row.avg_7day, row.total_registrations) == ("Mimax", 5.0, 9)


@pytest.mark.parametrize("chunk_rows", [7, 10, 64, 5000])
def test_chunks_equal_one_window(spark, chunk_rows):
    draw = random.Random(chunk_rows)
    data = [(None if draw.random() < 0.1 else DAY + timedelta(days=draw.randrange(12)), i, draw.randrange(9)) for i in range(300)]
    rows = spark.createDataFrame(data, "day date, i int, n long").repartition(5)
    stats = {"mean": F.avg("n"), "total": F.sum("n")}
    frame = Window.orderBy(F.col("day").asc_nulls_last(), "i").rowsBetween(-7, -1)
    expected = rows.withColumns({name: stat.over(frame) for name, stat in stats.items()})
    assert same_rows(trailing_rows(rows, "day", [F.col("i").asc()], 7, stats, chunk_rows), expected)


def test_frame_deeper_than_chunk_is_refused(spark):
    with pytest.raises(ValueError):
        trailing_rows(_days(spark, [1]), "registration_date", [], 7, {}, chunk_rows=6)


def test_kpis(spark):
    fact = fact_rows(spark, [(DAY, "B", "south", 4, 4), (DAY, "A", "north", 4, 1), (DAY, "C", "central", 2, 1)])
    fact = fact.withColumn("cancelled_registrations", F.col("total_registrations") / 2)
    row = daily_kpis(fact.withColumn("cancelled_registrations", F.col("cancelled_registrations").cast("long"))).first()
    assert (row.total_subscriptions, row.total_cancellations, row.new_customers) == (10, 5, 2)
    assert (row.top_package, row.top_zone) == ("A", "north")
    assert row.cancellation_rate == 50.0 and row.estimated_revenue == 1000.0


def test_rate_of_a_day_without_registrations_is_null(spark):
    assert daily_kpis(fact_rows(spark, [(DAY, "A", "north", 0, 0)])).first().cancellation_rate is None


def test_top_by_sum_differs_from_top_cell(spark):
    fact = fact_rows(spark, [(DAY, "A", "north", 5, 1), (DAY, "B", "north", 4, 1), (DAY, "B", "south", 4, 1)])
    assert daily_kpis(fact).first().top_package == "A"
    assert daily_top_by_sum(fact).first().asDict() == {"registration_date": DAY, "top_package": "B", "registrations": 8}


def test_summary_fans_out_per_anomaly(spark):
    quiet = [(DAY + timedelta(days=i), "Mimax", "north", 5, 1) for i in range(4)]
    one = [(DAY + timedelta(days=4), "Mimax", "north", 50, 1)]
    two = [(DAY + timedelta(days=5), "Mimax", z, n, 1) for z, n in (("north", 9000), ("south", 90000))]
    summary = daily_summary(fact_rows(spark, quiet + one + two), CLOCK).collect()
    per_day = {}
    for row in summary:
        per_day.setdefault(row.registration_date, []).append(row)
    assert [len(per_day[DAY + timedelta(days=i)]) for i in range(6)] == [1, 1, 1, 1, 1, 2]
    assert per_day[DAY][0].anomaly_package is None and per_day[DAY][0].anomaly_status is None
    last = sorted(r.anomaly_package_registrations for r in per_day[DAY + timedelta(days=5)])
    assert last == [9000, 90000]
    assert all(r.total_subscriptions == 99000 for r in per_day[DAY + timedelta(days=5)])
    assert {r.generated_at for r in summary} == {CLOCK.now}


def test_null_loses_ties(spark):
    day = date(2024, 1, 1)
    rows = [(day, "A", None, 3, 1), (day, "A", "north", 3, 1), (day, None, "south", 3, 1), (day, None, "west", 2, 1)]
    fact = fact_rows(spark, rows)
    assert [(r.top_package, r.top_zone) for r in daily_kpis(fact).collect()] == [("A", "north")]
    device = fact.withColumns({"device_type": F.lit(None).cast("string"), "zone": F.lit("z")})
    mixed = device.unionByName(device.withColumns({"device_type": F.lit("modem"), "zone": F.lit("a")}))
    assert daily_kpis(mixed.where("package_name = 'A'")).first().top_zone == "a"
    two = fact_rows(spark, [(day, None, "z", 4, 1), (day, "B", "z", 4, 1)])
    assert daily_top_by_sum(two).first().top_package == "B"
