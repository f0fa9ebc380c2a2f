from datetime import date, timedelta
import random

import pytest
from pyspark.sql import Window, functions as F

from helpers import plan, same_rows, silver_rows
from ringlake.operators.ranking import ranked_rows, row_numbers
from ringlake.plans.subscriptions import dim_subscriptions


def _rows(spark, unique=True):
    draw = random.Random(7)
    day = date(2024, 1, 1)
    data = [("hot" if i % 3 == 0 else f"c{i % 40}", day - timedelta(days=draw.randrange(5)), i if unique else 0) for i in range(600)]
    data += [(None, day, 1000 + i) for i in range(30)]
    return spark.createDataFrame(data, "c string, d date, i int").repartition(7)


def _order():
    return [F.col("d").desc_nulls_last(), F.col("i").asc()]


def _expected(rows):
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(*_order())))


@pytest.mark.parametrize("runs", [1, 8, 50])
def test_equal_to_one_window(spark, runs):
    rows = _rows(spark)
    numbered = row_numbers(rows, "c", _order(), "r", runs=runs)
    assert "rank-runs" in plan(numbered)
    assert same_rows(numbered, _expected(rows))


def test_a_group_of_copies_is_split(spark):
    """Equal rows get every number once, from more than one run."""
    rows = spark.createDataFrame([("hot", date(2024, 1, 1), 0)] * 500 + [("x", date(2024, 1, 1), 0)], "c string, d date, i int")
    numbered = row_numbers(rows, "c", _order(), "r", runs=20)
    assert sorted(r.r for r in numbered.where("c = 'hot'").collect()) == list(range(1, 501))
    assert sum("rank-runs" in name for name in numbered.inputFiles()) > 5
    assert numbered.where("c = 'x'").first().r == 1


@pytest.mark.parametrize("hot_rows", [10, 100, 10_000])
def test_hot_groups_take_runs_and_others_a_window(spark, hot_rows):
    """All groups, the hot one alone, and none; the group without a key is one of them."""
    rows = _rows(spark)
    numbered = ranked_rows(rows, "c", _order(), "r", hot_rows, runs=8)
    assert ("rank-runs" in plan(numbered)) == (hot_rows < 10_000)
    assert same_rows(numbered, _expected(rows))


@pytest.mark.parametrize("hot_rows", [10, 100, 10_000])
def test_numbers_within_buckets_take_one_shuffle(spark, hot_rows):
    """Rows come out clustered by the bucket that the group decides, and are not shuffled by group as well."""
    rows = _rows(spark).withColumn("b", F.pmod(F.xxhash64("c"), F.lit(4)))
    numbered = ranked_rows(rows, "c", _order(), "r", hot_rows, within="b", runs=8)
    if hot_rows == 10_000:
        assert plan(numbered).count("hashpartitioning(") == plan(numbered).count("hashpartitioning(b#") == 1
        assert all(r.n == 1 for r in numbered.withColumn("t", F.spark_partition_id()).groupBy("b").agg(F.count_distinct("t").alias("n")).collect())
    assert same_rows(numbered, _expected(rows))


@pytest.mark.parametrize(("hot_rows", "counted"), [(10, ["b", "c"]), (10_000, ["b"])])
def test_groups_are_counted_in_large_buckets_only(spark, monkeypatch, hot_rows, counted):
    rows = _rows(spark).withColumn("b", F.pmod(F.xxhash64("c"), F.lit(4)))
    by, grouped = [], type(rows).groupBy
    monkeypatch.setattr(type(rows), "groupBy", lambda df, *columns: by.append(str(columns[0])) or grouped(df, *columns))
    ranked_rows(rows, "c", _order(), "r", hot_rows, within="b", runs=8)
    assert [column for column in by if column in ("b", "c")] == counted


def test_empty_input(spark):
    assert row_numbers(_rows(spark).limit(0), "c", _order(), "r").count() == 0


def test_newest_subscription_is_first(spark):
    silver = silver_rows(
        spark,
        {"subscription_id": "VT1", "activation_date": "2024-01-01T00:00:00"},
        {"subscription_id": "VT2", "activation_date": "2024-01-05T00:00:00"},
        {"subscription_id": "VT4", "activation_date": "2024-01-05T00:00:00", "created_at": "2024-01-11T00:00:00"},
        {"subscription_id": "VT3", "activation_date": "2024-01-05T00:00:00", "created_at": "2024-01-11T00:00:00"},
        {"subscription_id": "VT5", "activation_date": None},
        {"subscription_id": "VT6", "customer_id": "KH2"},
    )
    for options in ({}, {"runs": 3}, {"hot_rows": 2, "runs": 3}):
        ranked = dim_subscriptions(silver, **options).collect()
        assert {r.subscription_id: r.customer_subscription_rank for r in ranked} == {
            "VT3": 1, "VT4": 2, "VT2": 3, "VT1": 4, "VT6": 1,
        }
