"""Hot keys: adaptive execution splits what the plans leave to it."""

import pytest
from pyspark.sql import functions as F

from helpers import same_rows
from ringlake.operators.trailing import attach_counts, trailing_counts


@pytest.fixture
def small_limits(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)


def test_rows_of_one_hot_instant_are_split(spark, small_limits):
    """A third of the rows share package, zone and instant."""
    n = 30000
    rows = spark.range(0, n, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("package_name"),
        F.when(F.col("id") % 3 == 0, F.timestamp_seconds(F.lit(0))).otherwise(F.timestamp_seconds("id")).alias("created_at"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    counts = trailing_counts(rows, ["package_name"], "created_at", 3600, "n")
    attached = attach_counts(rows, counts, ["package_name"], "created_at", "n")
    found = attached.select("id", "n").collect()
    assert len(found) == n and len({r.id for r in found}) == n
    final = attached.select("id", "payload", "n")
    final.collect()
    explained = final._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in explained
    frame = "count(*) over (partition by package_name order by created_at range between interval 1 hour preceding and current row)"
    assert same_rows(attached.select("id", "n"), rows.selectExpr("id", f"{frame} n"))
