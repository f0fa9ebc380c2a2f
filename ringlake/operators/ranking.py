"""Numbering rows inside groups, with groups of any size split over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ringlake.sources.scratch import written


def row_numbers(rows: DataFrame, by: str, order: list[Column], name: str, runs: int | None = None) -> DataFrame:
    """``row_number()`` per value of ``by`` in ``order``.

    The rows are range-sorted by group, order and a unique copy number into ``runs``
    runs of about equal size (as many as the session has shuffle partitions), and written: positions are read back, never computed
    twice, and survive a lost executor.  Inside a run a window numbers each group's part.
    A group that a run boundary cuts continues from the size of its parts in
    earlier runs, so neither a hot group nor a group of equal rows is one task.  A
    boundary cuts at most one group: fewer groups than runs are broadcast below.
    """
    runs = runs or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = rows.withColumn("__copy", F.monotonically_increasing_id())
    keys = [F.col(by), *order, F.col("__copy")]
    sorted_runs = written(
        written(copies, "rank-copies").repartitionByRange(runs, *keys).withColumn("__run", F.spark_partition_id()),
        "rank-runs",
    )
    inside = Window.partitionBy("__run", by).orderBy(*order, "__copy")
    # Rows of a group in earlier runs; only for groups that begin there.
    parts = sorted_runs.groupBy(F.col(by).alias("__by"), F.col("__run").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
    spread = parts.groupBy("__by").agg(F.sort_array(F.collect_list(F.struct("__r", "__n"))).alias("__parts"))
    cut = spread.where(F.size("__parts") > 1)
    earlier = F.aggregate(
        F.filter("__parts", lambda p: p["__r"] < F.col("__run")), F.lit(0).cast("long"), lambda n, p: n + p["__n"]
    )
    return (
        sorted_runs.withColumn("__at", F.row_number().over(inside))
        .join(F.broadcast(cut), F.col(by).eqNullSafe(F.col("__by")), "left")
        .withColumn(name, (F.col("__at") + F.coalesce(earlier, F.lit(0))).cast("int"))
        .select(*rows.columns, name)
    )


HOT_ROWS = 5_000_000


def ranked_rows(
    rows: DataFrame, by: str, order: list[Column], name: str, hot_rows: int = HOT_ROWS, within: str | None = None, **split: int
) -> DataFrame:
    """``row_number()`` per value of ``by`` in ``order``, with one shuffle of the rows.

    Groups are counted first, from the key column alone.  Those of more than ``hot_rows``
    rows (at most rows / ``hot_rows`` of them) are numbered in runs by ``row_numbers``, all
    others by a window.  ``rows`` are read twice, so they should come from a table.
    ``within`` names a column that ``by`` decides: the shuffle is by that, so that the rows
    of one of its values come out of one task and can be written to its folder as they are.
    Then groups are counted only in those of its values that have more than ``hot_rows`` rows.
    """
    large = _larger(rows, within, hot_rows) if within else None
    hot = [] if large == [] else _larger(rows if large is None else rows.where(_one_of(within, large)), by, hot_rows)
    number = F.row_number().over(Window.partitionBy(*([within] if within else []), by).orderBy(*order)).alias(name)
    numbered = lambda some: (some.repartition(within) if within else some).select("*", number)
    if not hot:
        return numbered(rows)
    is_hot = _one_of(by, hot)
    split_up = row_numbers(rows.where(is_hot), by, order, name, **split)
    return numbered(rows.where(~is_hot)).unionByName(split_up)


def _larger(rows: DataFrame, by: str, n: int) -> list:
    """Values of ``by`` with more than ``n`` rows."""
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    return [r[0] for r in sizes.where(F.col("__n") > n).select(by).collect()]


def _one_of(column: str, values: list) -> Column:
    return F.coalesce(F.col(column).isin(*[v for v in values if v is not None]), F.lit(None in values))
