"""Trailing-row statistics over one total order, without a single-task window.

Rows get a global position from two bounded steps: an offset per slice value (one
row per calendar day in the daily models) and a row number inside the slice.  The
ordered rows are then cut into equal chunks; each chunk also receives the last
``depth`` rows before it, so that frames at its start are complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_ROWS = 4096


def trailing_rows(
    rows: DataFrame,
    slice_by: str,
    order_within: list[Column],
    depth: int,
    stats: dict[str, Column],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``stats`` over the ``depth`` rows before each row, ordered by ``slice_by`` then ``order_within``.

    NULL slice values come last.  ``depth`` must not exceed ``chunk_rows``.
    """
    if depth > chunk_rows:
        raise ValueError("a frame may not be deeper than a chunk")
    earlier = (
        Window.orderBy(F.col("__slice").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(F.col(slice_by).alias("__slice"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__slice", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy(slice_by).orderBy(*order_within)
    placed = (
        rows.withColumn("__inside", F.row_number().over(inside))
        .join(offsets, F.col(slice_by).eqNullSafe(F.col("__slice")))
        .withColumn("__position", F.col("__offset") + F.col("__inside") - 1)
        .withColumn("__home", F.floor(F.col("__position") / chunk_rows))
    )
    near_end = F.col("__position") % chunk_rows >= chunk_rows - depth
    homes = F.when(near_end, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home"))
    frame = Window.partitionBy("__chunk").orderBy("__position").rowsBetween(-depth, -1)
    return (
        placed.withColumn("__chunk", F.explode(homes))
        .withColumns({name: stat.over(frame) for name, stat in stats.items()})
        .where(F.col("__chunk") == F.col("__home"))
        .select(*rows.columns, *stats)
    )
