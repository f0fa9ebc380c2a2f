"""Trailing event-time counts that do not depend on how keys are distributed.

A RANGE window per key would pull every row of a hot key through one task.  The
same number comes from a sweep over arrivals and departures:

1. Count rows per (keys, instant).  Partial aggregation collapses rows that
   share an instant before they are shuffled.
2. Every instant adds its count at ``t`` and takes it away after ``t + interval``;
   a running total of these moves at ``t`` is the trailing count, peers included.
3. The running total is cut into one-minute slices.  A slice starts from a carry
   row holding the total of all earlier slices of its keys, so slices are
   independent tasks.

A window partition therefore holds one minute of *distinct* instants (step 3) or
one row per minute of history (the carries): both are limited by the calendar and
not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_CARRY, _ARRIVE, _LEAVE = -1, 0, 1


def trailing_counts(
    rows: DataFrame, keys: list[str], at: str, seconds: int, name: str, weight: str | None = None,
) -> DataFrame:
    """One row per (keys, instant): rows of those keys in ``[instant - seconds, instant]``.

    With ``weight`` a row stands for that many.  NULL keys form a group.  Rows without an instant are peers of each other only:
    their slice is NULL, which sorts first, starts from nothing and adds up to nothing.
    """
    arrivals = rows.groupBy(*keys, at).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("arrivals"))
    span = F.expr(f"interval {int(seconds)} seconds")
    moves = arrivals.select(
        *keys,
        F.inline(
            F.array(
                _move(F.col(at), _ARRIVE, F.col("arrivals")),
                _move(F.col(at) + span, _LEAVE, -F.col("arrivals")),
            )
        ),
    ).withColumn("slice", _minutes(rows.schema[at].dataType))

    earlier = (
        Window.partitionBy(*keys)
        .orderBy(F.col("slice").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carries = (
        moves.groupBy(*keys, "slice")
        .agg(F.sum("change").alias("change"))
        .withColumns(
            {
                "change": F.coalesce(F.sum("change").over(earlier), F.lit(0)),
                "moment": F.lit(None).cast(moves.schema["moment"].dataType),
                "kind": F.lit(_CARRY),
            }
        )
    )
    # The carry comes first.  Departures follow arrivals of the same moment, which
    # makes the far edge inclusive.
    running = (
        Window.partitionBy(*keys, "slice")
        .orderBy(F.col("moment").asc_nulls_first(), "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        moves.unionByName(carries)
        .withColumn("open", F.sum("change").over(running))
        .where(F.col("kind") == _ARRIVE)
        .select(*keys, F.col("moment").alias(at), F.col("open").alias(name))
    )


def _minutes(dtype: T.DataType) -> Column:
    """Minutes of ``moment`` since the epoch, in its own order whatever the session's zone does."""
    if isinstance(dtype, T.TimestampType):
        return F.floor(F.unix_micros("moment") / 60_000_000)
    date = F.unix_date(F.col("moment").cast("date")).cast("long")
    return date * 1440 + F.hour("moment") * 60 + F.minute("moment")


def _move(moment: Column, kind: int, change: Column) -> Column:
    return F.struct(moment.alias("moment"), F.lit(kind).alias("kind"), change.alias("change"))


def attach_counts(rows: DataFrame, counts: DataFrame, keys: list[str], at: str, name: str) -> DataFrame:
    """Bring the counts back to the rows.

    ``counts`` has one row per (keys, instant), or fewer: rows without one get NULL.
    A small written table is broadcast by its file size; otherwise this is a
    sort-merge join whose hot partitions adaptive execution splits on the row side.
    """
    on = [*keys, at]
    right = counts.select(*[F.col(c).alias(f"__{c}") for c in on], name)
    matched = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    return rows.join(right, matched, "left").drop(*[f"__{c}" for c in on])
