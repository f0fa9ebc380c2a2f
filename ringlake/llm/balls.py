"""Links of vectors that lie in balls: dense groups within half the angle of a pivot.

All rows of a ball are linked with each other, by the triangle inequality on angles, and
are counted by its weight.  For any other row the angle to the pivot, less or more than
the ball's radius away from the range, decides for the ball as a whole; only in between
are rows and members compared one by one, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ringlake.sources.scratch import written

DENSE = 8  # rows of a sample within half the range that make a ball
AT_ONCE = 4096  # balls whose pivots are broadcast together
BLOCK = 2048
SAFE = 1e-6  # radians by which angles may be wrong


def matrix(column) -> np.ndarray:
    """Rows of unit vectors in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def half_range(reach: float) -> float:
    """The least cosine to a pivot at which two rows are surely within ``reach`` of each other."""
    return float(np.cos(np.arccos(reach) / 2 - SAFE))


def dense_pivots(x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a sample with ``DENSE`` others around that no earlier pivot covers, and which rows are covered."""
    near = x @ x.T >= half_range(reach)
    covered, pivots = np.zeros(len(x), dtype=bool), []
    while len(x):
        counts = near[:, ~covered].sum(axis=1)
        best = int(counts.argmax())
        if counts[best] < DENSE:
            break
        pivots.append(best)
        covered |= near[best]
    return x[pivots], covered


def _hitter(shared, reach: float):
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, copies, folded, ball, whole): the balls besides its own that a row may have links in."""
        by_label, theta = shared.value, float(np.arccos(reach))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, labels, own = matrix(batch.column("vector")), np.array(batch.column("label").to_pylist(), dtype=object), batch.column("own").to_pylist()
            rows, balls, whole = [], [], []
            for label in set(labels.tolist()) & by_label.keys():
                names, pivots, radius = by_label[label]
                some = np.flatnonzero(labels == label)
                angle = np.arccos(np.clip(x[some] @ pivots.T, -1, 1))
                r, b = np.nonzero(angle - radius <= theta + SAFE)
                apart = [own[some[i]] != names[k] for i, k in zip(r, b, strict=True)]
                r, b = r[apart], b[apart]
                rows.append(some[r])
                balls += [names[k] for k in b]
                whole.append(angle[r, b] + radius[b] <= theta - SAFE)
            take = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(take), batch.column("copies").take(take), pa.array([o is not None for o in own]).take(take),
                    pa.array(balls, pa.string()), pa.array(np.concatenate(whole) if whole else np.zeros(0, bool)),
                ],
                ["node", "copies", "folded", "ball", "whole"],
            )

    return hits


def _comparer(reach: float):
    def compared(table: pa.Table) -> pa.Table:
        """(node, more, a, b): links between rows and members of a ball, an edge for each row that has one."""
        member = table.column("member").to_numpy()
        node, copies, folded = table.column("node").to_numpy(), table.column("copies").to_numpy(), table.column("folded").to_numpy()
        x = matrix(table.column("vector"))
        rows, members = np.flatnonzero(~member), np.flatnonzero(member)
        linked = x[rows] @ x[members].T >= reach
        found, first = linked @ copies[members], linked.argmax(axis=1)
        # Folded rows count for themselves only: members ask their balls as well.
        back = linked[~folded[rows]].T.astype(np.int64) @ copies[rows[~folded[rows]]]
        has = np.flatnonzero(found)
        return pa.table(
            {
                "node": pa.array(np.concatenate([node[rows[has]], node[members[back > 0]]]), pa.int64()),
                "more": pa.array(np.concatenate([found[has], back[back > 0]]), pa.int64()),
                "a": pa.array([*node[rows[has]].tolist(), *[None] * int((back > 0).sum())], pa.int64()),
                "b": pa.array([*node[members[first[has]]].tolist(), *[None] * int((back > 0).sum())], pa.int64()),
            }
        )

    return compared


def ball_links(single: DataFrame, folded: DataFrame, pivots: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """((node, more) links of each row within and with balls, edges (a, b) that connect them).

    ``single`` rows are in no ball, ``folded`` ones in the ball ``path``: both have (node, copies,
    vector, label), the latter their ``angle`` to the pivot.  ``pivots`` are (path, pivot).
    """
    spark = folded.sparkSession
    balls = written(
        folded.groupBy("path", "label")
        .agg(F.min("node").alias("hub"), F.sum("copies").alias("weight"), F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n"))
        .join(pivots, "path"),
        "balls",
    )
    columns = ["node", "copies", "vector", "label"]
    asked = single.select(*columns, F.lit(None).cast("string").alias("own")).unionByName(folded.select(*columns, F.col("path").alias("own")))
    slices = max(-(-balls.count() // AT_ONCE), 1)
    schema, hits = "node long, copies long, folded boolean, ball string, whole boolean", None
    for number in range(slices):
        some = balls.where(F.pmod(F.xxhash64("path"), F.lit(slices)) == number).select("path", "label", "pivot", "radius").collect()
        by_label: dict[str, list] = {}
        for r in some:
            by_label.setdefault(r["label"], []).append(r)
        held = {
            label: ([r["path"] for r in rows], np.array([r["pivot"] for r in rows]), np.array([r["radius"] for r in rows]))
            for label, rows in by_label.items()
        }
        part = asked.mapInArrow(_hitter(spark.sparkContext.broadcast(held), reach), schema)
        hits = part if hits is None else hits.unionByName(part)
    hits = written(hits, "ball-hits")
    whole = hits.where("whole").join(balls.select(F.col("path").alias("ball"), "weight", "hub"), "ball")

    # Between: rows in blocks meet members in blocks.
    close = hits.where("NOT whole")
    sizes = close.groupBy("ball").agg(F.count(F.lit(1)).alias("rows")).join(balls.select(F.col("path").alias("ball"), "n"), "ball")
    sizes = written(sizes.select("ball", F.ceil(F.col("rows") / BLOCK).cast("int").alias("is"), F.ceil(F.col("n") / BLOCK).cast("int").alias("js")), "ball-blocks")
    at = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    rows = close.join(sizes, "ball").join(asked.select("node", "vector"), "node").select(
        "ball", at("is").alias("i"), every("js").alias("j"), "node", "copies", "folded", "vector", F.lit(False).alias("member")
    )
    members = folded.withColumnRenamed("path", "ball").join(sizes, "ball").select(
        "ball", every("is").alias("i"), at("js").alias("j"), "node", "copies", F.lit(True).alias("folded"), "vector", F.lit(True).alias("member")
    )
    between = written(
        rows.unionByName(members).groupBy("ball", "i", "j").applyInArrow(_comparer(reach), "node long, more long, a long, b long"), "ball-compared"
    )
    # Rows outside that are linked with a whole ball are links of all its members.
    outside = whole.where("NOT folded").groupBy("ball").agg(F.sum("copies").alias("outside"))
    inside = (
        folded.select("node", F.col("path").alias("ball"))
        .join(balls.select(F.col("path").alias("ball"), "weight", "hub"), "ball")
        .join(outside, "ball", "left")
        .select("node", "hub", (F.col("weight") - 1 + F.coalesce("outside", F.lit(0))).alias("more"))
    )
    counts = (
        inside.select("node", "more")
        .unionByName(whole.select("node", F.col("weight").alias("more")))
        .unionByName(between.select("node", "more"))
        .groupBy("node")
        .agg(F.sum("more").alias("more"))
    )
    edges = (
        inside.select(F.col("node").alias("a"), F.col("hub").alias("b"))
        .unionByName(whole.select(F.col("node").alias("a"), F.col("hub").alias("b")))
        .unionByName(between.where("a IS NOT NULL").select("a", "b"))
    )
    return counts, edges
