"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ringlake.sources.scratch import written


# Below this many edges (16 bytes each) minima are broadcast and few tasks are enough.
FEW_EDGES = 500_000
TASK_EDGES = 250_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node that it can reach.

    Large and small stars in turn: every node hands its neighbours the smallest one it
    knows.  Minima are aggregated before they are shuffled; the join that hands them
    out is a broadcast only for ``FEW_EDGES`` counted edges, and beyond may be split by
    adaptive execution, so a node with most edges is no hot task.  Each round is
    written, which cuts the lineage.  Rounds grow with the logarithm of the longest
    path.  Edges may repeat, point anywhere or to themselves.
    """
    given = written(edges.select("a", "b"), "edges")
    loops = given.where("a = b").select(F.col("a").alias("high"), F.col("a").alias("low"))
    now = written(_directed(given), "edges")
    seen = _digest(now)
    while seen[0]:
        now = written(_small_star(_large_star(now, seen[0]), seen[0]), "edges")
        last, seen = seen, _digest(now)
        if last == seen:
            break
    # Every node but the smallest of its component now points at that one.
    return (
        now.unionByName(now.select(F.col("low").alias("high"), "low")).unionByName(loops)
        .groupBy(F.col("high").alias("node"))
        .agg(F.min("low").alias("component"))
    )


def _sized(frame: DataFrame, edges: int) -> DataFrame:
    """As many tasks as this many edges need, if that is fewer."""
    return frame.coalesce(-(-edges // TASK_EDGES))


def _handed(edges: DataFrame, least: DataFrame, on: str, n: int) -> DataFrame:
    least = _sized(least, n)
    return edges.join(F.broadcast(least) if n <= FEW_EDGES else least, on)


def _directed(edges: DataFrame) -> DataFrame:
    """Edges once each, from the larger node to the smaller."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct()
    )


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node's larger neighbours to the smallest node around it."""
    ends = lambda a, b: F.struct(F.col(a).alias("at"), F.col(b).alias("to"))
    both = edges.select(F.inline(F.array(ends("high", "low"), ends("low", "high"))))
    least = both.groupBy("at").agg(F.least(F.min("to"), F.first("at")).alias("least"))
    handed = _handed(edges.select(F.col("low").alias("at"), F.col("high").alias("to")), least, "at", n)
    return _sized(handed.select(F.col("to").alias("high"), F.col("least").alias("low")).distinct(), n)


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    handed = _handed(edges, least, "high", n).select("low", "high", "least")
    pairs = handed.select(
        F.inline(
            F.array(
                F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
                F.struct(F.col("high"), F.col("least").alias("low")),
            )
        )
    )
    return _sized(pairs.where("high > low").distinct(), n)


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())
