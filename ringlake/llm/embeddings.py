"""Near-duplicate embeddings by a robust-pruned flat graph on overlapping shards.

1. Equal vectors of a label are one node with a count.
2. Labels with many nodes are split into shards around centroids, level by level.  A
   node belongs to its nearest centroid, its home, and to all others that are almost
   as near, so shards overlap.  Centroids are fitted on about ``SAMPLE`` nodes of a
   group, chosen by hash; all nodes are assigned.
   Where the sample of a group shows a dense spot, nodes within half of the range around
   it are folded into a ball (``ringlake.llm.balls``) and leave the shards: they are all
   linked, and centroids could only cut them apart.
3. Each shard links its nodes by robust pruning: of its ``POOL`` nearest, a node keeps
   one unless it is nearer to one kept before.  The lists of a node from all its
   shards are united.
4. Each node is searched in its home shard: greedily from the shard's medoids with a
   beam, and from there through everything that is within range.
5. What is found is verified by cosines in double precision, counted in the task, and
   leaves it as a count and a few edges a node; pairs are never rows.
6. ``AUDIT`` nodes, chosen by hash, are compared with all others of their label.  If
   the search missed more than it may, shards are built anew with more overlap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame, functions as F

from ringlake.llm.balls import ball_links, dense_pivots, half_range, matrix as _matrix
from ringlake.llm.components import components
from ringlake.sources.scratch import written

SHARD, SAMPLE, FANOUT, LEVELS = 1024, 1024, 32, 6
GUESTS = 2
POOL, FAR, DEGREE, ALPHA = 64, 8, 24, 1.2
MEDOIDS, BEAM, STRIDE, CHUNK = 16, 24, 16, 256
AUDIT, RECALL, TRIES = 256, 0.99, 3


# --- shards ---------------------------------------------------------------------------
def _fitter(reach: float):
    def fit(table: pa.Table) -> pa.Table:
        """Pivots of a group's dense spots from its sample, and centroids of the rest by a few rounds of spherical k-means."""
        x = _matrix(table.column("vector"))
        x = x[np.argsort(table.column("node").to_numpy(), kind="stable")]
        pivots, covered = dense_pivots(x, reach)
        rest = x[~covered] if (~covered).sum() > 3 else x
        size = table.column("n")[0].as_py() * len(rest) / len(x)
        k = min(FANOUT, max(4, -int(-2 * size // SHARD)), len(rest))
        centers = rest[np.linspace(0, len(rest) - 1, k).astype(int)].copy()
        for _ in range(8):
            own = (rest @ centers.T).argmax(axis=1)
            for c in range(k):
                if (own == c).any():
                    centers[c] = rest[own == c].mean(axis=0)
            centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
        lists = pa.list_(pa.list_(pa.float64()))
        return pa.table(
            {"path": table.column("path").slice(0, 1), "centers": pa.array([centers.tolist()], lists), "pivots": pa.array([pivots.tolist()], lists)}
        )

    return fit


def _assigner(guests: int, reach: float):
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, paths = _matrix(batch.column("vector")), np.array(batch.column("path").to_pylist())
            all_home = batch.column("home").to_numpy(zero_copy_only=False)
            rows, names, homes, angles = [], [], [], []
            for path in np.unique(paths):
                some = np.flatnonzero(paths == path)
                pivots = np.array(batch.column("pivots")[int(some[0])].as_py()).reshape(-1, x.shape[1])
                if len(pivots):
                    likeness = x[some] @ pivots.T
                    best = likeness.argmax(axis=1)
                    nearest = likeness[np.arange(len(some)), best]
                    folded = all_home[some] & (nearest >= half_range(reach))
                    rows.append(some[folded])
                    names += [f"{path}#{i}" for i in best[folded].tolist()]
                    homes.append(np.ones(int(folded.sum()), dtype=bool))
                    angles.append(np.arccos(np.minimum(nearest[folded], 1)))
                    some = some[~folded]
                centers = np.array(batch.column("centers")[int(np.flatnonzero(paths == path)[0])].as_py()).reshape(-1, x.shape[1])
                likeness = x[some] @ centers.T
                best = likeness.argmax(axis=1)
                # Only a node at home becomes a guest elsewhere, so copies add up over levels, not multiply.
                order = np.argsort(-likeness, axis=1, kind="stable")[:, : guests + 1]
                near = likeness >= np.where(all_home[some], np.take_along_axis(likeness, order[:, -1:], axis=1)[:, 0], likeness.max(axis=1))[:, None]
                r, c = np.nonzero(near)
                rows.append(some[r])
                names += [f"{path}/{i}" for i in c.tolist()]
                homes.append((best[r] == c) & all_home[some[r]])
                angles.append(np.full(len(r), -1.0))
            take = pa.array(np.concatenate(rows))
            kept = [batch.column(c).take(take) for c in ("node", "copies", "vector", "label")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(np.concatenate(homes)), pa.array(np.concatenate(angles))],
                ["node", "copies", "vector", "label", "path", "home", "angle"],
            )

    return assigned


def shards(nodes: DataFrame, guests: int, reach: float) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(node, copies, vector, label, path, home) of nodes that are in no ball, once as at home and as guests elsewhere.

    With them the nodes that were folded into balls, with their angle to the pivot, and the pivots (path, pivot).
    """
    columns = ["node", "copies", "vector", "label", "path", "home"]
    kind = nodes.schema["vector"].dataType.simpleString()
    label = F.col("label").cast("string")
    now = nodes.select("node", "copies", "vector", label.alias("label"), label.alias("path"), F.lit(True).alias("home"))
    folded = pivots = None
    for _ in range(LEVELS):
        sizes = written(now.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD), "large-groups")
        if sizes.isEmpty():
            break
        chance = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        picked = now.join(sizes, "path").where(chance < SAMPLE / F.col("n")).select("path", "n", "node", "vector")
        centers = written(
            picked.groupBy("path").applyInArrow(_fitter(reach), "path string, centers array<array<double>>, pivots array<array<double>>"), "centers"
        )
        split = now.join(centers, "path").mapInArrow(
            _assigner(guests, reach), f"node long, copies long, vector {kind}, label string, path string, home boolean, angle double"
        )
        split = written(split, "split")
        here = split.where("angle >= 0")
        at = centers.select(F.col("path").alias("group"), F.posexplode("pivots")).select(F.concat("group", F.lit("#"), "pos").alias("path"), F.col("col").alias("pivot"))
        folded, pivots = (here, at) if folded is None else (folded.unionByName(here), pivots.unionByName(at))
        rest = split.where("angle < 0").select(*columns).unionByName(now.join(centers, "path", "left_anti").select(*columns))
        now = written(rest.join(here.select("node"), "node", "left_anti").select(*columns), "shards")
    return now, folded, pivots


# --- graph ----------------------------------------------------------------------------
def pruned_lists(x: np.ndarray) -> np.ndarray:
    """Neighbours of every row by robust pruning, -1 where there are fewer; angles by chord lengths."""
    n = len(x)
    pool, degree = min(POOL, n - 1), min(DEGREE, n - 1)
    out = np.full((n, max(degree, 1)), -1, dtype=np.int64)
    if n < 2:
        return out
    # A few rows from anywhere lead out of groups that are larger than the pool.
    far = np.random.default_rng(n).integers(0, n, (n, FAR))
    for at in range(0, n, CHUNK):
        block = x[at : at + CHUNK]
        likeness = block @ x.T
        likeness[np.arange(len(block)), np.arange(at, at + len(block))] = -2
        near = np.argpartition(-likeness, pool - 1, axis=1)[:, :pool]
        near = np.concatenate([near, far[at : at + CHUNK]], axis=1)
        order = np.argsort(-np.take_along_axis(likeness, near, axis=1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, axis=1)
        away = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(likeness, near, axis=1), 0))
        pooled = x[near]
        between = np.sqrt(np.maximum(2 - 2 * pooled @ pooled.transpose(0, 2, 1), 0))
        alive = near != np.arange(at, at + len(block))[:, None]
        each = np.arange(len(block))
        for turn in range(degree):
            first = alive.argmax(axis=1)
            has = alive[each, first]
            out[at : at + len(block), turn] = np.where(has, near[each, first], -1)
            alive &= (ALPHA * between[each, first] > away) | ~has[:, None]
            alive[each, first] = False
    return out


def _link_shard(table: pa.Table) -> pa.Table:
    """(node, near): the shard's lists, with the reverse of each edge."""
    node = table.column("node").to_numpy()
    lists = pruned_lists(_matrix(table.column("vector")))
    a, turn = np.nonzero(lists >= 0)
    b = lists[a, turn]
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.argsort(source, kind="stable")
    ends = np.searchsorted(source[order], np.arange(1, len(node) + 1))
    offsets = pa.array(np.append(0, ends), pa.int32())
    return pa.table({"node": pa.array(node, pa.int64()), "near": pa.ListArray.from_arrays(offsets, pa.array(node[target[order]], pa.int64()))})


# --- search ---------------------------------------------------------------------------
def medoids(x: np.ndarray, most: int) -> np.ndarray:
    """The row nearest to the mean, then again and again the one farthest from those taken."""
    taken = [int((x @ x.mean(axis=0)).argmax())]
    likeness = x @ x[taken[0]]
    while len(taken) < min(most, len(x)):
        taken.append(int(likeness.argmin()))
        np.maximum(likeness, x @ x[taken[-1]], out=likeness)
    return np.unique(taken)


def range_search(x: np.ndarray, near: np.ndarray, queries: np.ndarray, starts: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) with cosine from ``reach`` on, walking ``near`` from the starts.

    A query that is a row itself joins the starts, so its own list is always read.
    """
    n, m = len(x), len(queries)
    likeness = np.full((m, n), -2.0)
    walked = np.zeros((m, n), dtype=bool)
    likeness[:, starts] = x[queries] @ x[starts].T
    likeness[np.arange(m), queries] = 1.0
    active = np.arange(m)
    beam = min(BEAM, n)
    while len(active):
        seen = likeness[active]
        bound = np.minimum(np.partition(seen, n - beam, axis=1)[:, n - beam], reach)
        open_ = np.where((seen >= bound[:, None]) & (seen > -2) & ~walked[active], seen, -3)
        stride = min(STRIDE, n)
        best = np.argpartition(-open_, stride - 1, axis=1)[:, :stride]
        r, c = np.nonzero(np.take_along_axis(open_, best, axis=1) > -3)
        q, at = active[r], best[r, c]
        walked[q, at] = True
        active = np.unique(q)
        owner = np.repeat(q, near.shape[1])
        to = near[at].ravel()
        fresh = to >= 0
        fresh[fresh] = likeness[owner[fresh], to[fresh]] == -2
        pairs = np.unique(owner[fresh] * n + to[fresh])
        owner, to = pairs // n, pairs % n
        likeness[owner, to] = np.einsum("ij,ij->i", x[queries[owner]], x[to])
    return np.nonzero(likeness >= reach)


def _searcher(reach: float):
    def searched(table: pa.Table) -> pa.Table:
        """(node, found, least): links of each node at home, copies counted, and a node it is connected to."""
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        home = table.column("home").to_numpy()
        x = _matrix(table.column("vector"))
        order = np.argsort(node, kind="stable")
        lists = table.column("near").combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy()
        place = order[np.minimum(np.searchsorted(node[order], flat), len(node) - 1)]
        inside = node[place] == flat
        near = np.full((len(node), int(sizes.max(initial=1))), -1, dtype=np.int64)
        owner = np.repeat(np.arange(len(node)), sizes)
        turn = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        near[owner[inside], turn[inside]] = place[inside]
        starts = medoids(x, MEDOIDS)
        found = copies - 1
        group = np.arange(len(node))
        queries = np.flatnonzero(home)
        for at in range(0, len(queries), CHUNK):
            some = queries[at : at + CHUNK]
            q, r = range_search(x, near, some, starts, reach)
            q = some[q]
            apart = q != r
            q, r = q[apart], r[apart]
            np.add.at(found, q, copies[r])
            while len(q):  # join the groups of linked rows
                least = np.minimum(group[q], group[r])
                if (group[q] == group[r]).all():
                    break
                np.minimum.at(group, group[q], least)
                np.minimum.at(group, group[r], least)
                while (group[group] != group).any():
                    group = group[group]
        named = node[group]
        keep = home | (named != node)
        return pa.table(
            {
                "node": pa.array(node[keep], pa.int64()),
                "home": pa.array(home[keep]),
                "found": pa.array(found[keep], pa.int64()),
                "least": pa.array(named[keep], pa.int64()),
            }
        )

    return searched


def _search(nodes: DataFrame, reach: float, guests: int) -> tuple[DataFrame, DataFrame]:
    """((node, found) links of each node, edges (a, b) that connect what is linked)."""
    placed, folded, pivots = shards(nodes, guests, reach)
    lists = placed.groupBy("path").applyInArrow(_link_shard, "node long, near array<long>")
    # A list has at most twice DEGREE ids on average in each of a node's few shards.
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    walked = written(
        placed.join(united, "node").groupBy("path").applyInArrow(
            _searcher(reach), "node long, home boolean, found long, least long"
        ),
        "found",
    )
    counts = walked.where("home").select("node", "found")
    edges = walked.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    if folded is not None:
        more, across = ball_links(placed.where("home"), folded, pivots, reach)
        counts = counts.unionByName(more.select("node", F.col("more").alias("found"))).groupBy("node").agg(F.sum("found").alias("found"))
        edges = edges.unionByName(across)
    return written(counts, "counts"), edges


def audit(nodes: DataFrame, found: DataFrame, reach: float, size: int = AUDIT) -> float:
    """Share of the links between different vectors that the search found: those of ``size`` nodes, against all of their labels."""
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(size).select("node", "label", "vector").collect()
    if not chosen:
        return 1.0
    x = np.array([r["vector"] for r in chosen], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shared = nodes.sparkSession.sparkContext.broadcast((np.array([r["node"] for r in chosen]), [r["label"] for r in chosen], x))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, asked = shared.value
        labels = np.array(labels)
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                same = labels[:, None] == batch.column("label").to_numpy()[None, :]
                copies = batch.column("copies").to_numpy()
                total += ((asked @ _matrix(batch.column("vector")).T >= reach) & same) @ copies
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total, pa.int64())], ["node", "near"])

    true = nodes.mapInArrow(compared, "node long, near long").groupBy("node").agg(F.sum("near").alias("near"))
    copies = nodes.select("node", "copies")
    sums = (
        true.join(found, "node", "left")
        .join(copies, "node")
        .select((F.col("near") - F.col("copies")).alias("near"), (F.col("found") - F.col("copies") + 1).alias("found"))
        .agg(F.sum(F.least("near", F.coalesce("found", F.lit(0)))).alias("hit"), F.sum("near").alias("all"))
        .first()
    )
    return 1.0 if not sums["all"] else sums["hit"] / sums["all"]


# --- the operator ---------------------------------------------------------------------
def near_embeddings(
    vectors: DataFrame, reach: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``vectors``.

    Rows of one label with a cosine of at least ``reach`` are linked.  A null label, a
    null or empty vector, a zero one and one with null or non-finite components link
    with nothing.  All other vectors have to have one length.  Rows that repeat a vector count each; ids are
    expected once each.  An empty table gives an empty table.  Extra columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    plain = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    sound = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.forall("vector", plain) & F.exists("vector", lambda v: v != 0), F.lit(False))
    )
    nodes = written(
        rows.where(sound).groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")),
        "nodes",
    )
    for attempt in range(TRIES):
        found, edges = _search(nodes, reach, GUESTS * 2**attempt)
        recall = audit(nodes, found, reach)
        if recall >= RECALL:
            break
    if recall < 0.9:
        raise RuntimeError(f"the graph search found {recall:.3f} of the audited links")
    named = components(edges)
    counted = found.join(named, "node", "left")
    answered = nodes.join(counted, "node").select(
        F.col("label").alias("__label"), F.col("vector").alias("__vector"), "found", F.coalesce("component", "node").alias("component")
    )
    matched = (
        rows.where(sound)
        .join(answered, (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector")))
        .select("vec_id", F.col("found").alias("n_links"), F.col("component").alias("component_id"))
    )
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return matched.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
