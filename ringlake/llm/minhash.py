"""Near-duplicate documents by MinHash bands, odd sketches and an exact check.

1. A document is the set of its word shingles.  Equal sets are one node.
2. ``BANDS`` bands of ``ROWS`` MinHash values each put nodes in buckets.  A pair at the
   threshold 0.8 shares no bucket with probability (1 - 0.8 ** ROWS) ** BANDS, about
   5e-8.
3. All samples are folded into an odd sketch: a bitmap in which each sample flips one
   bit.  The population count of the XOR of two sketches estimates their similarity,
   most precisely where it is high.
4. Every node is compared by sketch to one other of its buckets, the one it shares most
   with; then buckets that still hold several groups are compared across these.  What
   comes near the threshold is one *family*.  Documents that are linked are in one
   family, and a node is in one family only.
5. The full sets of a family's nodes meet, block against block; a link between nodes that
   are not connected yet is confirmed on the sets.  Components of these links are the result.

Tasks hand out the edges of a spanning forest: at most one for each node of a block.  No
step has pairs as rows, and no pair whose sketches come near is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ringlake.llm.components import components
from ringlake.llm.repeats import _P, _P_INVERSE, RollingHash, _mixed
from ringlake.sources.scratch import written

BANDS, ROWS = 32, 4
SAMPLES = 256  # of which BANDS * ROWS are banded
SKETCH_BITS = 512
NEAR = 0.64  # sketch estimates from here on are checked: 4.5 standard deviations below 0.8
BLOCK = 2048  # nodes of a bucket or family that one task compares with each other
BLOCK_SHINGLES = 500_000  # and the shingles of their sets together, or one node's
NO_ID = -(1 << 63)


# --- sets -----------------------------------------------------------------------------
def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words, A-Z lower-cased; fewer words are one run."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(b" ".join(words), dtype=np.uint8)
    blanks = np.flatnonzero(raw == 32)
    starts = np.append(0, blanks + 1)
    ends = np.append(blanks, len(raw))
    take = max(len(words) - size + 1, 1)
    return np.unique(RollingHash(raw, _P, _P_INVERSE).of(starts[:take], ends[len(ends) - take :]))


_RANDOM = np.random.default_rng(20240131)
_FACTORS = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_SAMPLE_KEYS = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _P)
_BAND_KEYS = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _P_INVERSE)


def samples(found: np.ndarray) -> np.ndarray:
    """The least value of the set under each of ``SAMPLES`` hash functions."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 4096):
        np.minimum(least, (short[at : at + 4096, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    return least


def odd_sketch(least: np.ndarray) -> bytes:
    """Bit i is the parity of the number of samples that hash to it."""
    place = _mixed(least.astype(np.uint64) ^ _SAMPLE_KEYS) % np.uint64(SKETCH_BITS)
    bits = (np.bincount(place.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(bits).tobytes()


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key for each band, different between bands."""
    keys = _BAND_KEYS.copy()
    for row in least[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        keys = _mixed(keys ^ row.astype(np.uint64)) * _P
    return keys.view(np.int64)


def estimate(differing: np.ndarray) -> np.ndarray:
    """Similarity from the number of bits in which two sketches differ."""
    rest = np.maximum(1 - 2 * differing / SKETCH_BITS, 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(rest)


# --- tasks ----------------------------------------------------------------------------
SIGNED = "doc long, tie long, n_shingles long, a long, b long, sketch binary, bands array<long>"


def _signer(size: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, sketches, bands = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set(text, size)
                n.append(len(found))
                # The set's own hash does not depend on an order.
                a.append(int(_mixed(found).sum(dtype=np.uint64).view(np.int64)))
                b.append(int(_mixed(found ^ _P).sum(dtype=np.uint64).view(np.int64)))
                least = samples(found)
                sketches.append(odd_sketch(least) if len(found) else None)
                bands.append(band_keys(least) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), batch.column("tie"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                    pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc", "tie", "n_shingles", "a", "b", "sketch", "bands"],
            )

    return signed


def _set_bytes(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [shingle_set(text, size).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(held, pa.binary())], ["node", "shingles"])

    return sets


def _near_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sketches come near the threshold."""
    for batch in batches:
        if batch.num_rows:
            a, b = _sketches(batch.column("a_sketch")), _sketches(batch.column("b_sketch"))
            near = estimate(np.bitwise_count(a ^ b).sum(axis=1)) >= NEAR
            yield batch.select(["a", "b"]).filter(pa.array(near))


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(len(column), -1)


class Forest:
    """Groups of rows that edges have connected, and these edges."""

    def __init__(self, group: np.ndarray):
        _, self.group = np.unique(group, return_inverse=True)
        self.edges: list[tuple[int, int]] = []

    def connect(self, row: int, others: np.ndarray) -> None:
        """Connect a row with one of each other group of ``others``."""
        groups, first = np.unique(self.group[others], return_index=True)
        new = groups != self.group[row]
        self.edges += [(row, int(others[i])) for i in first[new]]
        self.group[np.isin(self.group, groups[new])] = self.group[row]

    def table(self, node: np.ndarray) -> pa.Table:
        rows = np.array(self.edges, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(node[rows[:, 0]], pa.int64()), "b": pa.array(node[rows[:, 1]], pa.int64())})


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the first and of the second block; both are the same where a block meets itself."""
    side = table.column("side").to_numpy()
    return np.flatnonzero(side != 1), np.flatnonzero(side != 0)


def _near_groups(table: pa.Table) -> pa.Table:
    """Edges between the groups of a bucket whose nodes come near each other."""
    node, group = table.column("node").to_numpy(), table.column("component").to_numpy()
    sketch, (rows, columns) = _sketches(table.column("sketch").combine_chunks()), _sides(table)
    forest = Forest(group)
    names, sizes = np.unique(group, return_counts=True)
    small = group != names[sizes.argmax()]  # a pair across groups has a row outside of the largest
    for asked, others in ((rows, columns), (columns, rows)):
        for r in asked[small[asked]]:
            apart = others[forest.group[others] != forest.group[r]]
            near = apart[estimate(np.bitwise_count(sketch[apart] ^ sketch[r]).sum(axis=1)) >= NEAR]
            if len(near):
                forest.connect(r, near)
    return forest.table(node)


def _linker(percent: int):
    def linked_nodes(table: pa.Table) -> pa.Table:
        """Edges that connect a family's nodes of two blocks as their links do."""
        node, sketch, (rows, columns) = table.column("node").to_numpy(), _sketches(table.column("sketch").combine_chunks()), _sides(table)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        mark = np.zeros(len(flat), dtype=bool)
        forest = Forest(np.arange(len(node)))

        def confirmed(r: int, others: np.ndarray) -> np.ndarray:
            mark[flat[starts[r] : starts[r] + sizes[r]]] = True
            n = sizes[others]
            ends = np.cumsum(n)
            hits = np.append(0, np.cumsum(mark[flat[np.arange(ends[-1]) + np.repeat(starts[others] - ends + n, n)]]))
            mark[flat[starts[r] : starts[r] + sizes[r]]] = False
            both = hits[ends] - hits[ends - n]
            return others[100 * both >= percent * (sizes[r] + n - both)]

        for r in rows:
            apart = columns[forest.group[columns] != forest.group[r]]
            likely = estimate(np.bitwise_count(sketch[apart] ^ sketch[r]).sum(axis=1))
            order = np.argsort(-likely, kind="stable")
            waiting, most = apart[order[likely[order] >= NEAR]], 1
            while len(waiting):  # the best of each group first: one link connects a group
                group = forest.group[waiting]
                by_group = np.argsort(group, kind="stable")
                turn = np.empty(len(group), dtype=np.int64)
                turn[by_group] = np.arange(len(group)) - np.searchsorted(group[by_group], group[by_group])
                found = confirmed(r, waiting[turn < most])
                if len(found):
                    forest.connect(r, found)
                rest = waiting[turn >= most]
                waiting, most = rest[forest.group[rest] != forest.group[r]], most * 8
        return forest.table(node)

    return linked_nodes


# --- the operator ---------------------------------------------------------------------
def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``.

    Documents are linked if ``percent`` % of the union of their shingle sets is shared;
    a component is named by its smallest id.  Null, empty and blank texts have no set
    and are linked with nothing.  A document is its id and text: rows that share both
    are kept or not together, rows that share an id only are linked by their texts or
    not at all.  Null ids come before all others, a hash of the text orders documents
    of one id.  An empty table gives an empty table.  Extra columns are not read.
    """
    return grouped(docs, doc_id, text, size, percent).drop("doc", "tie")


def document_key(doc_id: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """(doc, tie): what tells documents apart."""
    return {
        "doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)),
        "tie": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    }


def grouped(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
) -> DataFrame:
    """``near_duplicates`` with the key (doc, tie) of each document."""
    key = document_key(doc_id, text)
    rows = docs.select(*[c.alias(k) for k, c in key.items()], F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = written(rows.mapInArrow(_signer(size), SIGNED), "signatures")
    sets = signed.where("n_shingles > 0")
    # Numbers are unique, and fixed once written; a set is shown by its first document.
    nodes = written(
        sets.groupBy("a", "b")
        .agg(
            F.min(F.struct("doc", "tie")).alias("first"), F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("key"))
    full = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1")
    buckets = written(banded.join(full, "key").select("key", "node", "leader"), "buckets")
    families = written(_families(nodes, buckets), "families")

    shown_by = nodes.join(families.select("node"), "node").select("node", "first.*")
    texts = rows.join(shown_by, ["doc", "tie"]).groupBy("node").agg(F.min("text").alias("text"))
    held = texts.mapInArrow(_set_bytes(size), "node long, shingles binary")
    members = families.join(nodes.select("node", "sketch", "n_shingles"), "node")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    sized = members.groupBy("family").agg(blocks.alias("blocks"))
    met = _met(members.join(sized, "family").select("node", "sketch", F.col("family").alias("key"), "blocks"))
    edges = met.join(held, "node").groupBy("key", "i", "j").applyInArrow(_linker(percent), "a long, b long")
    found = written(components(edges), "components")
    placed = nodes.select("node", "a", "b", "first").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("first").alias("least"))
    named = written(placed.join(least, "component").select("a", "b", "least"), "components")
    own = F.struct("doc", "tie")
    least = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(own)
    shown = lambda c: F.when(c != NO_ID, c)
    return signed.select("doc", "tie", "n_shingles", "a", "b").join(named, ["a", "b"], "left").select(
        "doc",
        "tie",
        shown(F.col("doc")).alias("doc_id"),
        "n_shingles",
        shown(least["doc"]).alias("component_id"),
        (own == least).alias("kept"),
    )


def _families(nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """(node, family) of nodes that come near others: connected by pairs of a bucket whose sketches do."""
    sketches = nodes.select("node", "sketch")
    shares = buckets.where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = shares.groupBy("node").agg(F.min(F.struct(-F.col("n"), "leader")).alias("best"))
    stars = (
        best.select(F.col("node").alias("a"), F.col("best.leader").alias("b"))
        .join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("a_sketch")), "a")
        .join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("b_sketch")), "b")
    )
    near = written(stars.mapInArrow(_near_stars, "a long, b long"), "near")
    first = written(components(near), "near-groups")
    placed = buckets.select("key", "node").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    met = _met(placed.join(mixed, "key")).join(sketches, "node")
    more = written(met.groupBy("key", "i", "j").applyInArrow(_near_groups, "a long, b long"), "near")
    return components(near.unionByName(more)).select("node", F.col("component").alias("family"))


def _met(rows: DataFrame) -> DataFrame:
    """``rows`` (node, key, blocks and others) once for each pair (i, j) of blocks of their key that they are in."""
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.struct(
            F.least(F.col("at"), b).alias("i"), F.greatest(F.col("at"), b).alias("j"),
            F.when(F.col("at") == b, 2).when(F.col("at") < b, 0).otherwise(1).alias("side"),
        ),
    )
    at = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return rows.withColumn("at", at).select(*[c for c in rows.columns if c != "blocks"], F.inline(others))
