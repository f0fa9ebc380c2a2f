"""Merkle manifest of a dataset: a tree per group, a tree over the groups, proofs and an audit.

Leaves get their place by a range sort.  ``WIDTH ** levels`` consecutive nodes of a group
are a superblock: it is one small task, and its top is one node of the next table, until
every group has one node.  Going down again, a superblock's nodes are cogrouped with the
path of its top (the outer nodes that it needs): the task reduces its own part of the
tree, joins its siblings to that path, and at the leaves folds every leaf up to the root.
So no task holds more than one superblock, whatever the size of a group.

H is the lowercase hex sha256 of the concatenated inputs.  A path is a list of strings,
for each level the siblings to the left and those to the right, from the leaf up.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ringlake.sources.scratch import written

WIDTH, LEVELS = 8, 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

PATH = "grp string, at long, path array<string>, subroot string, root string"
CHECKED = (
    "doc_id string, leaf string, subroot string, root string, path array<string>, "
    "proof_sha256 string, folded_root string, verified boolean"
)


# --- leaves ---------------------------------------------------------------------------
def leaf_hash(fields: list[Column]) -> Column:
    """H of the fields: ``-`` for a null, else byte count, ``:`` and value."""
    shown = [f.cast("string") for f in fields]
    each = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in shown]
    return F.sha2(F.concat(*each), 256)


def lowered(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def every_third(doc_id: Column) -> Column:
    """The ids that an audit tampers with: their crc32 is a multiple of three."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


# --- places ---------------------------------------------------------------------------
def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place ``at`` in their ``grp`` and its size ``n``.

    The rows are range-sorted by group, order and a unique number into runs; a place
    is the number in the run's part of the group plus the sizes of its earlier parts.
    ``rows`` have to be read from a written table, so that the numbers hold.
    """
    runs = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["grp", *order, "__copy"]
    dealt = written(
        rows.withColumn("__copy", F.monotonically_increasing_id())
        .repartitionByRange(runs, *keys)
        .withColumn("__run", F.spark_partition_id()),
        "manifest-runs",
    )
    parts = dealt.groupBy("grp", "__run").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("grp").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("grp")
    offsets = parts.select(
        "grp", "__run", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("n")
    )
    inside = Window.partitionBy("__run", "grp").orderBy(*order, "__copy")
    return (
        dealt.withColumn("__at", F.row_number().over(inside) - 1)
        .join(offsets, ["grp", "__run"])
        .withColumn("at", F.col("__before") + F.col("__at"))
        .drop("__copy", "__run", "__before", "__at")
    )


# --- superblocks ----------------------------------------------------------------------
def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def local_levels(nodes: list[str], n: int, most: int) -> list[list[str]]:
    """The levels of a superblock from its nodes to its top; ``n`` nodes are in its whole group."""
    levels, rest = [nodes], n
    while rest > 1 and len(levels) <= most:
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + WIDTH])) for i in range(0, len(below), WIDTH)])
        rest = -(-rest // WIDTH)
    return levels


def local_path(levels: list[list[str]], place: int) -> list[str]:
    """Siblings left and right of a node and of all above it, below the superblock's top."""
    path = []
    for level in levels[:-1]:
        first = place - place % WIDTH
        path += ["".join(level[first:place]), "".join(level[place + 1 : first + WIDTH])]
        place //= WIDTH
    return path


def folded(leaf: str, path: list[str]) -> str:
    for i in range(0, len(path), 2):
        leaf = _hash(path[i] + leaf + path[i + 1])
    return leaf


def _topper(levels: int):
    size = WIDTH**levels

    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        n, at = int(block["n"].iloc[0]), int(block["at"].iloc[0])
        last = local_levels(block["hash"].tolist(), n, levels)[-1]
        return pd.DataFrame({"grp": block["grp"].iloc[:1].tolist(), "at": [at // size], "n": [-(-n // size)], "hash": last})

    return top


def _pather(levels: int):
    def below(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """Paths of a superblock's nodes: their own siblings, then the path of its top."""
        block = block.sort_values("at")
        above = list(outer["path"].iloc[0])
        local = local_levels(block["hash"].tolist(), int(block["n"].iloc[0]), levels)
        return pd.DataFrame(
            {
                "grp": block["grp"], "at": block["at"],
                "path": [local_path(local, i) + above for i in range(len(block))],
                "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0],
            }
        )

    return below


def _checker(levels: int, with_path: bool):
    def checked(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """Leaves with their proofs, and what they fold to."""
        block = block.sort_values("at")
        above, root = list(outer["path"].iloc[0]), outer["root"].iloc[0]
        local = local_levels(block["hash"].tolist(), int(block["n"].iloc[0]), levels)
        paths = [local_path(local, i) + above for i in range(len(block))]
        ends = [folded(leaf, path) for leaf, path in zip(block["checked"], paths, strict=True)]
        return pd.DataFrame(
            {
                "doc_id": block["doc_id"], "leaf": block["hash"], "subroot": outer["subroot"].iloc[0], "root": root,
                "path": paths if with_path else None, "proof_sha256": [_hash("".join(p)) for p in paths],
                "folded_root": ends, "verified": [end == root for end in ends],
            }
        )

    return checked


def _blocks(nodes: DataFrame, levels: int):
    return nodes.withColumn("block", F.expr(f"at div {WIDTH**levels}")).groupBy("grp", "block")


def climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` (grp, at, n, hash) and the tables above them; every group has one node in the last."""
    tables = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        blocks = _blocks(tables[-1].select("grp", "at", "n", "hash"), levels)
        tables.append(written(blocks.applyInPandas(_topper(levels), "grp string, at long, n long, hash string"), "manifest-nodes"))
        largest = -(-largest // WIDTH**levels)
    return tables


def _met(nodes: DataFrame, paths: DataFrame, levels: int):
    """A superblock's nodes and the path of its top, by superblock."""
    return _blocks(nodes, levels).cogroup(paths.withColumn("block", F.col("at")).groupBy("grp", "block"))


def descend(tables: list[DataFrame], paths: DataFrame, levels: int) -> DataFrame:
    """Paths (``PATH``) of the nodes of the second table, from those of the last one."""
    for nodes in tables[-2:0:-1]:
        met = _met(nodes.select("grp", "at", "n", "hash"), paths, levels)
        paths = written(met.applyInPandas(_pather(levels), PATH), "manifest-paths")
    return paths


# --- the operator ---------------------------------------------------------------------
def manifest(
    docs: DataFrame,
    fields: list[str] | None = None,
    doc_id: str = "doc_id",
    group: str = "lang",
    found: dict[str, Column] | None = None,
    found_where: Column | None = None,
    with_path: bool = False,
    levels: int = LEVELS,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, proof_sha256, folded_root, verified), a row for each document.

    The leaves of a group ascend by id (null ids first, rows of one id by leaf; rows
    that are alike in all fields take places next to each other).  Groups ascend
    bytewise, the null group first.  ``found`` replaces fields where ``found_where``
    holds, as if an auditor had found them so: those leaves are folded with the siblings
    of the manifest, and ``verified`` tells whether they give its root.  Nulls in any
    column are part of a leaf.  ``path`` is null unless asked for.  An empty table gives
    an empty one.  Columns beside ``fields`` are not read.
    """
    fields = fields or FIELDS
    given = [F.col(f) for f in fields]
    seen = [(found or {}).get(f, F.col(f)) for f in fields]
    leaf = leaf_hash(given)
    checked = leaf if found is None else F.when(F.lit(True) if found_where is None else found_where, leaf_hash(seen)).otherwise(leaf)
    # Null ids and groups come first: a mark before the value keeps that order, and bytes decide the rest.
    grp = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = docs.select(grp.alias("grp"), F.col(doc_id).alias("doc_id"), leaf.alias("hash"), checked.alias("checked"))
    leaves = written(placed(written(rows, "manifest-leaves"), ["doc_id", "hash"]).withColumn("doc_id", F.col("doc_id").cast("string")), "manifest-places")
    tables = climb(leaves, levels)

    one = F.lit("").alias("grp")
    subroots = tables[-1].select(F.col("grp").alias("name"), "hash")
    if len(tables) == 1:
        subroots = written(subroots, "manifest-nodes")
    names = written(placed(subroots.select(one, "name", "hash"), ["name"]), "manifest-nodes")
    above = climb(names, levels)
    root = above[-1].select("grp", "at", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    if len(above) > 1:
        met = _met(names.select("grp", "at", "n", "hash"), descend(above, root, levels), levels)
        paths = met.applyInPandas(_pather(levels), PATH)
    else:
        paths = root
    tops = written(
        names.join(paths.select("at", "path", "root"), "at").select(
            F.col("name").alias("grp"), F.lit(0).cast("long").alias("at"), "path", F.col("hash").alias("subroot"), "root"
        ),
        "manifest-paths",
    )
    out = _met(leaves, descend(tables, tops, levels), levels).applyInPandas(_checker(levels, with_path), CHECKED)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def audited(docs: DataFrame, **options) -> DataFrame:
    """The manifest of ``documents``, audited against texts in lower case for every third id."""
    return manifest(docs, found={"text": lowered(F.col("text"))}, found_where=every_third(F.col("doc_id")), **options)
