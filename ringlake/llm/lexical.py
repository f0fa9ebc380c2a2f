"""Exact ranked lexical search with norm buckets.

1. Every document becomes its impact vector over the terms that the items ask for; a
   score is the inner product with an item's vector of weights.
2. Vectors are range-sorted by length (Euclidean norm).  ``BUCKET`` of them in order are
   a bucket.  The run of the longest vectors is searched first: the lowest of an item's best
   scores there bounds what other runs have to look at.
3. Cauchy-Schwarz: an item skips every bucket whose longest vector times the item's own
   length is below its bound.
4. Inside a bucket only the item's ``FOCUS`` largest coordinates are multiplied; what the
   others may add is at most the product of the remaining lengths.  Vectors below the
   bound are out.
5. Survivors are scored in integers over all coordinates, and raise the bound.

A task keeps the best ``k`` of an item, so what is merged grows with items and tasks, not
with documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ringlake.sources.scratch import written

BUCKET = 512
FOCUS = 8
BLOCK_TERMS = 1 << 17  # terms of the items that are searched together
SLACK = 1e-9  # floating-point bounds are raised by this share before a vector is left out
TOP = 20
NO_ID = (1 << 63) - 1
FOUND = "item long, key long, score long"

# Bytes that are in terms: digits, letters, and everything beyond ASCII.  A-Z count as a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


# --- items ----------------------------------------------------------------------------
def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items, terms, times = [], [], []
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for term, n in Counter(terms_of(text)).items():
                items.append(item)
                terms.append(term)
                times.append(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.int64())], ["item", "term", "times"]
        )


# --- documents ------------------------------------------------------------------------
def _vectors(shared):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Length of each document, and its counts of the terms that are asked for."""
        number = shared.value
        asked = number.keys()
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                counts = Counter(words)
                held = sorted((number[term], counts[term]) for term in asked & counts.keys())
                sizes.append(len(words))
                terms.append([t for t, _ in held])
                times.append([n for _, n in held])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["key", "size", "terms", "times"],
            )

    return counted


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(times: np.ndarray, sizes: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The impact of each count in a document of that size; ``total`` terms are in all documents."""
    m = np.array([100 - 25 + 25 * n * documents // total for n in sizes.tolist()], dtype=np.int64)
    return 1_000_000_000 * times // (1000 * times + 12 * m)


def _measured(documents: int, total: int):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Impacts for counts, and the length of the vector."""
        for batch in batches:
            lists = batch.column("times")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            sizes = batch.column("size").to_numpy()
            own = impacts(lists.flatten().to_numpy(), sizes[owner], documents, total) if len(owner) else np.zeros(0, np.int64)
            norm = np.sqrt(np.bincount(owner, weights=own.astype(np.float64) ** 2, minlength=batch.num_rows))
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("copy"), batch.column("key"), batch.column("terms"), pa.ListArray.from_arrays(offsets, pa.array(own, pa.int64())), pa.array(norm)],
                ["copy", "key", "terms", "impacts", "norm"],
            )

    return measured


# --- search ---------------------------------------------------------------------------
class Items:
    """Vectors of a block of items: terms by weight, heaviest first."""

    def __init__(self, rows: list[tuple[int, int, int]], terms: int):
        """``rows`` are (item, term, weight times repeats)."""
        self.terms, self.vectors = terms, []
        by_item: dict[int, list[tuple[int, int]]] = {}
        for item, term, w in rows:
            if w > 0:
                by_item.setdefault(item, []).append((-w, term))
        for item, held in sorted(by_item.items()):
            held.sort()
            self.vectors.append((item, np.array([t for _, t in held]), np.array([-w for w, _ in held], dtype=np.int64)))


class Best:
    """The best ``k`` scores of an item so far; equal scores by document."""

    def __init__(self, k: int, bound: int):
        self.k, self.bound = k, bound
        self.score, self.key = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, key: np.ndarray) -> None:
        score, key = np.append(self.score, score), np.append(self.key, key)
        order = np.lexsort([key, -score])[: self.k]
        self.score, self.key = score[order], key[order]
        if len(order) == self.k:
            self.bound = max(self.bound, int(self.score[-1]))


class Bucket:
    """Vectors next to each other in the order of lengths, by row and by term."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], norms: np.ndarray, terms: int):
        self.norms = norms
        self.ends = np.cumsum([len(t) for t, _ in lists])
        self.starts = self.ends - [len(t) for t, _ in lists]
        self.term, self.impact = np.concatenate([t for t, _ in lists]), np.concatenate([i for _, i in lists])
        row = np.repeat(np.arange(len(lists)), self.ends - self.starts)
        order = np.argsort(self.term, kind="stable")
        self.by_term_row, self.by_term_impact = row[order], self.impact[order]
        self.edges = np.searchsorted(self.term[order], np.arange(terms + 1))

    def survivors(self, term: np.ndarray, w: np.ndarray, bound: int) -> np.ndarray:
        """Rows whose score may reach the bound, by lengths and the largest coordinates of the item."""
        rest = math.sqrt(float((w[FOCUS:].astype(np.float64) ** 2).sum()))
        near, square = np.zeros(len(self.norms)), np.zeros(len(self.norms))
        for t, x in zip(term[:FOCUS].tolist(), w[:FOCUS].tolist(), strict=True):
            at = slice(self.edges[t], self.edges[t + 1])
            rows, own = self.by_term_row[at], self.by_term_impact[at].astype(np.float64)
            near[rows] += x * own
            square[rows] += own**2
        most = near + rest * np.sqrt(np.maximum(self.norms**2 - square, 0)) * (1 + SLACK)
        # What is nearly all in the focus leaves a rounding error of the squares behind.
        most += rest * self.norms * 1e-7
        return np.flatnonzero(most * (1 + SLACK) >= max(bound, 1))

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        sizes = (self.ends - self.starts)[rows]
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[rows] - np.cumsum(sizes) + sizes, sizes)
        products = dense[self.term[at]] * self.impact[at]
        sums = np.append(0, np.cumsum(products))
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]


def searched(buckets: Iterator[tuple[Bucket, np.ndarray]], items: Items, k: int, bounds: dict[int, int]) -> Iterator[tuple[int, Best]]:
    """Each item's best documents of buckets, which come with their keys and best in falling order of lengths."""
    best = [Best(k, bounds.get(item, 0)) for item, _, _ in items.vectors]
    lengths = [math.sqrt(float((w.astype(np.float64) ** 2).sum())) for _, _, w in items.vectors]
    dense = np.zeros(items.terms, dtype=np.int64)
    for bucket, key in buckets:
        longest = float(bucket.norms.max()) * (1 + SLACK)
        for (_, term, w), mine, length in zip(items.vectors, best, lengths, strict=True):
            if longest * length * (1 + SLACK) < mine.bound:
                continue
            rows = bucket.survivors(term, w, mine.bound)
            if not len(rows):
                continue
            dense[term] = w
            score = bucket.scores(rows, dense)
            dense[term] = 0
            good = score >= max(mine.bound, 1)
            if good.any():
                mine.add(score[good], key[rows[good]])
    for (item, _, _), mine in zip(items.vectors, best, strict=True):
        yield item, mine


def _searcher(shared, k: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, bounds = shared.value

        def buckets() -> Iterator[tuple[Bucket, np.ndarray]]:
            for batch in batches:
                for at in range(0, batch.num_rows, BUCKET):
                    part = batch.slice(at, BUCKET)
                    lists = [(t.values.to_numpy(), i.values.to_numpy()) for t, i in zip(part.column("terms"), part.column("impacts"), strict=True)]
                    yield Bucket(lists, part.column("norm").to_numpy(), items.terms), part.column("key").to_numpy()

        for item, best in searched(buckets(), items, k, bounds):
            n = len(best.score)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * n, pa.int64()), pa.array(best.key, pa.int64()), pa.array(best.score, pa.int64())], ["item", "key", "score"]
            )

    return found


# --- the operator ---------------------------------------------------------------------
def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0.

    Every row of ``docs`` is a document and every row of ``items`` an item, also where ids
    repeat or are null; equal scores are ranked by id, null ids last.  Null and empty texts
    have no terms: such documents are not counted, such items find nothing.  An empty
    table on either side gives an empty one.  Extra columns are not read.  Items are a
    query set: they are dealt into blocks of about ``block_terms`` terms, and a block's
    vectors are broadcast.
    """
    spark = docs.sparkSession
    asked = written(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).withColumn("item", F.monotonically_increasing_id()), "items")
    held = written(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary, times long"), "item-terms")
    blocks = -(-held.count() // block_terms)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("key"), F.col(text).alias("text"))
    out = spark.createDataFrame([], FOUND)
    for block in range(blocks):
        mine = held.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        if mine:
            out = out.unionByName(_block(rows, [(r["item"], bytes(r["term"]), r["times"]) for r in mine], k))
    first = Window.partitionBy("item").orderBy(F.desc("score"), "key")
    return (
        out.withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= k)
        .join(asked.select("item", "item_id"), "item")
        .select("item_id", "rank", F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "score")
    )


def _block(docs: DataFrame, asked: list[tuple[int, bytes, int]], k: int) -> DataFrame:
    """(item, key, score) of the items whose (item, term, repeats) these are: the best, and some more."""
    spark = docs.sparkSession
    number = {term: i for i, term in enumerate(sorted({term for _, term, _ in asked}))}
    vectors = written(
        docs.mapInArrow(_vectors(spark.sparkContext.broadcast(number)), "key long, size long, terms array<int>, times array<long>")
        .withColumn("copy", F.monotonically_increasing_id()),
        "vectors",
    )
    seen = vectors.agg(F.count_if(F.col("size") > 0).alias("n"), F.sum("size").alias("all")).first()
    if not seen["all"]:
        return spark.createDataFrame([], FOUND)
    # One row for each term of the block.
    holding = {r["term"]: r["n"] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = {i: weight(seen["n"], holding.get(i, 0)) for i in number.values()}
    items = Items([(item, number[term], weights[number[term]] * times) for item, term, times in asked], len(number))

    measured = vectors.mapInArrow(_measured(seen["n"], seen["all"]), "copy long, key long, terms array<int>, impacts array<long>, norm double")
    runs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("norm"), "key", "copy"]  # the copy number parts documents that are alike in both
    dealt = measured.where("norm > 0").repartitionByRange(runs, *order).sortWithinPartitions(*order)
    buckets = written(dealt.withColumn("run", F.spark_partition_id()), "norm-buckets")

    def search(part: DataFrame, bounds: dict[int, int]) -> DataFrame:
        shared = spark.sparkContext.broadcast((items, bounds))
        return written(part.select("key", "terms", "impacts", "norm").mapInArrow(_searcher(shared, k), FOUND), "found")

    longest = search(buckets.where("run = 0"), {})
    place = Window.partitionBy("item").orderBy(F.desc("score"), "key")
    last = longest.withColumn("place", F.row_number().over(place)).where(F.col("place") == k)
    bounds = {r["item"]: r["score"] for r in last.collect()}  # one number for each item of the block
    return longest.unionByName(search(buckets.where("run > 0"), bounds))
