"""Removing repeated byte strings across a corpus, by prefix-free parsing.

A byte of a document goes if a string of ``SPAN`` bytes that covers it also starts
earlier in the corpus, which is ordered by document and place.

Prefix-free parsing cuts a text where a rolling hash says so.  Here the trigger of a
string of ``SPAN`` bytes is its place with the least hash of the ``GRAM`` bytes from
there, so every string has one, and has the same one wherever it occurs.  As a string
moves through a text its trigger moves on in jumps; the text's phrases are cut there:

* The *dictionary* holds the distinct phrases: the bytes of all consecutive strings
  that share a trigger, which overlaps the next phrase by ``SPAN - 1`` bytes.
* The *parse* is the documents as sequences of phrases.  Where a phrase has occurred
  before, all strings that begin in it have; that is decided on hashes alone.
* What is left are strings that begin in different phrases with one trigger.
  The strings that begin in these phrases are sorted, trigger by trigger: the
  dictionary's suffixes, truncated to ``SPAN`` bytes.  Equal neighbours are one
  string, and the place of its phrases in the parse says which comes first in the
  corpus.  Only equality matters, so suffixes are ordered by their 64-bit hashes.

Only triggers that occur at least twice get that far.  Documents travel in blocks of
about ``BLOCK_BYTES`` that a task holds whole; a frequent trigger is at most one row a
block, and one with many phrases has its strings compared as rows of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ringlake.sources.scratch import written

SPAN = 100
GRAM = 24
BLOCK_BYTES = 4 << 20
TASK_BYTES = 1 << 20  # bytes that are hashed at a time, or one document
BUCKET_PHRASES = 2000

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_Q_INVERSE = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    held = _powers.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        held[0] = 1
        held = _powers[int(base)] = np.cumprod(held)
    return held[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class RollingHash:
    """Hashes of any substrings of a byte string, from running sums."""

    def __init__(self, raw: np.ndarray, base: np.uint64, inverse: np.uint64):
        n = len(raw)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power(base, n), out=self.sums[1:])
        self.inverse = _power(inverse, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:-size]) * self.inverse[:n])


def _running(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over every ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[:-rest], values[rest:]) if rest else values


class Parsed:
    """Triggers and phrases of documents that are joined to one byte string.

    ``doc`` is the document of each phrase, ``low`` the first string start that has
    its trigger, ``high`` the last; places count from the document's start.
    """

    def __init__(self, texts: list[bytes], span: int = SPAN, gram: int = GRAM):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        width = span - gram + 1
        if len(raw) < span:
            self._none()
            return
        hashed = RollingHash(raw, _P, _P_INVERSE)
        grams = hashed.grams(gram)
        # The leftmost least hash of each string, its trigger: hash and place in one number.
        order = (grams & ~np.uint64(0xFFFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        least = _running(order, width, np.minimum)
        inside = np.zeros(len(least) + 1, dtype=np.int32)
        has = sizes >= span
        np.add.at(inside, (ends - sizes)[has], 1)
        np.add.at(inside, ends[has] - span + 1, -1)
        first = np.flatnonzero(np.cumsum(inside)[:-1] > 0)  # strings inside one document
        if not len(first):
            self._none()
            return
        places = (least[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        opens = np.flatnonzero(np.append(True, np.diff(places) != 0))
        low, high = first[opens], first[np.append(opens[1:] - 1, len(first) - 1)]
        places = places[opens]
        doc = np.searchsorted(ends, places, side="right")
        start = (ends - sizes)[doc]
        stop = high + span
        self.trigger = grams[places].view(np.int64)
        shape = ((places - low).astype(np.uint64) << np.uint64(32)) | (high - low).astype(np.uint64)
        self.phrase = _mixed(RollingHash(raw, _Q, _Q_INVERSE).of(low, stop) ^ _mixed(shape)).view(np.int64)
        self.doc, self.low, self.high = doc, low - start, high - start
        self.place = places - start

    def _none(self) -> None:
        nothing = np.zeros(0, dtype=np.int64)
        self.trigger = self.phrase = self.doc = self.low = self.high = self.place = nothing


def _groups(texts: list[bytes], limit: int = TASK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def merged_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs; touching ones are one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    return starts[opens], ends[np.append(opens[1:] - 1, len(ends) - 1)]


# --- tasks ----------------------------------------------------------------------------
TRIGGERS = "block long, trigger long, several boolean"
PARSED = (
    "kind int, doc long, tie long, trigger long, phrase long, low int, high int, "
    "n_bytes long, sha256 string, text binary, times long"
)
DOCUMENT, PHRASE, RUN = 0, 1, 2


def _block_triggers(table: pa.Table) -> pa.Table:
    """Distinct triggers of a block, and whether one occurs there at least twice."""
    found = [Parsed(texts).trigger for _, texts in _groups(table.column("text").to_pylist())]
    triggers, counts = np.unique(np.concatenate(found), return_counts=True)
    block = np.full(len(triggers), table.column("block")[0].as_py())
    return pa.table(
        {
            "block": pa.array(block, pa.int64()),
            "trigger": pa.array(triggers, pa.int64()),
            "several": pa.array(counts > 1, pa.bool_()),
        }
    )


def _repeated_triggers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, trigger) of triggers that occur at least twice.  The partition has all rows of its triggers."""
    held = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("block", "trigger", "several")] for b in batches]
    if not held:
        return
    block, trigger, several = (np.concatenate(x) for x in zip(*held, strict=True))
    _, group = np.unique(trigger, return_inverse=True)
    keep = ((np.bincount(group) > 1) | (np.bincount(group, weights=several) > 0))[group]
    rows = pa.table({"block": pa.array(block[keep], pa.int64()), "trigger": pa.array(trigger[keep], pa.int64())})
    yield from rows.to_batches(max_chunksize=100_000)


def _runs(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String starts ``low`` to ``high``, in order, as merged byte runs (doc, start, end)."""
    if not len(doc):
        return doc, low, high
    opens = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (low[1:] > high[:-1] + SPAN)))
    return doc[opens], low[opens], high[np.append(opens[1:] - 1, len(doc) - 1)] + SPAN


def _parse_block(table: pa.Table, repeated: pa.Table) -> pa.Table:
    """The block's documents, its distinct phrases at their first place, and runs that repeat one of these.

    A document without a repeated trigger is finished here, its text stays behind.
    """
    rows = {}
    for doc, tie, text in zip(*(table.column(c).to_pylist() for c in ("doc", "tie", "text")), strict=True):
        rows.setdefault((doc, tie), [text, 0])[1] += 1
    keys = sorted(rows)
    texts = [rows[k][0] for k in keys]
    doc, tie = (np.array([k[i] for k in keys], dtype=np.int64) for i in (0, 1))
    known = np.unique(repeated.column("trigger").to_numpy())
    parts: dict[str, list] = {c: [] for c in ("doc", "trigger", "phrase", "low", "high")}
    for start, some in _groups(texts):
        parsed = Parsed(some)
        keep = np.isin(parsed.trigger, known)
        for c, held in parts.items():
            held.append(getattr(parsed, c)[keep] + (start if c == "doc" else 0))
    p = {c: np.concatenate(held) for c, held in parts.items()}
    order = np.lexsort([p["phrase"], p["trigger"]])
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(p["phrase"][order]) != 0) | (np.diff(p["trigger"][order]) != 0)
    is_first = np.zeros(len(order), dtype=bool)
    is_first[order[new]] = True  # the sort is stable, so this is the first in corpus order
    first, later = np.flatnonzero(is_first), np.flatnonzero(~is_first)
    run_doc, run_start, run_end = _runs(p["doc"][later], p["low"][later], p["high"][later])
    open_ = np.zeros(len(texts), dtype=bool)
    open_[p["doc"]] = True
    who = p["doc"][first]
    counts = (len(texts), len(first), len(run_doc))

    def column(kind: pa.DataType, documents, phrases=None, runs=None) -> pa.Array:
        given = [pa.nulls(n, kind) if x is None else pa.array(x, kind) for n, x in zip(counts, (documents, phrases, runs), strict=True)]
        return pa.chunked_array(given, kind).combine_chunks()

    return pa.table(
        {
            "kind": column(pa.int32(), *[np.full(n, k) for n, k in zip(counts, (DOCUMENT, PHRASE, RUN), strict=True)]),
            "doc": column(pa.int64(), doc, doc[who], doc[run_doc]),
            "tie": column(pa.int64(), tie, tie[who], tie[run_doc]),
            "trigger": column(pa.int64(), None, p["trigger"][first]),
            "phrase": column(pa.int64(), None, p["phrase"][first]),
            "low": column(pa.int32(), None, p["low"][first], run_start),
            "high": column(pa.int32(), None, p["high"][first], run_end),
            "n_bytes": column(pa.int64(), [len(t) for t in texts]),
            "sha256": column(pa.string(), [None if o else hashlib.sha256(t).hexdigest() for o, t in zip(open_, texts, strict=True)]),
            "text": column(pa.binary(), [t if o else None for o, t in zip(open_, texts, strict=True)]),
            "times": column(pa.int64(), [rows[k][1] for k in keys]),
        }
    )


def _phrase_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each document's phrases: (trigger, doc, tie, low, high, bytes)."""
    for batch in batches:
        text = batch.column("text").to_pylist()
        listed = batch.column("phrases")
        owner = np.repeat(np.arange(batch.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
        flat = listed.flatten()
        low, high = flat.field("low").to_numpy(), flat.field("high").to_numpy()
        out = pa.table(
            {
                "trigger": flat.field("trigger"),
                "doc": batch.column("doc").take(pa.array(owner)),
                "tie": batch.column("tie").take(pa.array(owner)),
                "low": flat.field("low"),
                "high": flat.field("high"),
                "bytes": pa.array([text[o][a : b + SPAN] for o, a, b in zip(owner, low, high, strict=True)], pa.binary()),
            }
        )
        yield from out.to_batches(max_chunksize=20_000)


def _strings(sizes: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All SPAN-byte strings of joined phrases: the phrase of each, its place there, and its hash."""
    n = sizes - SPAN + 1
    owner = np.repeat(np.arange(len(sizes)), n)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + inside
    hashed = RollingHash(np.frombuffer(raw, dtype=np.uint8), _Q, _Q_INVERSE)
    return owner, inside, hashed.of(at, at + SPAN)


def _later_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of strings that occur earlier under the same trigger.  The partition has all phrases of its triggers."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None:
        return
    trigger, doc, tie, low = (table.column(c).to_numpy() for c in ("trigger", "doc", "tie", "low"))
    order = np.lexsort([low, tie, doc, trigger])
    phrases = table.column("bytes").combine_chunks()
    bounds = np.flatnonzero(np.append(True, np.diff(trigger[order]) != 0))
    # As many triggers at a time as have some 100,000 strings.
    lengths = table.column("high").to_numpy().astype(np.int64) - low + SPAN
    weight = np.cumsum((lengths - SPAN + 1)[order])
    chunk = weight[bounds] // 100_000
    cuts = np.append(bounds[np.flatnonzero(np.append(True, np.diff(chunk) != 0))], len(order))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        some = order[a:b]
        raw = b"".join(phrases.take(pa.array(some)).to_pylist())
        owner, inside, hashes = _strings(lengths[some], raw)
        hashes = _mixed(hashes ^ trigger[some].view(np.uint64)[owner])
        by_hash = np.argsort(hashes, kind="stable")  # corpus order among equal ones
        same = np.append(False, hashes[by_hash][1:] == hashes[by_hash][:-1])
        later = np.zeros(len(hashes), dtype=bool)
        later[by_hash[same]] = True
        owner, start = owner[later], low[some][owner[later]] + inside[later]
        who, first, end = _runs(owner, start, start)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc[some][who], pa.int64()), pa.array(tie[some][who], pa.int64()),
                pa.array(first, pa.int32()), pa.array(end, pa.int32()),
            ],
            ["doc", "tie", "start", "end"],
        )


def _single_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(trigger, string, doc, tie, start): every string of the phrases as a row."""
    for batch in _phrase_bytes(batches):
        low, high = batch.column("low").to_numpy(), batch.column("high").to_numpy()
        owner, inside, hashes = _strings(high.astype(np.int64) - low + SPAN, b"".join(batch.column("bytes").to_pylist()))
        rows = pa.array(owner)
        out = pa.table(
            {
                "trigger": batch.column("trigger").take(rows),
                "string": pa.array(hashes.view(np.int64), pa.int64()),
                "doc": batch.column("doc").take(rows),
                "tie": batch.column("tie").take(rows),
                "start": pa.array(low[owner] + inside, pa.int32()),
            }
        )
        yield from out.to_batches(max_chunksize=100_000)


def _cutter(characters: bool):
    """Documents without the bytes of their runs; with ``characters``, ``kept`` is without those left in part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = batch.column("text").to_pylist(), batch.column("runs").to_pylist()
            removed, spans, digests, kept = [], [], [], []
            for text, some in zip(texts, runs, strict=True):
                pairs = np.array([(r["start"], r["end"]) for r in some or []], dtype=np.int64).reshape(-1, 2)
                starts, ends = merged_runs(pairs[:, 0], pairs[:, 1])
                edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(text)]
                pieces = [text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                rest = b"".join(pieces)
                removed.append(int((ends - starts).sum()))
                spans.append(len(starts))
                digests.append(hashlib.sha256(rest).hexdigest())
                # Piece by piece: parts of two characters must not join to a third.
                kept.append(b"".join([p.decode(errors="ignore").encode() for p in pieces]) if characters else rest)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc", "tie", "times", "n_bytes")],
                    pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc", "tie", "times", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return cut


# --- the operator ---------------------------------------------------------------------
NO_ID = -(1 << 63)


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tie, text): the place of a document in the corpus order, and its bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(body).alias("tie"),
        F.encode(body, "UTF-8").alias("text"),
    )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
    bucket_phrases: int = BUCKET_PHRASES, characters: bool = False,
) -> DataFrame:
    """(doc_id, tie, times, n_bytes, n_removed, n_spans, kept_sha256, kept), a row for each distinct id and text.

    ``kept`` is the remaining text in bytes, null where nothing was removed; ``characters``
    leaves out those that are left in part, all other columns stay as they are.  ``times``
    says how many rows of ``docs`` have this id and text: such rows are one document.
    Rows that share an id only are ordered by a hash of the text, ``tie``.  Null texts
    are empty, a null id comes before all others.  Texts below ``SPAN`` bytes stay
    whole.  An empty table gives an empty table.  Extra columns are not read.
    """
    spark = docs.sparkSession
    rows = keyed(docs, doc_id, text)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(-(-size // block_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc", "tie"), F.lit(blocks)))
    triggers = rows.groupBy("block").applyInArrow(_block_triggers, TRIGGERS)
    repeated = triggers.repartition("trigger").mapInArrow(_repeated_triggers, "block long, trigger long")
    # The texts are shuffled once: both sides of this plan read the same exchange.
    parsed = written(
        rows.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_parse_block, PARSED), "parsed", "zstd"
    )

    key = ["doc", "tie"]
    texts = parsed.where(F.col("kind") == DOCUMENT).select(*key, "times", "n_bytes", "sha256", "text")
    order = Window.partitionBy("trigger", "phrase").orderBy("doc", "tie", "low")  # at most one row a block
    # Dealt by trigger once: the numbers, the counts and their join all keep to that.
    phrases = (
        parsed.where(F.col("kind") == PHRASE)
        .select("trigger", "phrase", *key, "low", "high")
        .repartition("trigger")
        .withColumn("turn", F.row_number().over(order))
    )
    several = phrases.where("turn = 1").groupBy("trigger").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    first, chosen = F.col("turn") == 1, F.struct("trigger", "low", "high")
    shared = (
        phrases.join(several, "trigger", "left")
        .where("turn > 1 OR n IS NOT NULL")
        .groupBy(*key)
        .agg(
            F.collect_list(F.when(first & (F.col("n") <= bucket_phrases), chosen)).alias("few"),
            F.collect_list(F.when(first & (F.col("n") > bucket_phrases), chosen)).alias("many"),
            F.collect_list(F.when(~first, F.struct(F.col("low").alias("start"), (F.col("high") + SPAN).alias("end")))).alias("later"),
        )
    )
    # Written with the phrases that have occurred before, so that phrases are dealt no second time.
    shared = written(shared, "shared", "zstd")
    # One exchange of the texts serves all that follows, so it has the same columns and filters in each use.
    bodies = texts.where("text IS NOT NULL AND doc IS NOT NULL AND tie IS NOT NULL").drop("sha256")
    some = lambda name: bodies.join(
        shared.where(F.size(name) > 0).select(*key, F.col(name).alias("phrases")), key
    )
    near = (
        some("few")
        .mapInArrow(_phrase_bytes, "trigger long, doc long, tie long, low int, high int, bytes binary")
        .repartition("trigger")
        .mapInArrow(_later_strings, "doc long, tie long, start int, end int")
    )
    strings = some("many").mapInArrow(_single_strings, "trigger long, string long, doc long, tie long, start int")
    place = F.struct("doc", "tie", "start")
    earliest = (
        strings.groupBy("trigger", "string")
        .agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    far = strings.join(earliest, ["trigger", "string"]).where(place != F.col("earliest"))
    runs = (
        parsed.where(F.col("kind") == RUN).select(*key, F.col("low").alias("start"), F.col("high").alias("end"))
        .unionByName(shared.select(*key, F.inline("later")))
        .unionByName(near)
        .unionByName(far.select(*key, "start", (F.col("start") + SPAN).alias("end")))
        .groupBy(*key)
        .agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    )
    cut = bodies.join(runs, key, "left").mapInArrow(
        _cutter(characters),
        "doc long, tie long, times long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
    whole = texts.where("text IS NULL").select(
        *key, "times", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.col("sha256").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"),
    )
    return whole.unionByName(cut).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        "tie", "times", "n_bytes", "n_removed", "n_spans", "kept_sha256",
        F.when(F.col("n_removed") > 0, F.col("kept")).alias("kept"),
    )


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with repeated bytes gone from ``text``.

    A character that is left in part goes as well.  All rows stay; one with nothing left is empty.
    Other columns are carried inside a struct, so their names and types do not matter.
    """
    cut = remove_repeats(docs, doc_id, text, characters=True).where("n_removed > 0").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "tie", "kept"
    )
    whole = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
    )
    given = F.col("row").getField
    left = F.when(F.col("kept").isNotNull(), F.col("kept").cast("string")).otherwise(given(text))
    return whole.join(cut, ["doc", "tie"], "left").select(*[(left if c == text else given(c)).alias(c) for c in docs.columns])
