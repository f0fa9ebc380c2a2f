"""Token ids in files, entropy-coded by a range asymmetric numeral system.

Documents are range-sorted by id.  A task encodes its range in segments of about
``SEGMENT_IDS`` ids that end with a document.  A segment is one row of the files: a
static frequency table, shared by its blocks, the documents' lengths, and independent
blocks.  A block interleaves ``LANES`` coders, so that encoding and decoding take one
vector step for ``LANES`` ids; checkpoints inside it hold all coder states, from which
decoding can start as well.  Checksums cover the ids of each block.

Files are written and read by Spark only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ringlake.llm.encoding import encoder
from ringlake.llm.pretokens import character_classes, install_classes

SCALE = 20  # frequencies add up to 2 ** SCALE, which also bounds the vocabulary
LANES = 1024
BLOCK_STEPS = 256
CHECK_STEPS = 128
SEGMENT_IDS = 1 << 21
LOW = np.uint64(1 << 31)  # states stay in [2 ** 31, 2 ** 63)
WORD = np.uint64(32)
MASK = np.uint64((1 << SCALE) - 1)

SCHEMA = (
    "shard int, segment int, n_ids long, symbols binary, frequencies binary, "
    "docs array<struct<doc_id:long,n_ids:long>>, "
    "blocks array<struct<n_ids:int,crc32:long,words:binary,states:binary,"
    "checkpoints:array<struct<step:int,word:int,states:binary>>>>"
)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2 ** SCALE; what occurs keeps at least 1."""
    total = 1 << SCALE
    scaled = np.maximum(counts * total // counts.sum(), 1)
    over = int(scaled.sum()) - total
    order = np.argsort(-scaled, kind="stable")
    if over <= 0:
        scaled[order[0]] -= over
    for i in order:  # take what is too much from the most frequent, half of each at most
        if over <= 0:
            break
        cut = min(over, int(scaled[i]) // 2)
        scaled[i] -= cut
        over -= cut
    return scaled


@dataclass
class Model:
    """A static table over the symbols that occur, in ascending order."""

    symbols: np.ndarray
    frequency: np.ndarray

    def __post_init__(self):
        self.start = (np.cumsum(self.frequency) - self.frequency).astype(np.uint64)
        self.frequency = self.frequency.astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> Model:
        symbols, counts = np.unique(ids, return_counts=True)
        return cls(symbols, frequencies(counts.astype(np.int64)))

    def slots(self) -> np.ndarray:
        """Symbol number of every slot below 2 ** SCALE."""
        return np.repeat(np.arange(len(self.symbols), dtype=np.int32), self.frequency.astype(np.int64))


def encode_block(places: np.ndarray, model: Model) -> dict:
    """``places`` are symbol numbers in the model.  Steps go backwards, so that decoding goes forward."""
    n = len(places)
    steps = -(-n // LANES)
    states = np.full(LANES, LOW, dtype=np.uint64)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * steps
    saved = {}
    for step in range(steps - 1, -1, -1):
        now = places[step * LANES : (step + 1) * LANES]
        frequency, start = model.frequency[now], model.start[now]
        x = states[: len(now)]
        full = x >= frequency << np.uint64(63 - SCALE)
        out[step] = x[full].astype(np.uint32)
        x = np.where(full, x >> WORD, x)
        quotient = x // frequency
        states[: len(now)] = (quotient << np.uint64(SCALE)) + (x - quotient * frequency) + start
        if step % CHECK_STEPS == 0 and step:
            saved[step] = states.tobytes()
    ends = np.cumsum([0, *map(len, out)])
    return {
        "n_ids": n,
        "crc32": zlib.crc32(model.symbols[places].astype("<u4").tobytes()),
        "words": np.concatenate(out).astype("<u4").tobytes() if out else b"",
        "states": states.astype("<u8").tobytes(),
        "checkpoints": [
            {"step": step, "word": int(ends[step]), "states": saved[step]} for step in sorted(saved)
        ],
    }


def decode_steps(n: int, first: int, last: int, word: int, states: bytes, words: np.ndarray, model: Model, slots: np.ndarray) -> np.ndarray:
    """Symbol numbers of steps [first, last) of a block of ``n`` ids, from the states at ``first``."""
    x_all = np.frombuffer(states, dtype="<u8").copy()
    out = np.empty(min(last * LANES, n) - first * LANES, dtype=np.int32)
    for step in range(first, last):
        size = min(LANES, n - step * LANES)
        x = x_all[:size]
        low = x & MASK
        symbol = slots[low.astype(np.int64)]
        x = model.frequency[symbol] * (x >> np.uint64(SCALE)) + low - model.start[symbol]
        short = np.flatnonzero(x < LOW)
        x[short] = x[short] << WORD | words[word : word + len(short)].astype(np.uint64)
        word += len(short)
        x_all[:size] = x
        out[(step - first) * LANES : (step - first) * LANES + size] = symbol
    return out


def decode_block(block: dict, model: Model, slots: np.ndarray) -> np.ndarray:
    """Ids of a block.  Its parts between checkpoints do not depend on each other."""
    n, words = block["n_ids"], np.frombuffer(block["words"], dtype="<u4")
    steps = -(-n // LANES)
    starts = [{"step": 0, "word": 0, "states": block["states"]}, *block["checkpoints"]]
    lasts = [*[s["step"] for s in starts[1:]], steps]
    parts = [
        decode_steps(n, s["step"], last, s["word"], s["states"], words, model, slots)
        for s, last in zip(starts, lasts, strict=True)
    ]
    ids = model.symbols[np.concatenate(parts)]
    if zlib.crc32(ids.astype("<u4").tobytes()) != block["crc32"]:
        raise ValueError("a block of token ids does not match its checksum")
    return ids


def encode_segment(ids: np.ndarray, doc_ids: list, sizes: list[int]) -> dict:
    model = Model.of(ids)
    places = np.searchsorted(model.symbols, ids)
    size = LANES * BLOCK_STEPS
    return {
        "n_ids": len(ids),
        "symbols": zlib.compress(np.diff(model.symbols, prepend=0).astype("<u4").tobytes(), 1),
        "frequencies": zlib.compress(model.frequency.astype("<u4").tobytes(), 1),
        "docs": [{"doc_id": d, "n_ids": n} for d, n in zip(doc_ids, sizes, strict=True)],
        "blocks": [encode_block(places[at : at + size], model) for at in range(0, len(ids), size)],
    }


def decode_segment(row: dict) -> np.ndarray:
    symbols = np.cumsum(np.frombuffer(zlib.decompress(row["symbols"]), dtype="<u4")).astype(np.int64)
    model = Model(symbols, np.frombuffer(zlib.decompress(row["frequencies"]), dtype="<u4").astype(np.int64))
    slots = model.slots()
    return np.concatenate([decode_block(block, model, slots) for block in row["blocks"]])


def write_ids(docs: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Encode every whole text, with ``end_id`` after each, and write the files in ascending id order.

    Null texts count as empty and consist of the end id alone.  Rows that share an id
    are kept all, in an order of their texts' hashes; a null id comes first.  An empty table writes files
    without rows.  Extra columns are not read.  Ids must be whole numbers.
    """
    spark = docs.sparkSession
    classes = spark.sparkContext.broadcast(character_classes())
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    arrow_schema = _arrow_schema()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        install_classes(classes.value)
        coder, shard = encoder(tokenizer), TaskContext.get().partitionId()
        held, doc_ids, sizes, total, segment = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            row = {"shard": shard, "segment": segment, **encode_segment(np.concatenate(held), doc_ids, sizes)}
            return pa.RecordBatch.from_pylist([row], schema=arrow_schema)

        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                ids, ends = coder.encode(part.column("text").to_pylist())
                lengths = np.diff(ends, prepend=0)
                # The end id of each text goes in behind it.
                held.append(np.insert(ids, ends, end_id))
                doc_ids += part.column("doc_id").to_pylist()
                sizes += (lengths + 1).tolist()
                total += len(ids) + part.num_rows
                if total >= SEGMENT_IDS:
                    yield closed()
                    held, doc_ids, sizes, total, segment = [], [], [], 0, segment + 1
        if doc_ids:
            yield closed()

    ordered.mapInArrow(encoded, SCHEMA).write.mode("overwrite").parquet(folder)


def _arrow_schema() -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(SCHEMA))


def read_ids(spark: SparkSession, folder: str, columns: dict[str, Column] | None = None) -> DataFrame:
    """(shard, segment, doc_id, start, ids): the documents of the files, decoded and checked.

    ``ids`` are little-endian unsigned 32-bit integers; ``start`` counts the ids of all
    documents before.  ``columns`` are taken of ``ids`` in its place, before anything is shuffled.
    """
    files = spark.read.schema(SCHEMA).parquet(folder)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                raw = decode_segment(row).astype("<u4")
                sizes = np.array([d["n_ids"] for d in row["docs"]], dtype=np.int64)
                ends = np.cumsum(sizes)
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int32()),
                        pa.array([d["doc_id"] for d in row["docs"]], pa.int64()),
                        pa.array([raw[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)], pa.binary()),
                        pa.array(ends - sizes, pa.int64()),
                    ],
                    ["shard", "segment", "doc_id", "ids", "inside"],
                )

    docs = files.mapInArrow(decoded, "shard int, segment int, doc_id long, ids binary, inside long")
    # One row for each segment of about SEGMENT_IDS ids.
    order = Window.orderBy("shard", "segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", "segment", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    digested = docs.select(
        "shard", "segment", "doc_id", "inside", *[column.alias(name) for name, column in (columns or {"ids": F.col("ids")}).items()]
    )
    return digested.join(starts, ["shard", "segment"]).withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside")
