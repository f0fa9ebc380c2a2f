"""Packing token sequences of bounded length, as few as possible.

Only the histogram of piece lengths, at most ``capacity`` numbers, comes to the
driver.  There a configuration linear program chooses patterns of lengths that share a
sequence: multiplicative weights put a price on each length, a bounded knapsack dynamic
program finds the dearest patterns, their lengths get cheaper, and so on, until the amounts
are within ``GAP`` of the bound that the prices prove.  Amounts are rounded down, and the
rest is filled with the dearest patterns that it allows, at the program's prices.  Only
what is left when ``MOST_CELLS`` end is packed greedily, longest first.

The pieces themselves stay distributed.  Each gets a number among the pieces of its
length (its rank in its task, plus the counts of the tasks before), and a table of
patterns maps (length, number) to a sequence and an offset.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ringlake.llm.encoding import encoder
from ringlake.llm.pretokens import character_classes, install_classes
from ringlake.sources.scratch import written

CAPACITY = 4096
GAP = 0.01  # of the program's amounts above its proven bound
STEPS = (0.3, 0.1, 0.03, 0.01)  # of the weights, a phase each
PHASE_ROUNDS = 5000  # ends a phase that has not covered all lengths often enough
LONGEST = 150  # lengths, and as many others, that a round of rounding prices
MOST_CELLS = 2_000_000_000  # of all knapsack tables of the program, and twice as many of its rounding


def pieces_of(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
    end_id: int = 1, keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, number): the pieces of every document.

    ``number`` counts the pieces of one length in a task, ``part`` is the task.  Both
    change with the input's partitions, so the table has to be written before use.
    ``keep_ids`` adds the ids as little-endian unsigned 32-bit integers.
    """
    classes = docs.sparkSession.sparkContext.broadcast(character_classes())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        install_classes(classes.value)
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids, ends = coder.encode(some.column("text").to_pylist())
                sizes = np.diff(ends, prepend=0) + 1
                raw = np.insert(ids, ends, end_id).astype("<u4")
                begins = np.cumsum(sizes) - sizes
                n_pieces = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(sizes)), n_pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(sizes[owner] - start, capacity)
                from_ = begins[owner] + start
                held = [raw[a : a + n].tobytes() for a, n in zip(from_, length, strict=True)]
                # Rank among equal lengths of this task.
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order])
                number = np.empty(len(length), dtype=np.int64)
                number[order] = np.arange(len(length)) - first
                number += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    some.column("doc_id").take(pa.array(owner)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(h) for h in held], pa.int64()),
                    pa.array(np.full(len(length), part), pa.int32()),
                    pa.array(number, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
                if keep_ids:
                    columns.append(pa.array(held, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, number long"
    return rows.mapInArrow(cut, schema + (", ids binary" if keep_ids else ""))


# --- the linear program, on the histogram ---------------------------------------------
@dataclass
class Pattern:
    """``bins`` sequences, each with ``copies[i]`` pieces of ``lengths[i]``; chosen by the program or by greed."""

    bins: int
    lengths: np.ndarray
    copies: np.ndarray
    by_program: bool = False


class Knapsack:
    """Dearest fillings by dynamic programming, with no more copies of a length than ``most``.  ``lengths`` ascend.

    One table holds the best filling with the lengths up to each one, so that besides the
    dearest of all it gives the dearest filling for every length as the longest piece.
    """

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, capacity: int, most: np.ndarray):
        self.lengths, self.capacity = lengths, capacity
        # Bundles of 1, 2, 4, ... copies make up any number of them; one copy comes last, by itself.
        self.bundles: list[tuple[int, int, int]] = []
        self.ends = np.zeros(len(lengths), dtype=np.int64)
        for i, (length, n) in enumerate(zip(lengths.tolist(), most.tolist(), strict=True)):
            bundle = 1
            while n > 1:
                bundle = min(bundle, n - 1)
                self.bundles.append((i, bundle, bundle * length))
                n -= bundle
                bundle *= 2
            self.ends[i] = len(self.bundles)
            if n:
                self.bundles.append((i, 1, length))
        best = np.zeros(capacity + 1)
        # The last bundle that the best filling of each room has among those before.
        self.last = np.full((len(self.bundles) + 1, capacity + 1), -1, dtype=np.int16)
        self.values = np.zeros(len(lengths))
        price_of, length_of, ends = prices.tolist(), lengths.tolist(), self.ends.tolist()
        for at, (i, bundle, size) in enumerate(self.bundles):
            if at == ends[i]:
                self.values[i] = price_of[i] + best[capacity - length_of[i]]
            value, row = best[: capacity + 1 - size] + bundle * price_of[i], self.last[at + 1]
            row[:] = self.last[at]
            np.copyto(row[size:], at, where=value > best[size:])
            np.maximum(best[size:], value, out=best[size:])
        self.value = float(best[capacity])

    def pattern(self, longest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(which, copies) of the dearest filling, or of the dearest with this length as its longest piece."""
        held: dict[int, int] = {} if longest is None else {longest: 1}
        room = self.capacity - (0 if longest is None else int(self.lengths[longest]))
        at = self.last[len(self.bundles) if longest is None else self.ends[longest], room]
        while at >= 0:
            i, bundle, size = self.bundles[at]
            held[i] = held.get(i, 0) + bundle
            room -= size
            at = self.last[at, room]
        which = np.array(sorted(held), dtype=np.int64)
        return which, np.array([held[i] for i in which.tolist()], dtype=np.int64)


def _most(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    return np.minimum(capacity // lengths, demand.astype(np.int64))


def dearest_pattern(
    lengths: np.ndarray, prices: np.ndarray, capacity: int, demand: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming, with no more copies of a length than its demand.  ``lengths`` ascend."""
    return Knapsack(lengths, prices, capacity, capacity // lengths if demand is None else _most(lengths, demand, capacity)).pattern()


def _table_cells(most: np.ndarray, capacity: int) -> int:
    return int(np.ceil(np.log2(np.maximum(most, 1)) + 1).sum()) * (capacity + 1)


def configuration_program(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP
) -> tuple[list[tuple[float, np.ndarray, np.ndarray]], float, np.ndarray]:
    """Fractional patterns (amount, which, copies) that cover the demand, a lower bound of any such sum of amounts, and its prices.

    The sum is at most ``gap`` above the bound, unless all ``STEPS`` or ``MOST_CELLS`` end
    before; then it is the best found, which may be none.  A round prices all lengths once
    and takes every pattern that stays nearly as dear as the dearest while prices fall.
    """
    most = _most(lengths, demand, capacity)
    cells, rounds = _table_cells(most, capacity), 0
    logs = np.log(lengths * demand)  # the first prices are the lengths: the bound starts at the sum of all lengths
    bound, prices, best, least = 0.0, lengths.astype(float), [], np.inf
    for step in STEPS:
        covered, spent, amounts = np.zeros(len(lengths)), 0.0, {}
        enough = np.log(len(lengths) + 1) / step
        for _ in range(PHASE_ROUNDS):
            rounds += 1
            if rounds * cells > MOST_CELLS:
                return best, bound, prices
            weights = np.exp(logs - logs.max())
            table = Knapsack(lengths, weights / demand, capacity, most)
            if weights.sum() / table.value > bound:
                bound, prices = float(weights.sum() / table.value), weights / demand
            near = np.flatnonzero(table.values >= (1 - step / 3) * table.value)
            for longest in near[np.argsort(-table.values[near], kind="stable")].tolist():
                which, copies = table.pattern(longest)
                now = weights[which]
                if (now / demand[which] * copies).sum() < (1 - step / 3) * table.value:
                    continue
                # As much as covers the scarcest length of the pattern once.
                amount = float((demand[which] / copies).min())
                gain = amount * copies / demand[which]
                covered[which] += gain
                logs[which] -= step * gain
                weights[which] = now * np.exp(-step * gain)
                spent += amount
                held = amounts.setdefault((which.tobytes(), copies.tobytes()), [0.0, which, copies])
                held[0] += amount
            lowest = covered.min()
            if lowest > 0 and spent / lowest < least:
                least = spent / lowest
                best = [(amount / lowest, which, copies) for amount, which, copies in amounts.values()]
            if least <= (1 + gap) * bound:
                return best, bound, prices
            if lowest >= enough / step:
                break
    return best, bound, prices


def priced_patterns(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP
) -> tuple[list[tuple[float, np.ndarray, np.ndarray]], float]:
    """The patterns of ``configuration_program`` and its bound."""
    return configuration_program(lengths, demand, capacity, gap)[:2]


def rounded_patterns(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, chosen: list[tuple[float, np.ndarray, np.ndarray]], prices: np.ndarray
) -> list[Pattern]:
    """Whole sequences for the program's amounts, none with more pieces than there are.

    Amounts of patterns within ``GAP`` of the dearest are rounded down first.  What they leave
    is priced again with the program's prices, round by round: the longest length left is
    used with its dearest filling, as often as the rest allows, then the next.  Pieces that
    are left when the cells end are not in the result.
    """
    left, out, cells = demand.copy(), [], 0

    def use(bins: int, which: np.ndarray, copies: np.ndarray) -> None:
        if bins > 0:
            left[which] -= bins * copies
            out.append(Pattern(bins, lengths[which], copies, by_program=True))

    dearest = Knapsack(lengths, prices, capacity, _most(lengths, demand, capacity)).value
    for amount, which, copies in sorted(chosen, key=lambda c: -c[0]):
        if (prices[which] * copies).sum() >= (1 - GAP) * dearest:
            use(min(int(amount), int((left[which] // copies).min())), which, copies)
    # Among equally dear fillings the one with the longer pieces: short ones fill what is left at the end.
    prices = prices * (1 + 1e-4 * lengths / capacity)
    for turn in itertools.count():
        open_ = np.flatnonzero(left)
        if not len(open_):
            break
        if len(open_) > 2 * LONGEST:
            # With many lengths the longest and some others fill a sequence as well as all of them would.
            others = len(open_) - LONGEST
            stride = -(-others // LONGEST)
            open_ = np.concatenate([open_[turn % stride : others : stride], open_[others:]])
        most = _most(lengths[open_], left[open_], capacity)
        cells += _table_cells(most, capacity)
        if cells > 2 * MOST_CELLS:
            break
        table = Knapsack(lengths[open_], prices[open_], capacity, most)
        for longest in range(len(open_) - 1, max(len(open_) - LONGEST, 0) - 1, -1):
            which, copies = table.pattern(longest)
            which = open_[which]
            bins = int((left[which] // copies).min())
            if not bins:  # shorter ones would take what longer ones need: price again
                break
            use(bins, which, copies)
    return out


def greedy_patterns(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[Pattern]:
    """Longest first, each sequence filled with the longest pieces that still fit; equal sequences at once."""
    left, out = left.copy(), []
    while left.any():
        room, which, copies = capacity, [], []
        open_ = np.flatnonzero(left)
        while len(open_):
            fit = open_[: np.searchsorted(lengths[open_], room, side="right")]
            if not len(fit):
                break
            i = int(fit[-1])
            n = min(int(left[i]), room // int(lengths[i]))
            which.append(i)
            copies.append(n)
            room -= n * int(lengths[i])
            open_ = fit[:-1]
        which, copies = np.array(which), np.array(copies, dtype=np.int64)
        bins = int((left[which] // copies).min())
        left[which] -= bins * copies
        out.append(Pattern(bins, lengths[which], copies))
    return out


def packed_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold each length exactly as often as it occurs.

    The program's, rounded; only what its bounds leave over is packed greedily.
    """
    lengths, demand = np.asarray(lengths, dtype=np.int64), np.asarray(demand, dtype=np.int64)
    if not len(lengths):
        return []
    chosen, _, prices = configuration_program(lengths, demand.astype(float), capacity)
    out = rounded_patterns(lengths, demand, capacity, chosen, prices)
    left = demand.copy()
    for p in out:
        left[np.searchsorted(lengths, p.lengths)] -= p.bins * p.copies
    return out + greedy_patterns(lengths, left, capacity)


def placement(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Runs of piece numbers by length: from which number, to which sequence, copies a sequence and first offset."""
    rows, used, base = [], {}, 0
    for p in patterns:
        offset = 0
        for length, copies in zip(p.lengths.tolist(), p.copies.tolist(), strict=True):
            first = used.get(length, 0)
            rows.append((length, first, base, copies, offset))
            used[length] = first + p.bins * copies
            offset += copies * length
        base += p.bins
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "base", "copies", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written, as of ``pieces_of``) with sequence_id and offset in place of part and number.

    Every piece is placed, sequences have no gaps, and no sequence exceeds ``capacity``.
    An empty table gives an empty table.
    """
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # At most one row a length and task.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    # At most ``capacity`` rows.
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()
    lengths, demand = [r["length"] for r in histogram], [r["n"] for r in histogram]
    # Patterns come from the histogram alone: their number does not grow with the documents.
    table = placement(packed_patterns(np.array(lengths), np.array(demand), capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in pieces.columns if c not in ("part", "number")]
    numbered = pieces.join(offsets, ["length", "part"]).select(
        *kept, (F.col("number") + F.col("earlier")).alias("number")
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        key = runs["length"] << 48 | runs["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(key, length << 48 | number, side="right") - 1
            inside = number - runs["first"][at]
            sequence = runs["base"][at] + inside // runs["copies"][at]
            offset = runs["offset"][at] + inside % runs["copies"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*kept, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*kept).schema)
    return numbered.mapInArrow(placed, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every piece of every document.

    A document is its ids and the end id; null and empty texts are the end id alone.
    Longer ones than ``capacity`` are cut, the last piece may be shorter.  Repeated rows
    are packed each; ids may be null or repeat.  Extra columns are not read.
    """
    return pack(written(pieces_of(docs, tokenizer, capacity, **options), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, docs, ids): the packed sequences; needs pieces with their ids."""
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    gathered = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    docs = F.transform("parts", lambda p: p.dropFields("ids"))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["length"])
    return gathered.select("sequence_id", length.alias("length"), docs.alias("docs"), joined.alias("ids"))
