"""Language identification with interpolated Kneser-Ney character models.

1. Texts become lower-case letters and marks; every run of other characters is one
   space.  All n-grams of ``ORDER`` characters of all documents to learn from are counted
   per language; lower orders count the different characters that come before.
2. A model is two sorted arrays of hashes per language and order: of n-grams with their
   discounted share, and of contexts with the weight that goes to the order below.
3. A text's cross-entropy per language is the mean over its characters; the lowest
   wins.  Only the different n-grams of a chunk of texts are looked up.
4. Models of one half of what is learned from are tried on the other half.  That gives
   each margin between the best two languages its share of right answers (made monotone),
   which is the score, and each language the cross-entropy beyond which a text is
   rejected as being in none of the languages.

Models are broadcast in slices of about ``SLICE`` entries, dealt by the last character
of the context: an n-gram, its context and all their shorter forms share it, so the
sums over slices are exact however large the models are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ringlake.llm.repeats import _P, _mixed
from ringlake.sources.scratch import written

ORDER = 4
CHUNK = 2_000_000  # characters that are counted or scored at a time
ALPHABET = 1 << 15  # different characters of a chunk, so that ORDER of them fit 60 bits
SLICE = 4_000_000  # entries of all arrays in a broadcast, 12 bytes each
BINS, BIN_BITS = 256, 0.02  # margins: so many bins of that many bits per character
KEPT = 0.995  # share of known texts that is not rejected
UNKNOWN = "und"
SPACE = 32


# --- characters -----------------------------------------------------------------------
@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case letter, a mark itself, else a space; and whether it is a letter."""
    shown, letter = np.full(0x110000, SPACE, dtype=np.uint32), np.zeros(0x110000, dtype=bool)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LM":
            low = chr(code).lower()
            shown[code] = ord(low) if len(low) == 1 else code
            letter[code] = kind == "L"
    return shown, letter


def cleaned(text: str | None) -> np.ndarray:
    """Code points after ``ORDER - 1`` spaces and before one; none where there is no letter."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32)
    shown, letter = _classes()
    if not letter[raw].any():
        return np.zeros(0, dtype=np.uint32)
    inner = np.append(shown[raw], np.uint32(SPACE))
    blank = inner == SPACE
    keep = np.append(not blank[0], ~(blank[1:] & blank[:-1]))  # the spaces before stand for a first one
    return np.concatenate([np.full(ORDER - 1, SPACE, np.uint32), inner[keep]])


def chunks(texts: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, owner) of about ``CHUNK`` characters and at most ``ALPHABET`` different ones.

    A text goes on in the next chunk with its last ``ORDER - 1`` characters, so every
    n-gram is in one chunk.
    """
    waiting, size = [], 0
    for owner, codes in enumerate(texts):
        at = 0
        while at + ORDER <= len(codes):
            part = codes[at : at + CHUNK - size + ORDER]
            waiting.append((owner, part))
            size += len(part)
            at += len(part) - ORDER + 1
            if size >= CHUNK:
                yield from _narrow(waiting)
                waiting, size = [], 0
    if waiting:
        yield from _narrow(waiting)


def _narrow(parts: list[tuple[int, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes = np.concatenate([p for _, p in parts])
    owner = np.repeat([o for o, _ in parts], [len(p) for _, p in parts])
    if len(codes) <= ALPHABET or len(np.unique(codes)) <= ALPHABET:
        yield codes, owner
        return
    for at in range(0, len(codes) - ORDER + 1, ALPHABET - ORDER + 1):
        yield codes[at : at + ALPHABET], owner[at : at + ALPHABET]


def grams(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different n-grams as rows of code points, the n-gram at each place, the owner of each place)."""
    table = np.zeros(int(codes.max()) + 1, dtype=np.uint64)
    table[codes] = 1
    known = np.flatnonzero(table).astype(np.uint32)
    table[known] = np.arange(len(known), dtype=np.uint64)
    ids = table[codes]
    ends = len(codes) - ORDER + 1
    packed = np.zeros(max(ends, 0), dtype=np.uint64)
    for i in range(ORDER):
        packed = (packed << np.uint64(15)) | ids[i : i + ends]
    whole = owner[:ends] == owner[ORDER - 1 :]  # not across two texts
    found, place = np.unique(packed[whole], return_inverse=True)
    columns = [known[(found >> np.uint64(15 * (ORDER - 1 - i))) & np.uint64(ALPHABET - 1)] for i in range(ORDER)]
    return np.stack(columns, axis=1) if len(found) else np.zeros((0, ORDER), np.uint32), place, owner[:ends][whole]


def _hashes(rows: np.ndarray) -> np.ndarray:
    """One hash for each row of code points; rows of different lengths are hashed apart."""
    out = np.full(len(rows), rows.shape[1] + 1, dtype=np.uint64)
    for column in rows.T:
        out = _mixed(out ^ column.astype(np.uint64)) * _P
    return out


# --- counts ---------------------------------------------------------------------------
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, folds = batch.column("lang").to_pylist(), batch.column("fold").to_pylist()
        texts = batch.column("text")
        for lang, fold in sorted(set(zip(langs, folds, strict=True))):
            rows = [i for i, key in enumerate(zip(langs, folds, strict=True)) if key == (lang, fold)]
            for codes, owner in chunks(cleaned(texts[i].as_py()) for i in rows):
                found, place, _ = grams(codes, owner)
                n = np.bincount(place, minlength=len(found))
                shown = np.ascontiguousarray(found, dtype=np.uint32).view(f"<U{ORDER}").ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array([fold] * len(found), pa.int32()), pa.array(shown.tolist(), pa.string()), pa.array(n, pa.int64())],
                    ["lang", "fold", "gram", "n"],
                )


def gram_counts(learned: DataFrame) -> DataFrame:
    """(lang, fold, gram, n): how often each n-gram of ``ORDER`` characters is in (lang, fold, text)."""
    each = learned.select("lang", "fold", "text").mapInArrow(_counted, "lang string, fold int, gram string, n long")
    return each.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n"))


def model_entries(counts: DataFrame) -> DataFrame:
    """(lang, size, context, key, value) of the arrays; ``counts`` is (lang, gram, n).

    With n an n-gram's count (in lower orders the number of different characters before
    it), N the sum over its context and D the discount of order and language, n-grams have
    max(n - D, 0) / N and contexts D * (different characters after it) / N.
    """
    out, now = None, counts
    for size in range(ORDER, 0, -1):
        # Written, as four aggregates read it: else each order's plan holds those of all higher ones, several times.
        now = written(now, "order-counts")
        now = now.withColumn("context", F.expr(f"substring(gram, 1, {size - 1})"))
        # With no n-gram of count one or two, half of a count is taken.
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discounts = now.groupBy("lang").agg(
            F.when((ones > 0), ones / (ones + 2 * twos)).otherwise(0.5).alias("d")
        )
        # A language has one row here, a context a few.
        contexts = now.groupBy("lang", "context").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).join(discounts, "lang")
        shares = now.join(contexts, ["lang", "context"]).select(
            "lang", F.lit(size).alias("size"), F.lit(False).alias("context"), F.col("gram").alias("key"),
            (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("all")).alias("value"),
        )
        weights = contexts.select(
            "lang", F.lit(size).alias("size"), F.lit(True).alias("context"), F.col("context").alias("key"),
            (F.col("d") * F.col("kinds") / F.col("all")).alias("value"),
        )
        out = shares.unionByName(weights) if out is None else out.unionByName(shares).unionByName(weights)
        now = now.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    return out


# --- scoring --------------------------------------------------------------------------
def _hasher(langs: list[str]):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries as numbers: what they are for, the hash of their key, and the value."""
        number = {lang: i for i, lang in enumerate(langs)}
        for batch in batches:
            size, context = batch.column("size").to_numpy(), batch.column("context").to_numpy(zero_copy_only=False)
            keys = np.zeros(batch.num_rows, dtype=np.uint64)
            shown = np.array(batch.column("key").to_pylist(), dtype=f"<U{ORDER}").view(np.uint32).reshape(-1, ORDER)
            for width in range(ORDER + 1):
                rows = np.flatnonzero(size - context == width)
                keys[rows] = _hashes(shown[rows, :width])
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            array = (lang * (ORDER + 1) + size) * 2 + context
            yield pa.RecordBatch.from_arrays(
                [pa.array(array, pa.int64()), pa.array(keys.view(np.int64)), batch.column("value"), batch.column("known")],
                ["array", "hash", "value", "known"],
            )

    return hashed


def hashed_models(entries: DataFrame, langs: list[str]) -> DataFrame:
    """(array, hash, value, known): ``known`` is the last character of the context, null for arrays without one."""
    known = F.when(F.col("context"), F.expr("right(key, 1)")).otherwise(F.expr("right(left(key, length(key) - 1), 1)"))
    with_known = entries.withColumn("known", F.when(known != "", F.ascii(known)))
    return with_known.mapInArrow(_hasher(langs), "array long, hash long, value double, known int")


class Models:
    """Sorted hash arrays of every language, for contexts that end in the characters of one slice."""

    def __init__(self, entries: pa.Table, langs: int, alphabet: int, slices: int, number: int):
        self.langs, self.alphabet, self.slices, self.number, self.arrays = langs, alphabet, slices, number, {}
        array, keys = entries.column("array").to_numpy(), entries.column("hash").to_numpy().view(np.uint64)
        order = np.lexsort([keys, array])
        names, starts = np.unique(array[order], return_index=True)
        for name, rows in zip(names.tolist(), np.split(order, starts[1:]), strict=True):
            self.arrays[name] = keys[rows], entries.column("value").to_numpy()[rows]

    def _looked_up(self, lang: int, size: int, context: bool, rows: np.ndarray, missing: float) -> np.ndarray:
        name = (lang * (ORDER + 1) + size) * 2 + context
        if name not in self.arrays:
            return np.full(len(rows), missing)
        keys, values = self.arrays[name]
        asked = _hashes(rows)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[at] == asked, values[at], missing)

    def bits(self, rows: np.ndarray, lang: int) -> np.ndarray:
        """-log2 of the probability of each n-gram's last character after the others."""
        p = np.full(len(rows), 1 / self.alphabet)
        for size in range(1, ORDER + 1):
            share = self._looked_up(lang, size, False, rows[:, ORDER - size :], 0.0)
            weight = self._looked_up(lang, size, True, rows[:, ORDER - size : ORDER - 1], 1.0)
            p = share + weight * p
        return -np.log2(p)


def _scorer(shared):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            letters: list[bool] = []

            def texts() -> Iterator[np.ndarray]:
                for text in batch.column("text"):
                    codes = cleaned(text.as_py())
                    letters.append(len(codes) > 0)
                    yield codes

            bits, n = np.zeros((batch.num_rows, models.langs)), np.zeros(batch.num_rows, dtype=np.int64)
            for codes, owner in chunks(texts()):
                found, place, at = grams(codes, owner)
                if models.slices > 1:
                    mine = found[:, ORDER - 2] % models.slices == models.number
                    place, at = place[mine[place]], at[mine[place]]
                n += np.bincount(at, minlength=len(n))
                for lang in range(models.langs):
                    bits[:, lang] += np.bincount(at, weights=models.bits(found, lang)[place], minlength=len(n))
            columns = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(letters, pa.bool_()), pa.array(n, pa.int64()), pa.array(bits.tolist(), pa.list_(pa.float64()))],
                [*columns, "letters", "n", "bits"],
            )

    return scored


def entropies(rows: DataFrame, models: DataFrame, langs: list[str], most: int | None = None) -> DataFrame:
    """``rows`` (text and other columns) without the text, with ``letters``, ``n`` and ``bits``, mean bits a character per language.

    ``models`` is a written table of ``hashed_models``.  Beyond ``most`` entries the texts are
    read once a slice; a slice is smaller than one character's contexts in no case.
    """
    spark = rows.sparkSession
    size = models.agg(F.count(F.lit(1)).alias("all"), F.countDistinct(F.when(F.expr(f"array % {2 * ORDER + 2} = 2"), F.col("hash"))).alias("letters")).first()
    slices = max(-(-size["all"] // (most or SLICE)), 1)
    if slices > 1:
        rows = written(rows.withColumn("__row", F.monotonically_increasing_id()), "language-asked")
    columns = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    out = None
    for number in range(slices):
        mine = models.where(F.col("known").isNull() | (F.col("known") % slices == number)) if slices > 1 else models
        held = Models(mine.select("array", "hash", "value").toArrow(), len(langs), size["letters"] + 1, slices, number)
        part = rows.mapInArrow(_scorer(spark.sparkContext.broadcast(held)), f"{kinds}, letters boolean, n long, bits array<double>")
        out = part if out is None else out.unionByName(part)
    if slices > 1:
        sums = F.array(*[F.sum(F.col("bits")[i]) for i in range(len(langs))]).alias("bits")
        out = out.groupBy(*columns, "letters").agg(F.sum("n").alias("n"), sums).drop("__row")
    return out.withColumn("bits", F.transform("bits", lambda b: b / F.greatest(F.col("n"), F.lit(1))))


# --- calibration ----------------------------------------------------------------------
def best_two(langs: list[str]) -> dict[str, Column]:
    """The language of the lowest cross-entropy (ties go to the first name), that entropy and the margin to the next."""
    named = F.array_sort(F.array(*[F.struct(F.col("bits")[i].alias("bits"), F.lit(x).alias("lang")) for i, x in enumerate(langs)]))
    first, second = F.element_at(named, 1), F.try_element_at(named, F.lit(2))
    return {
        "best": first["lang"],
        "entropy": first["bits"],
        "margin": F.coalesce(second["bits"] - first["bits"], F.lit(BINS * BIN_BITS)),
    }


def _bin() -> Column:
    return F.least(F.floor(F.col("margin") / BIN_BITS), F.lit(BINS - 1)).cast("int")


def monotone(right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Shares of right answers per bin, smoothed by one right and one wrong answer, never falling with the margin."""
    blocks: list[list[float]] = []
    for r, k in zip(right, n, strict=True):
        blocks.append([r, k, 1])
        while len(blocks) > 1 and _share(blocks[-2]) >= _share(blocks[-1]):
            r2, k2, m2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + r2, blocks[-1][1] + k2, blocks[-1][2] + m2]
    return np.concatenate([np.full(m, _share([r, k, m])) for r, k, m in blocks])


def _share(block: list[float]) -> float:
    return (block[0] + 1) / (block[1] + 2)


def calibrated(tried: DataFrame, langs: list[str]) -> tuple[list[float], dict[str, float]]:
    """(score of each margin bin, highest entropy kept of each language) from ``tried`` texts of known ``lang``."""
    judged = written(tried.where("letters").withColumns(best_two(langs)).select("lang", "best", "entropy", "margin"), "language-tried")
    right, n = np.zeros(BINS), np.zeros(BINS)
    for r in judged.groupBy(_bin().alias("bin")).agg(F.count_if(F.col("best") == F.col("lang")).alias("right"), F.count(F.lit(1)).alias("n")).collect():
        right[r["bin"]], n[r["bin"]] = r["right"], r["n"]
    # Entropies in thousandths: an exact quantile of few values, whatever the number of texts.
    own = judged.where("best = lang").groupBy("lang", F.ceil(F.col("entropy") * 1000).alias("mills")).agg(F.count(F.lit(1)).alias("n"))
    limits: dict[str, float] = {}
    by_lang: dict[str, list[tuple[int, int]]] = {}
    for r in own.collect():
        by_lang.setdefault(r["lang"], []).append((r["mills"], r["n"]))
    for lang, seen in by_lang.items():
        total, so_far = sum(k for _, k in seen), 0
        for mills, k in sorted(seen):
            so_far += k
            if so_far >= KEPT * total:
                limits[lang] = mills / 1000
                break
    return monotone(right, n).tolist(), limits


# --- the operator ---------------------------------------------------------------------
def fold_of(doc_id: Column) -> Column:
    return (F.crc32(doc_id.cast("string").cast("binary")) % 3).cast("int")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, entropy, accepted), a row for each row of ``docs``.

    Documents whose crc32 of the id leaves 1 when divided by 3 are held out; a null id is
    neither held out nor learned from, and neither is a null text or language learned.
    ``lang_pred`` is the learned language of the lowest cross-entropy, the first in name
    order of equal ones, or ``und`` where there is no letter or nothing was learned.
    ``score`` is the share of right answers at its margin, 0 for ``und``; ``accepted`` says
    whether the entropy (bits a character) is within what known texts of that language have.
    Rows that repeat get the same answer, and count each where they are learned.  Extra
    columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.withColumn("fold", fold_of(F.col("doc_id")))
    learned = rows.where("fold <> 1 AND text IS NOT NULL AND lang IS NOT NULL")
    counts = written(gram_counts(learned), "gram-counts")
    langs = sorted((r["lang"] for r in counts.select("lang").distinct().collect()), key=str.encode)  # the languages, not their documents
    held = F.coalesce(F.col("fold") == 1, F.lit(False)).alias("held_out")
    if not langs:
        return rows.select(
            "doc_id", held, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(False).alias("accepted")
        )

    def models(of: DataFrame) -> DataFrame:
        return written(hashed_models(written(model_entries(of), "language-models"), langs), "language-models")

    first = models(counts.where("fold = 0").select("lang", "gram", "n"))
    other = learned.where("fold = 2").select("doc_id", "lang", "text")
    scores, limits = calibrated(entropies(other, first, langs), langs)
    whole = models(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    judged = entropies(rows.select("doc_id", held, "text"), whole, langs).withColumns(best_two(langs))
    table = F.array(*[F.lit(s) for s in scores])
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("best")) if limits else F.lit(None).cast("double")
    known = F.col("letters")
    return judged.select(
        "doc_id",
        "held_out",
        F.when(known, F.col("best")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.element_at(table, _bin() + 1)).otherwise(0.0).alias("score"),
        F.when(known, F.col("entropy")).alias("entropy"),
        (known & F.coalesce(F.col("entropy") <= limit, F.lit(False))).alias("accepted"),
    )
