"""Quality rules: counts per document, and distance to a reference of its language.

Base counts come from one row-wise pass.  The verdict compares two histograms of a
document with those of all documents of its language, by Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1):

* classes of characters (lower case, capitals, digits, white space, punctuation,
  symbols, everything beyond ASCII);
* the language's common words, and all other words as one more cell.  A common word is
  short and makes up at least ``COMMON_SHARE`` of the language's words, so a language
  has at most 1 / COMMON_SHARE of them.

A histogram of few characters or words says little, so shorter texts than the guards
are not judged by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ringlake.llm.text import WORD, let, words
from ringlake.sources.scratch import written

# --- fixed values ---------------------------------------------------------------------
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
CLASSES = {
    "lower": r"[a-z]",
    "upper": r"[A-Z]",
    "digit": r"[0-9]",
    "space": r"[\x20\x09-\x0D]",
    "mark": r"[.,;:!?'\x22()\-]",
    "symbol": r"[#*$%&|<>@\[\]{}\\/+=^~_`]",
    "beyond": r"[^\x00-\x7F]",
}
# --- parameters of the verdict ----------------------------------------------------------
MIN_WORDS = 10
REPEAT_PERCENT = 20
COMMON_SHARE = 0.005
COMMON_LENGTH = 8
CLASS_LIMIT = 0.30
WORD_LIMIT = 0.28
CLASS_MIN_CHARS = 200
WORD_MIN_WORDS = 100


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of ``window`` words that occurs at least twice in the array.

    Windows are compared by 64-bit hashes.  Only arrays that do repeat a window sort
    theirs; positions of the repeated ones, in order, then cover
    ``min(window, distance to the next)`` words each.
    """

    def covered(positions: Column) -> Column:
        steps = F.zip_with(
            F.slice(positions, F.lit(1), F.size(positions) - 1),
            F.slice(positions, F.lit(2), F.size(positions) - 1),
            lambda a, b: F.least(F.lit(window), b - a),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step) + window

    def of_sorted(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        def twin(k):
            here = F.get(pairs, k)["h"]
            return ((k > 0) & (F.get(pairs, k - 1)["h"] == here)) | ((k < last) & (F.get(pairs, k + 1)["h"] == here))
        twins = F.filter(F.sequence(F.lit(0), last), twin)
        return let(F.sort_array(F.transform(twins, lambda k: F.get(pairs, k)["i"])), covered)

    def of_hashes(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, of_sorted))

    def of_words(array: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(array) - window)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(array, i + k) for k in range(window)]))
        return F.when(F.size(array) < window, F.lit(0)).otherwise(let(hashes, of_hashes))

    return let(F.transform(found, lambda w: F.xxhash64(w)), of_words).cast("long")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``base``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null text counts as empty.  Row-wise; nothing is shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def counts(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.char_length(F.array_join(found, "")).cast("long").alias("word_chars"),
            repeated_words(found).alias("n_repeat_words"),
        )

    lines = F.filter(F.split(body, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
    counted = docs.withColumns(
        {
            "__words": let(words(F.col(text)), counts),
            "__symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            "__dup_lines": dup_lines,
        }
    )
    n_words, n_repeat = F.col("__words.n_words"), F.col("__words.n_repeat_words")
    failed = (n_words < MIN_WORDS) | (n_repeat * 100 > n_words * REPEAT_PERCENT)
    return counted.withColumn(
        "base",
        F.struct(
            "__words.n_words",
            "__words.word_chars",
            F.col("__symbols").alias("n_symbols"),
            F.col("__dup_lines").alias("n_dup_lines"),
            "__words.n_repeat_words",
            failed.alias("base_failed"),
        ),
    ).drop("__words", "__symbols", "__dup_lines")


def class_counts(text: Column) -> Column:
    """How many characters of each of ``CLASSES`` a text has, as an array.

    No two classes share a character, so each is looked for in what the ones before it
    left over, by runs and not by single characters.
    """

    def after(patterns: list[str], rest: Column, found: list[Column]) -> Column:
        if not patterns:
            return F.array(*found)
        here = lambda left: (F.char_length(rest) - F.char_length(left)).cast("long")
        without = F.regexp_replace(rest, F.lit(f"{patterns[0]}+"), F.lit(""))
        return let(without, lambda left: after(patterns[1:], left, [*found, here(left)]))

    patterns = list(CLASSES.values())
    # In broken bytes lengths and patterns see different characters.
    broken = F.array(*[F.regexp_count(text, F.lit(p)).cast("long") for p in patterns])
    return F.when(F.is_valid_utf8(text), let(text, lambda whole: after(patterns, whole, []))).otherwise(broken)


def divergence_term(p: Column, q: Column) -> Column:
    """One cell's part of the Jensen-Shannon divergence, in bits."""
    middle = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / middle)).otherwise(F.lit(0.0))
    return (part(p) + part(q)) / 2


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """All rows of ``docs`` as struct ``row``, with ``base``, the two distances and ``kept``.

    Distances are null where a guard leaves a histogram unjudged, and such a null
    never rejects.  A null language is a language of its own.  Repeated rows get the
    same figures each.  Rows that share an id but not the text are judged apart.
    An empty table gives an empty table.  Extra columns stay inside ``row``.
    """
    body = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    language = F.col(f"row.{lang}")
    named = F.when(language.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), language.cast("string")))
    item = F.col(f"row.{doc_id}")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")).withColumns(
        {"lang_key": named, "text_key": F.struct(F.xxhash64(item, body).alias("a"), F.xxhash64(body, item).alias("b"))}
    )
    far = F.coalesce(F.col("class_distance") > CLASS_LIMIT, F.lit(False)) | F.coalesce(
        F.col("word_distance") > WORD_LIMIT, F.lit(False)
    )
    return (
        base_counts(rows.withColumn("__text", body), "__text")
        .select("row", "base", "text_key")
        .join(_distances(rows, body), "text_key")
        .select("row", "base", "class_distance", "word_distance", (~F.col("base.base_failed") & ~far).alias("kept"))
    )


def _distances(rows: DataFrame, body: Column) -> DataFrame:
    """(text_key, class_distance, word_distance), one row per key; no text is shuffled here."""
    letters = F.split(F.lower(body), r"[^\p{L}]+")
    # Counts of each text, written because the reference and the distances both read them.
    seen = written(
        rows.select(
            "text_key",
            "lang_key",
            class_counts(body).alias("chars"),
            F.regexp_count(body, F.lit(r"\p{L}+")).cast("long").alias("n_words"),
        ),
        "text-counts",
    )
    total = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, b: a + b)
    # One row per language.
    reference = seen.groupBy("lang_key").agg(
        F.array(*[F.sum(F.get("chars", F.lit(i))) for i in range(len(CLASSES))]).alias("all_chars"),
        F.sum("n_words").alias("all_words"),
    )

    short = F.filter(letters, lambda w: F.char_length(w).between(1, COMMON_LENGTH))
    spread = rows.select("lang_key", "text_key", F.explode(short).alias("word"))
    by_word = spread.groupBy("lang_key", "word").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.col("all_words")
    # At most 1 / COMMON_SHARE rows per language; read once per word of the corpus.
    common = written(
        by_word.join(reference, "lang_key").where(share >= COMMON_SHARE).select("lang_key", "word", share.alias("q")),
        "common-words",
    )
    common_share = common.groupBy("lang_key").agg(F.sum("q").alias("common_q"))
    own = (
        spread.join(common, ["lang_key", "word"])
        .groupBy("text_key", "word")
        .agg(F.count(F.lit(1)).alias("n"), F.first("q").alias("q"))
        .groupBy("text_key")
        .agg(F.sum("n").alias("n_common"), F.collect_list(F.struct("n", "q")).alias("cells"))
    )

    # Rows that repeat an id and a text count as often in n_common; both go by the same key.
    once = seen.groupBy("text_key").agg(
        F.first("lang_key").alias("lang_key"), F.first("chars").alias("chars"),
        F.first("n_words").alias("n_words"), F.count(F.lit(1)).alias("times"),
    )
    class_cells = F.zip_with(
        "chars", "all_chars", lambda a, b: divergence_term(a / F.col("n_chars"), b / F.col("all_n_chars"))
    )
    class_divergence = F.aggregate(class_cells, F.lit(0.0), lambda acc, x: acc + x)
    n_words = F.col("n_words") * F.col("times")
    all_q = F.coalesce("common_q", F.lit(0.0))
    # Common words that the document lacks add half of their share; all other words are one cell.
    word_divergence = F.aggregate(
        F.coalesce("cells", F.array().cast("array<struct<n:bigint,q:double>>")),
        all_q / 2,
        lambda acc, c: acc + divergence_term(c["n"] / n_words, c["q"]) - c["q"] / 2,
    ) + divergence_term(1 - F.coalesce("n_common", F.lit(0)) / n_words, 1 - all_q)
    distance = lambda divergence: F.sqrt(F.greatest(divergence, F.lit(0.0)))
    return (
        once.join(reference, "lang_key")
        .join(common_share, "lang_key", "left")
        .join(own, "text_key", "left")
        .withColumns({"n_chars": total("chars"), "all_n_chars": total("all_chars")})
        .select(
            "text_key",
            F.when(F.col("n_chars") >= CLASS_MIN_CHARS, distance(class_divergence)).alias("class_distance"),
            F.when(F.col("n_words") >= WORD_MIN_WORDS, distance(word_divergence)).alias("word_distance"),
        )
    )
