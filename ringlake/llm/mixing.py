"""Mixing sources to target weights.

Every source gets a share of all words by its weight, but at most ``max_epochs``
times its own size; what that leaves over goes to the others by weight.  Inside a
source the documents are put in a hash-random order.  Running totals of their sizes
in that order say where the source's budget ends: whole epochs first, then the
documents in order, the last one in part, so that the budget is met to the word.

The order is cut into key ranges of about ``RANGE_ROWS`` documents.  A hot source
simply has more ranges.  Only the totals of the ranges meet in one window per source,
one row for each ``RANGE_ROWS`` documents; a document's running total is its range's
start plus a running sum inside the range.  A range that is ``HOT`` times as large
holds an id that many rows share, or null ids: it is cut again by id and size, and rows
alike in both by a hash of the text.  Only copies of one id and text stay in one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ringlake.llm.text import word_count
from ringlake.sources.scratch import written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
RANGE_ROWS = 2048
HOT = 8
FEW_SOURCES = 10_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets for rows (source, source_size, source_rows): one row per source, null last.

    Sources take the weights in turn, in code-point order.  Sorted by size over weight,
    the sources that reach their ceiling are the first ones: each is capped exactly if
    its ceiling is no more than its share of what the sources before it leave over.
    ``budget`` is the whole number of words below ``target``.  The windows here see one
    row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int")).cast("long")
    ceiling = F.col("source_size") * max_epochs
    by_ratio = Window.orderBy((F.col("ceiling") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    shares = (
        sizes.withColumn("weight", weight)
        .withColumn("ceiling", ceiling)
        .withColumns(
            {
                "left_over": F.sum("source_size").over(everything)
                - F.coalesce(F.sum("ceiling").over(before), F.lit(0)),
                "weights_left": F.sum("weight").over(onward),
            }
        )
        .withColumn("capped", F.col("ceiling") * F.col("weights_left") <= F.col("weight") * F.col("left_over"))
    )
    first_free = F.min(
        F.when(~F.col("capped"), F.struct(-F.col("weights_left"), "weights_left", "left_over"))
    ).over(everything)
    return (
        shares.withColumn("free", first_free)
        .withColumns(
            {
                "target": F.when(F.col("capped"), F.col("ceiling").cast("double")).otherwise(
                    (F.col("weight") * F.col("free.left_over")) / F.col("free.weights_left")
                ),
                "budget": F.when(F.col("capped"), F.col("ceiling")).otherwise(
                    F.expr("(weight * free.left_over) div free.weights_left")
                ),
            }
        )
        .select("source", "source_size", "source_rows", "target", "budget")
    )


def mix(
    docs: DataFrame,
    keep: list[str] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 7,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per document: ``row`` (struct of the ``keep`` columns) and its share of the mix.

    Further columns: size, source_size, target, taken (words, repeats counted) and
    source_rows.  ``size`` defaults to the number of words in ``text``.

    A null or blank text has size 0 and takes nothing.  Null sources form a source of
    their own, the last one.  Documents that share an id are ordered by size and text;
    rows alike in all of these may swap places, which changes no figure.  An empty table gives
    an empty table.  Extra columns are looked at only when ``keep`` names them, and
    then stay inside ``row``, so their names cannot clash.
    """
    size = word_count(F.col("text")) if size is None else size
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    kept = docs.columns if keep is None else keep
    others = [F.col(f"`{c}`") for c in kept if c not in (doc_id, source, "text")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col(source).alias("source"),
        size.alias("size"),
        key.alias("key"),
        (F.xxhash64("text") if "text" in docs.columns else F.lit(0).cast("long")).alias("tie"),
        (F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("long")).alias("other"),
    ).withColumn(
        # Never null, so that equality joins and windows share one exchange.
        "named", F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    targets = source_targets(sizes, weights, max_epochs).withColumn(
        "named", F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    )
    # One row per source, broadcast only while these are few; else the join splits hot sources.
    targets = written(targets.drop("source"), "source-targets")
    if targets.count() <= FEW_SOURCES:
        targets = F.broadcast(targets)
    position = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(float(2**32))
    ranges = F.floor(position * (1 + F.expr(f"source_rows div {int(range_rows)}")))
    placed = rows.drop("source").join(targets, "named").withColumn("range", ranges)
    at = ["named", "range"]
    ranges = written(
        _started(
            placed.groupBy(*at).agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n")), ["named"], ["range"]
        ),
        "mix-ranges",
    )
    hot = ranges.where(F.col("n") > HOT * range_rows).select(*at, "start", "n")
    n_hot = hot.count()
    if not n_hot:
        numbered = _numbered(placed, ranges.select(*at, "start"), at)
    else:
        hot = F.broadcast(hot) if n_hot <= FEW_SOURCES else hot
        calm = placed.join(hot.select(*at), at, "left_anti")
        numbered = _numbered(calm, ranges.select(*at, "start"), at).unionByName(_cut_again(placed, hot, range_rows))
    return (
        numbered.withColumns(
            {
                "epochs": F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)),
                "rest": F.when(F.col("source_size") > 0, F.expr("budget % source_size")).otherwise(F.lit(0)),
            }
        )
        .withColumn(
            "taken",
            F.col("epochs") * F.col("size")
            + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))),
        )
        .select("row", "size", "source_size", "target", "taken", "source_rows")
    )


def _started(totals: DataFrame, of: list[str], order: list[str], start: str = "start") -> DataFrame:
    """``totals`` with the sum of ``total`` over the rows before, ``of`` by ``of``."""
    before = Window.partitionBy(*of).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(start, F.coalesce(F.sum("total").over(before), F.lit(0)))


def _numbered(rows: DataFrame, starts: DataFrame, at: list[str]) -> DataFrame:
    """``rows`` with ``before``, the words before each in the order of its source."""
    inside = Window.partitionBy(*at).orderBy("key", "size", "tie", "other").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.join(starts, at).withColumn("before", before).drop("start")


def _cut_again(placed: DataFrame, hot: DataFrame, range_rows: int) -> DataFrame:
    """``_numbered`` for the rows of hot ranges.

    Words before an id and size come from totals of these, one row for each.  Rows alike
    in both are cut by their hash, so that a piece has about ``range_rows`` of them.
    """
    group = ["named", "range", "key", "size"]
    pieces = F.expr(f"1 + n div {int(range_rows)}")
    rows = placed.join(hot, ["named", "range"]).withColumn("piece", F.pmod(F.xxhash64("tie"), pieces)).drop("n")
    totals = rows.groupBy(*group, "piece").agg(F.sum("size").alias("total"), F.first("start").alias("start"))
    by_group = totals.groupBy(*group).agg(F.sum("total").alias("total"))
    by_group = _started(by_group, ["named", "range"], ["key", "size"], "in_range").drop("total")
    starts = (
        _started(totals.withColumnRenamed("start", "first"), group, ["piece"], "in_group")
        .join(by_group, group)
        .select(*group, "piece", (F.col("first") + F.col("in_range") + F.col("in_group")).alias("start"))
    )
    return _numbered(rows.drop("start"), starts, [*group, "piece"]).drop("piece")


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, in the columns of ``docs``.

    A document at the end of its source's budget contributes the words that are still
    wanted, with the white space between them; one that takes no word is left out.
    """
    taken = mix(docs, **options)
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0))
    times = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0)).cast("int")
    part = F.concat(
        F.array_repeat(F.lit(None).cast("long"), times),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")),
    )
    words = F.explode(part).alias("words")
    whole = F.col("row").getField(text)
    head = F.when(
        F.col("words").isNotNull(),
        F.expr(rf"array_join(slice(regexp_extract_all(row.{text}, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0), 1, cast(words as int)), '')"),
    ).otherwise(whole)
    columns = [head.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]
    return taken.select("row", words).select(*columns)
