"""URL filter: rules first, then a ratio of two character language models.

Two variable-order Markov models, one of URLs that a rule allows and one of URLs that
a rule blocks, give every URL a log-likelihood difference per character.  Each model
interpolates orders 0 to ``ORDER`` by Witten-Bell smoothing: a context that was never
seen leaves the shorter one's estimate as it is.  The threshold is calibrated on rule
URLs that the calibrating models have not seen.

The models are tables of character n-grams with counts.  Digits are one symbol there,
so their size is bounded by the alphabet, not by the number of URLs; only sums of
counts are shuffled, after partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ringlake.sources.scratch import written

ORDER = 4
ALPHABET = 256  # symbols that order 0 spreads its unseen mass over
MISSED = 0.02  # the threshold lies midway between this quantile of allowed and its mirror of blocked URLs
DIGITS = 4  # of a score that count for the threshold: its histogram is small, and no order of sums shows
START, STOP = "\u0002", "\u0003"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# --- fixed values ---------------------------------------------------------------------
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null.  ``rules`` is a bounded parameter."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(line: Column) -> Column:
    """All (ORDER + 1)-grams of a padded line; the last character is the predicted one."""
    padded = F.concat(F.lit(START * ORDER), F.regexp_replace(line, "[0-9]", "0"), F.lit(STOP))
    starts = F.sequence(F.lit(1), F.char_length(padded) - ORDER)
    return F.transform(starts, lambda i: F.substr(padded, i, F.lit(ORDER + 1)))


def scored_grams(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, ratio): log P(allow) - log P(block) of a gram's last character after its context.

    ``counts`` has (gram, n_allow, n_block), ``wanted`` distinct grams.
    """
    scored = wanted.withColumns({f"p_{kind}": F.lit(1.0 / ALPHABET) for kind in ("allow", "block")})
    for order in range(ORDER + 1):
        suffix = F.substr(F.col("gram"), F.lit(ORDER + 1 - order))
        short = counts.groupBy(suffix.alias("short")).agg(F.sum("n_allow").alias("a"), F.sum("n_block").alias("b"))
        contexts = (
            short.withColumn("context", F.substr(F.col("short"), F.lit(1), F.lit(order)))
            .groupBy("context")
            .agg(
                F.sum("a").alias("all_a"), F.sum("b").alias("all_b"),
                F.count_if(F.col("a") > 0).alias("kinds_a"), F.count_if(F.col("b") > 0).alias("kinds_b"),
            )
        )
        keyed = scored.withColumn("short", suffix).withColumn("context", F.substr(F.col("short"), F.lit(1), F.lit(order)))
        joined = keyed.join(short, "short", "left").join(contexts, "context", "left")
        for kind, c in (("allow", "a"), ("block", "b")):
            seen, kinds = F.coalesce(f"all_{c}", F.lit(0)), F.coalesce(f"kinds_{c}", F.lit(0))
            mixed = (F.coalesce(c, F.lit(0)) + kinds * F.col(f"p_{kind}")) / (seen + kinds)
            joined = joined.withColumn(f"p_{kind}", F.when(seen > 0, mixed).otherwise(F.col(f"p_{kind}")))
        scored = joined.select("gram", "p_allow", "p_block")
    return scored.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): a row for each row of ``pages``.

    The score is the log-likelihood difference per character of host and path.  Null
    URLs and URLs without ``://`` have an empty host and path; these score by their
    one end symbol like any other.  Without rule URLs of both verdicts there are no
    models, all scores are 0 and all other URLs are allowed.  Repeated rows get the same answer
    each.  An empty table gives an empty table.  Extra columns are not read.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    rows = rows.withColumns(
        {
            "matched": matched_rule(F.col("host"), F.col("path"), rules),
            "line": F.concat("host", "path"),
            "fold": F.pmod(F.xxhash64("host", "path"), F.lit(2)),
        }
    )
    grams = rows.select("page_id", "line", "fold", "matched", F.explode(_grams(F.col("line"))).alias("gram"))
    # Sums per n-gram; from here on the tables are as small as the alphabet keeps them.
    counts = written(
        grams.groupBy("gram", "fold").agg(
            F.count_if(F.col("matched.verdict") == "allow").alias("n_allow"),
            F.count_if(F.col("matched.verdict") == "block").alias("n_block"),
        ),
        "url-grams",
    )
    wanted = counts.select("gram").distinct()
    # Half of the rule URLs teach, the other half sets the threshold: one number.
    taught = written(scored_grams(counts.where("fold = 0"), wanted), "url-ratios")
    held_out = _scores(grams.where("fold = 1 AND matched IS NOT NULL"), taught, "matched.verdict")
    threshold = calibrated(held_out)
    known = all(counts.agg(F.sum("n_allow"), F.sum("n_block")).first())
    threshold = threshold if known and threshold is not None else 0.0

    ratios = written(scored_grams(counts, wanted), "url-ratios") if known else wanted.withColumn("ratio", F.lit(0.0))
    key = ["page_id", "line"]
    scores = _scores(grams, ratios)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key]
    by_score = F.when(F.round("s.score", DIGITS) >= threshold, "allow").otherwise("block")
    return (
        rows.alias("r")
        .join(scores.alias("s"), same, "left")
        .select(
            "r.page_id", "r.host", "r.path", "r.matched.rule",
            F.coalesce("r.matched.verdict", by_score).alias("verdict"), "s.score",
        )
    )


def calibrated(judged: DataFrame) -> float | None:
    """The threshold for rows (verdict, score) of known verdicts; null unless both verdicts occur.

    Exact quantiles over counts of rounded scores, so neither the number of rows nor
    their order in partitions matters.
    """
    histogram = judged.groupBy("verdict", F.round("score", DIGITS).alias("score")).agg(F.count(F.lit(1)).alias("n"))
    quantile = lambda which, share: F.percentile(F.when(F.col("verdict") == which, F.col("score")), share, F.col("n"))
    low, high = histogram.agg(quantile("allow", MISSED), quantile("block", 1 - MISSED)).first()
    return None if low is None or high is None else (low + high) / 2


def _scores(grams: DataFrame, ratios: DataFrame, *more: str) -> DataFrame:
    """(page_id, line, score): mean ratio over the n-grams of a URL, one row for each id and line."""
    return grams.join(ratios, "gram").groupBy("page_id", "line", *more).agg(F.avg("ratio").alias("score"))
