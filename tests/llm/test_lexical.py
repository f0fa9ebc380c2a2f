"""Ranked search against a plain loop over all documents and items."""

from collections import Counter
import math
import random
import re

import numpy as np
import pytest

from ringlake.llm import lexical
from data import documents, rows_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, k=20):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n, total = sum(size > 0 for *_, size in held), sum(size for *_, size in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    out = []
    for item, text in items:
        found = []
        for d, counts, size in held:
            m = 100 - 25 + 25 * size * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in terms(text) if t in counts
            )
            if score:
                found.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n, words, most=60):
    draw = random.Random(seed)
    weights = [1 / (i + 1) for i in range(words)]
    return [(i * 17 % n, " ".join(draw.choices([f"W{w}é" if w % 7 == 0 else f"w{w}" for w in range(words)], weights, k=draw.randrange(most)))) for i in range(n)]


def check(spark, docs, items, **options):
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    found = lexical.ranked(a, b, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found, *found.columns) == expected(docs, items, options.get("k", 20))


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_a_plain_loop(spark, seed):
    docs = corpus(seed, 900, 300)
    docs += [(5000 + i, docs[3][1]) for i in range(40)]  # copies: ties by id
    check(spark, docs, corpus(seed + 10, 12, 300, 12) + [(90, "W0é w1 w1, w1!"), (91, None), (92, "nowhere"), (93, "")])


def test_blocks_of_items_and_a_short_list(spark):
    check(spark, corpus(3, 200, 60), corpus(4, 9, 60, 10), block_terms=15, k=3)


def test_cases_and_repeated_ids(spark, no_docs):
    docs = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    items = [(1, "the of AND to"), (1, "the of AND to"), (None, "été 漢字 shout"), (2, docs[0][1])]
    full = documents(spark)
    found = lexical.ranked(full, spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(found, *found.columns) == expected(docs, items)
    some = spark.createDataFrame(items, "item_id long, text string")
    assert lexical.ranked(no_docs, some).collect() == [] and lexical.ranked(full, some.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, " ,. ")], "doc_id long, text string")
    assert lexical.ranked(blank, some).collect() == []


def test_a_very_long_text(spark):
    check(spark, [(1, "a b c " * 300_000), (2, "a x"), (3, "b")], [(1, "a b"), (2, "x c")])


def test_bounds_leave_out_only_what_is_below():
    """Survivors hold every row at the bound, and most others are left out."""
    draw = np.random.default_rng(8)
    lists = []
    for _ in range(400):
        t = np.sort(draw.choice(200, draw.integers(1, 60), replace=False))
        lists.append((t, draw.integers(1, 1_000_000, len(t))))
    norms = np.sqrt([float((i.astype(float) ** 2).sum()) for _, i in lists])
    bucket = lexical.Bucket(lists, norms, 200)
    left_out = 0
    for _ in range(30):
        term = draw.choice(200, 25, replace=False)
        w = np.sort(draw.integers(1, 5000, 25) ** 2)[::-1]
        dense = np.zeros(200, dtype=np.int64)
        dense[term] = w
        scores = bucket.scores(np.arange(400), dense)
        assert scores.tolist() == [int((dense[t] * i).sum()) for t, i in lists]
        bound = int(np.sort(scores)[-20])
        kept = bucket.survivors(term, w, bound)
        assert set(np.flatnonzero(scores >= bound)) <= set(kept)
        left_out += 400 - len(kept)
    assert left_out > 30 * 50  # of 380, for vectors that have nothing in common


def test_a_short_bucket_is_skipped(monkeypatch):
    items = lexical.Items([(0, 0, 5), (0, 1, 3)], 2)
    long = lexical.Bucket([(np.array([0, 1]), np.array([100, 100]))] * 3, np.full(3, math.sqrt(20000)), 2)
    short = lexical.Bucket([(np.array([0]), np.array([1]))], np.ones(1), 2)
    monkeypatch.setattr(short, "survivors", None)  # would raise if it were looked into
    ((item, best),) = lexical.searched(iter([(long, np.array([4, 2, 9])), (short, np.array([1]))]), items, 2, {})
    assert (item, best.key.tolist(), best.score.tolist()) == (0, [2, 4], [800, 800])
