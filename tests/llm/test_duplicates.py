import hashlib
import random

import numpy as np
import pytest
from data import documents, rows_of, sentence

import corpus_pipeline
from ringlake.llm import components, embeddings, minhash, repeats


def cut(rows):
    """Distinct (id, text) in corpus order to (removed, spans, digest), by brute force."""
    from pyspark.sql import SparkSession, functions as F

    spark = SparkSession.getActiveSession()
    ties = {r.text: r.tie for r in spark.createDataFrame([(t,) for _, t in rows], "text string").select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).collect()}
    seen, out = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: (-1 if r[0] is None else r[0], ties[r[1]])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(raw[i : i + 100])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[doc, text] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def messy_rows():
    rng = random.Random(5)
    passages = [sentence(i, 40) for i in range(4)]
    rows = [(None, passages[0]), (1, None), (2, ""), (3, "a" * 99), (4, "a" * 350), (5, "ab" * 300), (6, "ba" * 120)]
    for i in range(10, 45):
        parts = [sentence(100 + i, rng.randrange(3, 60)), rng.choice(passages)[rng.randrange(60) :], sentence(200 + i % 5, rng.randrange(3, 30)), rng.choice(passages)]
        rng.shuffle(parts)
        rows.append((i, " été🙂 ".join(parts)))
    rows += [(20, rows[25][1]), (20, rows[25][1]), (50, rows[-1][1]), (51, rows[-1][1] + "x")]
    return rows


@pytest.mark.parametrize("bucket", [repeats.BUCKET_PHRASES, 1])
@pytest.mark.parametrize("block", [repeats.BLOCK_BYTES, 1])
def test_repeats_against_brute_force(spark, bucket, block):
    rows = messy_rows()
    wanted = cut(rows)
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    got = repeats.remove_repeats(docs, bucket_phrases=bucket, block_bytes=block).collect()
    assert sum(r.times for r in got) == len(rows) and len(got) == len(set((i, t or "") for i, t in rows))
    shown = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None)
    assert shown == sorted((k[0], *v) for k, v in wanted.items() if k[0] is not None)


def test_texts_without_repeats(spark, docs, no_docs):
    out = repeats.without_repeats(docs)
    assert out.count() == docs.count() and out.columns == docs.columns
    assert repeats.remove_repeats(no_docs).count() == 0 and repeats.without_repeats(no_docs).count() == 0
    text = {r.doc_id: r.text for r in out.collect()}
    first = next(r.text for r in docs.collect() if r.doc_id == 1)
    assert text[1] == first and text[2] == "" and len(text[3]) < 110


def test_characters_cut_in_part(spark):
    shared, head = sentence(7, 30), sentence(8, 30)
    rows = [(1, shared + "é one", "fr"), (2, shared + "è two", "fr"), (3, "Ю" + head, "ru"), (4, "о " + "ή" + head, "ru"), (5, "漢" + shared + "漣 tail 🙂" + head, "zh")]
    seen, wanted = set(), {}
    for doc, text, _ in rows:
        raw, gone = text.encode(), set()
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone.update(range(i, i + 100))
            seen.add(raw[i : i + 100])
        at, kept = 0, ""
        for c in text:
            n = len(c.encode())
            kept += "" if gone.intersection(range(at, at + n)) else c
            at += n
        wanted[doc] = kept
    docs = documents(spark, [(i, t, k, "s") for i, t, k in rows])
    assert {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()} == wanted
    assert wanted[2] == " two" and wanted[5].startswith("漢")


def test_every_string_has_one_trigger():
    texts = [(t or "").encode() for _, t in messy_rows()]
    parsed, offsets = repeats.Parsed(texts), {}
    covered = [0] * len(texts)
    for doc, low, high, place in zip(parsed.doc, parsed.low, parsed.high, parsed.place):
        covered[doc] += high - low + 1
        for start in range(low, high + 1):
            assert offsets.setdefault(texts[doc][start : start + 100], place - start) == place - start
    assert covered == [max(0, len(t) - 99) for t in texts]


def groups(texts, size, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    least = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a & b and 100 * len(a & b) >= percent * len(a | b) and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least, [len(s) for s in sets]


def near_rows():
    rng = random.Random(3)
    texts = [None, "", " \n", "One two", "one  TWO", "a b c d", "A B\tc D"]
    for g in range(6):
        words = sentence(g, 90).split()
        for _ in range(7):
            copy = list(words)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(90)] = f"new{rng.randrange(1000)}"
            texts.append(" ".join(copy))
    return texts + [sentence(50 + i, 80) for i in range(10)]


@pytest.mark.parametrize("block, shingles", [(minhash.BLOCK, minhash.BLOCK_SHINGLES), (2, minhash.BLOCK_SHINGLES), (minhash.BLOCK, 150)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block, shingles):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    texts = near_rows()
    least, sizes = groups(texts, 4, 80)
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = rows_of(minhash.near_duplicates(docs, size=4), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(((i, sizes[i], least[i], least[i] == i) for i in range(len(texts))), key=repr)


def test_templates_below_the_threshold_make_no_pair_rows(spark):
    """500 texts of which any two share some 70 %: nothing is linked, and no table has more rows than there are bands of nodes."""
    base, rng = sentence(70, 400).split(), random.Random(9)
    texts = []
    for i in range(500):
        words = list(base)
        for at in rng.sample(range(0, 400, 5), 9):
            words[at] = f"own{i}x{at}"
        texts.append(" ".join(words))
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for t in texts[:20]]
    likeness = [len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]]
    assert 0.6 < min(likeness) and max(likeness) < 0.8
    rows, plain = [], minhash.written
    minhash.written = lambda df, label, *a: rows.append((label, (out := plain(df, label, *a)).count())) or out
    try:
        got = minhash.near_duplicates(docs).collect()
    finally:
        minhash.written = plain
    assert all(r.kept and r.component_id == r.doc_id for r in got) and len(got) == 500
    assert dict(rows)["families"] == 500  # they do come near each other
    assert max(n for _, n in rows) <= 500 * minhash.BANDS


def test_a_bridge_and_a_chain(spark):
    """Neighbours of a chain are linked, its ends are not; all of them are one component, in blocks of two as well."""
    words = sentence(80, 120).split()
    chain = [" ".join(words[: 100 - 6 * i] + [f"n{j}" for j in range(6 * i)]) for i in range(9)]
    texts = [sentence(81, 90), *chain, sentence(82, 90)]
    least, sizes = groups(texts, 5, 80)
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    assert rows_of(minhash.near_duplicates(docs), "doc_id", "component_id") == sorted(enumerate(least), key=repr)
    assert least[9] == 1


def test_near_duplicates_odd_rows(docs, no_docs):
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    assert minhash.near_duplicates(docs).count() == docs.count() and minhash.near_duplicates(no_docs).count() == 0
    assert [got[i].component_id for i in (1, 2, 3, 4, 5, 6, 9)] == [1, 1, 1, 4, 5, 6, 9] and got[None].kept


def test_texts_that_share_an_id(spark):
    base, other, third = sentence(60, 80), sentence(61, 80), sentence(62, 80)
    texts = [(None, base), (None, other), (None, other), (7, third), (7, base + " end"), (8, third + " end"), (8, sentence(63, 80)), (9, other + " end")]
    docs = documents(spark, [(i, t, "en", "s") for i, t in texts])
    got = rows_of(minhash.near_duplicates(docs), "doc_id", "component_id", "kept")
    wanted = [(None, None, True)] * 3 + [(7, 7, True), (7, None, False), (8, 7, False), (8, 8, True), (9, None, False)]
    assert got == sorted(wanted, key=repr)
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert rows_of(left, "doc_id", "text") == sorted([(None, base), (None, other), (7, third), (8, texts[6][1])], key=repr)
    assert left.columns == docs.columns


def test_odd_sketches_estimate():
    rng = np.random.default_rng(1)
    for share in (0.95, 0.85, 0.8):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 1 << 62, 400).astype(np.uint64)
            n = int(400 * share)
            rest = int((400 / share - 400) / 2)
            a = np.unique(np.concatenate([both[:n], rng.integers(0, 1 << 62, max(rest, 0)).astype(np.uint64)]))
            b = np.unique(np.concatenate([both[:n], rng.integers(0, 1 << 62, max(rest, 0)).astype(np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            x, y = (np.frombuffer(minhash.odd_sketch(minhash.samples(s)), "<u8") for s in (a, b))
            errors.append(float(minhash.estimate(np.bitwise_count(x ^ y).sum())) - true)
        assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.16


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7), (300, 300), (5, 3), (5, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 150: 100, 200: 100, 300: 300}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vector_rows():
    rng = np.random.default_rng(2)
    rows = []
    for label in (0, 1, 2):
        for c in rng.normal(size=(30, 16)):
            for _ in range(4):
                rows.append(((c + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.3])).astype(np.float32).tolist(), label))
    tight = rng.normal(size=16)
    rows += [((tight + rng.normal(size=16) * 0.01).astype(np.float32).tolist(), 1) for _ in range(150)]
    rows += [(rows[0][0], 0), (rows[0][0], 1), (rows[0][0], None), (None, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([None] + [1.0] * 15, 1), ([], 1), ([float("inf")] * 16, 1)]
    return [(i, v, k) for i, (v, k) in enumerate(rows)]


@pytest.mark.parametrize("shard", [embeddings.SHARD, 40])
def test_embeddings_against_brute_force(spark, monkeypatch, shard):
    if shard == 40:  # in this process only; tasks fit by the number of centroids they are given
        monkeypatch.setattr(embeddings, "SHARD", shard)
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS node", "2 AS path", "'x' AS vector")
    links, least = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}
    sound = [(i, np.array(v, dtype=float), k) for i, v, k in rows if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    pairs = [(i, j) for i, u, k in sound for j, w, m in sound if i != j and k == m and u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= 0.93]
    for i, _ in pairs:
        links[i] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if least[j] < least[i]:
                least[i], changed = least[j], True
    got = rows_of(embeddings.near_embeddings(frame), "vec_id", "n_links", "component_id", "kept")
    wanted = sorted(((i, links[i], least[i], least[i] == i) for i in links), key=repr)
    missed = sum(a[1] != b[1] for a, b in zip(got, wanted))
    assert [g[0] for g in got] == [w[0] for w in wanted] and all(g[1] <= w[1] for g, w in zip(got, wanted))
    assert got == wanted if shard != 40 else missed <= 0.02 * len(wanted)


def test_a_large_group_of_near_equal_vectors(spark):
    """3000 near-equal and 1000 other vectors of one label, with a second group at the edge of the first one's range."""
    rng = np.random.default_rng(6)
    tight, other = rng.normal(size=32), rng.normal(size=32)
    other -= tight * (other @ tight) / (tight @ tight)
    edge = tight / np.linalg.norm(tight) * 0.93 + other / np.linalg.norm(other) * np.sqrt(1 - 0.93**2)
    x = np.concatenate([
        tight + rng.normal(size=(3000, 32)) * 0.02, edge * np.linalg.norm(tight) + rng.normal(size=(300, 32)) * 0.05,
        rng.normal(size=(700, 32)),
    ]).astype(np.float32)
    x = x[rng.permutation(len(x))]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = u @ u.T >= 0.93
    links = linked.sum(axis=1) - 1
    least = np.arange(len(u))
    while True:
        new = np.where(linked, least[None, :], len(u)).min(axis=1)
        if (new == least).all():
            break
        least = new
    frame = spark.createDataFrame([(i, v, 5) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    got = rows_of(embeddings.near_embeddings(frame), "vec_id", "n_links", "component_id")
    assert got == sorted(((i, int(links[i]), int(least[i])) for i in range(len(u))), key=repr)
    assert links.max() >= 2999 and ((links > 0) & (links < 2999)).any()


def test_embeddings_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_embeddings(frame).count() == 0


def test_pruned_lists_follow_the_rule():
    x = np.random.default_rng(4).normal(size=(60, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = np.linalg.norm(x[:, None] - x[None], axis=2)
    lists = embeddings.pruned_lists(x)  # the pool is all rows here
    for p in range(60):
        alive, kept = [q for q in np.argsort(away[p]) if q != p], []
        while alive and len(kept) < embeddings.DEGREE:
            kept.append(alive.pop(0))
            alive = [q for q in alive if embeddings.ALPHA * away[kept[-1], q] > away[p, q]]
        assert [int(q) for q in lists[p] if q >= 0] == [int(q) for q in kept]
