import re

from data import documents, sentence

from ringlake.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_base_counts(spark):
    texts = [
        None, "", " \n\t", "one two three four five one two three four five", "a b c d e f a b c d e x a b c d e",
        "x " * 50, "line one\nline one\n\n \nline two\nline one", "# * $ % & | < > a b", sentence(1, 400) + " " + sentence(1, 30),
        "été ñ 🙂 漢字 " * 9, " nbsp stays a word ", "a a a a a a a",
    ]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r.doc_id: tuple(r.base) for r in quality.base_counts(docs.drop("base")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_verdict(spark):
    clean = [(i, " ".join(f"the word of {chr(97 + (i * 7 + j * j) % 26)}{'xyz'[j % 3]}er and" for j in range(40)), "en", "s") for i in range(60)]
    clean = [(i, sentence(i, 150).translate(str.maketrans("0123456789", "abcdefghij")), "en", "s") for i in range(60)]
    bad = [(100, " ".join(f"{w}$$$ ### %%%" for w in sentence(7, 150).split()), "en", "s"), (101, "too short", "en", "s"), (102, None, None, None)]
    got = {r.row.doc_id: r.kept for r in quality.judge(documents(spark, clean + bad)).collect()}
    assert all(got[i] for i in range(60)) and not any(got[i] for i in (100, 101, 102))


def test_rows_stay(docs, no_docs):
    judged = quality.judge(docs)
    assert judged.count() == docs.count()
    assert judged.select("row.*").columns == docs.columns
    assert quality.judge(no_docs).count() == 0


def test_divergence_against_brute_force(spark):
    import math

    rows = [(i, sentence(i, 200).translate(str.maketrans("0123456789", "abcdefghij")), "en", "s") for i in range(5)]
    got = {r.row.doc_id: r.class_distance for r in quality.judge(documents(spark, rows)).collect()}
    counts = {i: [len(re.findall(p, t)) for p in quality.CLASSES.values()] for i, t, _, _ in rows}
    every = [sum(c[k] for c in counts.values()) for k in range(len(quality.CLASSES))]
    for i, c in counts.items():
        p, q = [x / sum(c) for x in c], [x / sum(every) for x in every]
        m = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda u: sum(a * math.log2(a / b) for a, b in zip(u, m) if a)
        assert abs(got[i] - math.sqrt(max((kl(p) + kl(q)) / 2, 0))) < 1e-9


def test_class_counts(spark):
    """Characters of every class, broken bytes too, as counted one class at a time."""
    from pyspark.sql import functions as F

    texts = ["", "aB3 .#\u00e9", "x" * 50 + " Y\t\n9$$\\ []{}^~_`", "\U0001f642 \u6f22\u5b57 (a-b) 'c' \"d\"", "\x00\x07\x1f\x7f ok", sentence(3, 90)]
    broken = [b"a\xffb", b"\xe6\xbcZ\xe6", b"\xf0\x9f\x99 \xc0\xaf", b"\xed\xa0\x80q", b"\x80\x80A1"]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate([t.encode() for t in texts] + broken)], "i int, raw binary")
    rows = rows.select("i", F.col("raw").cast("string").alias("text"))
    by_one = F.array(*[F.regexp_count("text", F.lit(p)).cast("long") for p in quality.CLASSES.values()])
    found = rows.select("i", quality.class_counts(F.col("text")).alias("new"), by_one.alias("old"))
    got = {r.i: r for r in found.collect()}
    assert all(r.new == r.old for r in got.values())
    assert all(got[i].new == [len(re.findall(p, t)) for p in quality.CLASSES.values()] for i, t in enumerate(texts))
