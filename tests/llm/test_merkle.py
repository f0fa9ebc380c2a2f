"""The manifest against the same tree built in plain Python."""

import zlib
from hashlib import sha256

import pytest

from ringlake.llm import merkle
from data import documents, rows_of

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 8
        out.append((level[first:at], level[at + 1 : first + 8]))
        at //= 8
    return out


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {name: climb([leaf for _, _, leaf, _ in sorted(groups[name], key=lambda x: x[:3])]) for name in names}
    forest = climb([trees[n][-1][0] for n in names])
    out = []
    for place, name in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(sorted(groups[name], key=lambda x: x[:3])):
            path = siblings(trees[name], at) + siblings(forest, place)
            now = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])
                now = leaf_of((*row[:4], low))
            for left, right in path:
                now = h(*left, now, *right)
            proof = h(*[s for left, right in path for s in left + right])
            root = forest[-1][0]
            out.append((row[0], leaf, trees[name][-1][0], root, proof, now, now == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def many(n, langs):
    return [(i * 7 % n, f"s{i % 3}" if i % 5 else None, langs[i * i % len(langs)], i, f"Text {i} Ä" if i % 11 else None) for i in range(n)]


CASES = {
    "one": many(1, ["en"]),
    "eight": many(8, ["en"]),
    "nine": many(9, [None]),
    "groups": many(300, ["en", None, "de", "", "fr", "ä", "z", "1", "0", "a b"]),
    "superblocks": many(1500, ["en", "en", "en", "de"]),
    "a run of one": many(513, ["en"]),
    "repeats": many(40, ["en"]) * 3 + [(None, None, None, None, None)] * 20 + [(5, "x", "en", None, "Other")],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_equal_to_a_plain_tree(spark, name):
    found = merkle.audited(spark.createDataFrame(CASES[name], SCHEMA).repartition(3))
    assert rows_of(found, *COLUMNS) == expected(CASES[name])


def test_many_tables_of_superblocks(spark):
    """With superblocks of eight nodes: four tables above the leaves, two above the groups."""
    rows = many(700, ["en", "en", "de"]) + [(10_000 + i, None, f"l{i}", 1, "x") for i in range(20)]
    found = merkle.audited(spark.createDataFrame(rows, SCHEMA), levels=1)
    assert rows_of(found, *COLUMNS) == expected(rows)


def test_a_path_proves_its_leaf(spark):
    rows = many(600, ["en", "de"])
    for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA), with_path=True).collect():
        assert merkle.folded(r.leaf, r.path) == r.root == r.folded_root and r.verified


def test_any_change_shows(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(many(50, ["en", "de"]), SCHEMA)
    changed = merkle.manifest(rows, found={"source": F.lit("other")}, found_where=F.col("doc_id") == 7)
    assert [r.doc_id for r in changed.where("NOT verified").collect()] == [7]


def test_cases_and_clashing_names(spark, docs, no_docs):
    full = documents(spark).selectExpr("*", "length(text) AS n_chars", "1 AS grp", "2 AS at", "3 AS hash", "4 AS block", "5 AS path")
    given = [tuple(r) for r in full.select(*FIELDS).collect()]
    assert rows_of(merkle.audited(full), *COLUMNS) == expected(given)
    assert merkle.audited(full.limit(0)).collect() == []


def test_a_very_long_text(spark):
    rows = [(1, None, "en", 3_000_000, "Aé " * 1_000_000), (2, None, "en", 1, "x")]
    assert rows_of(merkle.audited(spark.createDataFrame(rows, SCHEMA)), *COLUMNS) == expected(rows)
