import pytest
from data import documents, rows_of, sentence

from ringlake.llm import mixing


def test_budgets_are_met(spark, docs):
    out = mixing.mix(docs, keep=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "taken").collect()
    assert len(out) == docs.count()
    by_source = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        entry = by_source.setdefault(r.source, [0, r.target, r.source_size])
        entry[0] += r.taken
    total = sum(size for _, _, size in by_source.values())
    assert abs(sum(taken for taken, _, _ in by_source.values()) - total) <= len(by_source)
    for taken, target, size in by_source.values():
        assert target - 1 < taken <= target and target <= 3 * size


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), ("c", 100, 1), (None, 5, 1)], "source string, source_size long, source_rows long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights 5, 2, 1, 5 over 1115 words: a, c and null stop at three times their size.
    assert got == {"a": 30.0, "c": pytest.approx((1115 - 45) / 3), None: 15.0, "b": pytest.approx(2 * (1115 - 45) / 3)} or sum(got.values()) == pytest.approx(1115)
    assert got["a"] == 30.0 and got[None] == 15.0


def test_ranges_do_not_change_anything(spark, docs):
    columns = ["row.doc_id", "size", "target", "taken"]
    assert rows_of(mixing.mix(docs, keep=["doc_id"], range_rows=1), *columns) == rows_of(mixing.mix(docs, keep=["doc_id"]), *columns)


def test_many_sources_take_the_plain_join(spark, docs, monkeypatch):
    expected = rows_of(mixing.mix(docs, keep=["doc_id"]), "row.doc_id", "taken")
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert rows_of(mixing.mix(docs, keep=["doc_id"]), "row.doc_id", "taken") == expected


def test_ids_that_many_rows_share_are_cut_again(spark, monkeypatch):
    rows = [(None if i % 3 else i, sentence(i, 5 + i % 4), "en", "ab"[i % 5 == 0]) for i in range(400)]
    rows += [(7, "one and the same", "en", "a")] * 60 + [(8, None, "en", "a")] * 60
    docs = documents(spark, rows)
    columns = ["row.doc_id", "size", "source_size", "target", "taken"]
    whole = rows_of(mixing.mix(docs, keep=["doc_id"], range_rows=10_000), *columns)
    assert rows_of(mixing.mix(docs, keep=["doc_id"], range_rows=4), *columns) == whole
    cut = mixing._cut_again
    pieces = []
    monkeypatch.setattr(mixing, "_cut_again", lambda *a: pieces.append(cut(*a)) or pieces[-1])
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert rows_of(mixing.mix(docs, keep=["doc_id"], range_rows=4), *columns) == whole
    assert pieces and pieces[0].count() > 300


def test_the_mix_itself(spark):
    rows = [(i, sentence(i, 10 + i), "en", "abc"[i % 3]) for i in range(30)]
    docs = documents(spark, rows)
    wanted = {r.row.doc_id: r.taken for r in mixing.mix(docs, keep=["doc_id"]).collect()}
    got = {}
    for r in mixing.mixed_documents(docs).collect():
        assert rows[r.doc_id][1].startswith(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {k: v for k, v in wanted.items() if v}


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
