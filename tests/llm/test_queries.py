"""The registered queries over whole tables, and the pipeline stage by stage."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ringlake.llm import minhash, mixing, quality, repeats
from ringlake.llm.oracle import ORACLE_SQL
from ringlake.llm.queries import QUERIES
from ringlake.sources.scratch import written

FOLDER = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "conversations", "benchmark"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = duck.execute(ORACLE_SQL[name])
    names = sorted(d[0] for d in result.description)
    order = [[d[0] for d in result.description].index(n) for n in names]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == names
    assert Counter(tuple(r) for r in df.select(*names).collect()) == theirs


def test_chats_with_ties_and_nulls_as_sql(spark, tmp_path):
    rows = [
        (1, 0, "user", "b"), (1, 0, "user", "<|turn|>"), (1, 0, "user", "<~"), (1, 0, None, "x"), (1, None, "assistant", "late"),
        (1, 0, "assistant", None), (1, 0, "assistant", "␛"), (1, 0, "assistant", "</s>"), (1, 0, "assistant", "</t"), (1, 0, "assistant", "b"),
        (2, None, None, None), (2, None, None, None), (None, 1, "assistant", "y"), (None, None, "assistant", "z"),
    ]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    result = duck.execute(ORACLE_SQL["op3_chat_parts"])
    names = [d[0] for d in result.description]
    assert Counter(tuple(r) for r in QUERIES["op3_chat_parts"](spark, str(tmp_path)).select(*names).collect()) == Counter(result.fetchall())


CLASHING = ["doc", "tie", "row", "__doc", "__tie", "__kept", "size", "key", "taken", "n_bytes", "component", "kept", "tags"]


def test_stages_with_odd_rows(spark):
    """Nulls, empty, long, tied and repeated rows, and columns named like the operators' own, one of them a map."""
    plain = "a quick check of plain words that nobody else wrote down before number {} in this small table of texts with some more words"
    passage = " ".join(f"shared{i}" for i in range(60))
    texts = [None, "", " ", plain.format(1), plain.format(1), plain.format(2) + " " + passage, passage + " " + plain.format(3), " ".join(f"w{i % 4001}" for i in range(9000))]
    rows = [(None if i % 3 == 2 else i // 2, [None, "web", "book"][i % 3], ["en", None][i % 2], None if t is None else len(t), t) for i, t in enumerate(texts * 2)]
    given = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    extra = {name: F.lit(name) for name in CLASHING[:-1]}
    given = given.withColumns(extra).withColumn("tags", F.create_map(F.lit("k"), F.lit("v")))
    for docs, some in ((given, True), (given.limit(0), False)):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, FOLDER), "stage")
            assert (out.count() > 0) == some, name
            if name != "best-fit packing":
                assert out.columns == given.columns, name
                assert out.where("tags['k'] <> 'v' OR size <> 'size' OR __doc <> '__doc'").count() == 0, name
            # The quality rules take most of these rows; the other stages see all of them.
            docs = docs if name == "quality rules" else out


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark):
    docs = given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "stage")
        kept.append(docs)
    rules, unique, cut, mixed, packed = kept
    for stage in kept[:-1]:
        assert stage.columns == given.columns and stage.schema == given.schema
    judged = quality.judge(given)
    assert rules.count() == judged.where("kept").count() < given.count()
    assert unique.count() == minhash.near_duplicates(rules).where("kept").count() < rules.count()
    assert minhash.near_duplicates(unique).where("NOT kept").count() == 0
    assert cut.count() == unique.count()
    whole = {r.doc_id: len((r.text or "").encode()) for r in unique.collect()}
    for r in repeats.remove_repeats(unique).collect():
        assert r.n_bytes == whole[r.doc_id]
    assert sum(len((r.text or "").encode()) for r in cut.collect()) < sum(whole.values())
    taken = {r.row.doc_id: r.taken for r in mixing.mix(cut, keep=["doc_id"]).collect()}
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert sum(got.values()) == sum(taken.values())
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    assert packed.where("piece = 0").count() == mixed.count()
    used = packed.selectExpr("sum(length)", "count(DISTINCT sequence_id)").first()
    assert used[1] <= -(-used[0] // 4096) + 1
