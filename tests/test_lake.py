"""Leaves, manifests and the catalog of a lake; packing landed hours; files of several types."""

from pyspark.sql import functions as F
import pytest

from helpers import bronze_rows, same_rows
from ringlake.sources import bronze, compaction
from ringlake.sources.lake import Lake, leaf_values

ROWS = [("a b", "x/y", 1), ("ä=é", None, 2), ("it's", "100%", 3), (None, "{z}", 4), ("a b", "x/y", 5)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "p string, q string, n int")


def test_names_of_partitions_come_back(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path))
    stored = lake.stage(rows, "db.t", ["p", "q"])
    assert sorted(stored.leaves.values()) == [1, 1, 1, 2]
    assert {(v["p"], v["q"]) for v in map(leaf_values, stored.leaves)} == {r[:2] for r in ROWS}
    lake.commit({"db.t": stored}, {"k": 1})
    again = Lake(spark, str(tmp_path))
    assert again.settings == {"k": 1} and again.tables["db.t"].rows() == 5
    assert same_rows(again.read("db.t"), rows)
    spark.sql("CREATE DATABASE IF NOT EXISTS lk")
    again.attach("db.t", "lk.t")
    assert same_rows(spark.table("lk.t").drop("lake_version"), rows)
    assert spark.table("lk.t").where("p = 'a b'").count() == 2


def test_folders_are_cut_out_of_paths_once_a_file(spark, rows, tmp_path, monkeypatch):
    """Rows are only counted by file; a leaf of several files adds up."""
    seen, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    many = rows.union(rows.where("p IS NULL")).union(rows.limit(0)).repartition(7)
    stored = Lake(spark, str(tmp_path)).stage(many, "t", ["p"])
    assert len(list(tmp_path.glob("t/*/*/*.parquet"))) > len(stored.leaves) == 4
    assert {leaf_values(leaf)["p"]: n for leaf, n in stored.leaves.items()} == {"a b": 2, "ä=é": 1, "it's": 1, None: 2}
    (counting,) = [p for p in seen if "input_file_name" in p]
    assert counting.count("Aggregate [") == 2 and "Project [regexp_replace" not in counting


def test_replaced_leaves_stay_until_they_are_forgotten(spark, rows, tmp_path):
    rows = rows.where("p IS NOT NULL")  # a brace would be read as a pattern in a single leaf's path
    lake = Lake(spark, str(tmp_path))
    lake.commit({"t": lake.stage(rows, "t", ["p"])})
    for turn in range(4):
        open_before = lake.read("t")
        new = lake.stage(spark.createDataFrame([("q", 10 + turn, "a b")], "q string, n int, p string"), "t", ["p"])
        kept = lake.tables["t"].where(lambda v: v["p"] != "a b")
        lake.commit({"t": kept.and_also(new)})
        assert open_before.count() == (5 - 1 if turn == 0 else 3)
        assert sorted(r.n for r in lake.read("t").collect()) == [2, 3, 10 + turn]
        assert {(r.p, r["rows"]) for r in lake.rewritten("t").collect()} == {("a b", 1)}
    assert len(list((tmp_path / "_manifests").glob("m-*.json"))) == 2
    assert len([p for p in tmp_path.glob("t/*/p=a b")]) == 2  # the current one and the one before


def test_empty_tables_and_counts_of_files(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.commit({"t": lake.stage(rows.limit(0), "t", ["p"]), "u": lake.stage(rows, "u")})
    again = Lake(spark, str(tmp_path))
    assert again.read("t").count() == 0 and again.read("t").columns == ["q", "n", "p"]
    assert again.tables["u"].rows() == 5 and again.read("u").count() == 5
    with pytest.raises(KeyError):
        again.read("v")
    lake.stage(rows, "w", ["p"])
    lake.discard()
    assert not list((tmp_path / "w").glob("*"))


# --- packing --------------------------------------------------------------------------
AT = "2024-01-15 03:00:00"


def _land(spark, base, ids, at=AT):
    bronze.land(bronze_rows(spark, *[{"subscription_id": f"VT{i}"} for i in ids]), base, F.to_timestamp(F.lit(at)))


def _found(spark, base, part=None):
    return sorted(r.subscription_id for r in bronze.scan(spark, base, part).collect())


def test_hours_are_packed_and_cleaned_up(spark, tmp_path):
    base = str(tmp_path / "raw")
    for batch in range(4):
        _land(spark, base, range(batch * 10, batch * 10 + 10))
    _land(spark, base, [90], "2024-01-16 05:00:00")  # a single file stays as it is
    names = sorted(f"VT{i}" for i in [*range(40), 90])
    files = lambda: {r.day: (r["rows"], r.files) for r in compaction.landed_files(spark, base).collect()}
    assert files() == {15: (40, 4), 16: (1, 1)}
    assert compaction.compact(spark, base) == 4
    assert files() == {15: (40, 1), 16: (1, 1)} and _found(spark, base) == names
    assert len(list((tmp_path / "raw").glob("year=*/**/*.parquet"))) == 5  # nothing is deleted yet
    assert compaction.compact(spark, base) == 0
    _land(spark, base, [50])
    _land(spark, base, [51])
    assert _found(spark, base) == sorted([*names, "VT50", "VT51"])
    assert compaction.vacuum(spark, base) == 4 and compaction.vacuum(spark, base) == 0
    assert _found(spark, base) == sorted([*names, "VT50", "VT51"])
    assert compaction.compact(spark, base, "year=2024/month=01/day=15") == 2
    assert files() == {15: (42, 1), 16: (1, 1)}
    compaction.vacuum(spark, base)
    assert _found(spark, base, "year=2024/month=01/day=15/hour=03") == sorted(set(names) - {"VT90"} | {"VT50", "VT51"})
    assert _found(spark, base, "day=16") == ["VT90"] and _found(spark, base, "year=1999") == []


def test_a_stopped_packing_changes_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "raw")
    _land(spark, base, [1, 2])
    _land(spark, base, [3])
    monkeypatch.setattr(Lake, "_put", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compaction.compact(spark, base)
    monkeypatch.undo()
    assert _found(spark, base) == ["VT1", "VT2", "VT3"]
    assert compaction.compact(spark, base) == 2 and _found(spark, base) == ["VT1", "VT2", "VT3"]


def test_files_of_the_target_size_stay(spark, tmp_path):
    base = str(tmp_path / "raw")
    _land(spark, base, range(5))
    _land(spark, base, range(5, 9))
    assert compaction.compact(spark, base, target_bytes=1000) == 0
    sizes = compaction.size_histogram(compaction.file_sizes(spark, base), 1000).first()
    assert (sizes.files, sizes.small_files) == (2, 0) and sizes.bytes > 2000


# --- files of several types -----------------------------------------------------------
def test_files_of_several_types_in_one_hour(spark, tmp_path):
    """Two columns, each null-typed in some files, in all four mixtures, and a file without the column."""
    base, want = str(tmp_path / "raw"), []
    for k, (reason, limit) in enumerate([(True, True), (True, False), (False, True), (False, False)]):
        rows = bronze_rows(spark, {"subscription_id": f"VT{k}", "anomaly_reason": "r" if reason else None, "daily_limit_mb": 7 if limit else None})
        if not reason:
            rows = rows.withColumn("anomaly_reason", F.lit(None).cast("int"))
        if not limit:
            rows = rows.withColumn("daily_limit_mb", F.lit(None).cast("int"))
        bronze.land(rows, base, F.to_timestamp(F.lit(AT)))
        want.append((f"VT{k}", "r" if reason else None, 7 if limit else None))
    bronze.land(bronze_rows(spark, {"subscription_id": "VT9"}).drop("anomaly_reason"), base, F.to_timestamp(F.lit(AT)))
    want.append(("VT9", None, 1024))
    rows = bronze.scan(spark, base, conform=True)
    assert rows.schema == bronze.BRONZE_SCHEMA or rows.dtypes == [(f.name, f.dataType.simpleString()) for f in bronze.BRONZE_SCHEMA]
    assert sorted((r.subscription_id, r.anomaly_reason, r.daily_limit_mb) for r in rows.collect()) == want
    files = [f for f in spark.read.schema(bronze.BRONZE_SCHEMA).parquet(base).inputFiles()]
    assert len(files) == 5 and len(bronze.type_groups(spark, base, files)) <= 5
    assert bronze.scan(spark, base, "year=2024/month=01/day=15/hour=03", conform=True).count() == 5


def test_files_of_one_writer_are_halved(spark, tmp_path, monkeypatch):
    """Names tell nothing here: all files look like those of one job."""
    types = {f"f{i}": {"a": "int" if i in (3, 4, 9) else "string"} for i in range(12)}

    def merged(spark, base, paths):
        seen = {types[p]["a"] for p in paths}
        return {"a": seen.pop()} if len(seen) == 1 else None

    monkeypatch.setattr(bronze, "_merged", merged)
    monkeypatch.setattr(bronze.re, "search", lambda *a: {1: "one"})
    groups = bronze.type_groups(spark, "", list(types))
    assert sorted(sorted(g) for g in groups) == [sorted(f for f in types if types[f]["a"] == k) for k in ("string", "int")]
