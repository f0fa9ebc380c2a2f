import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import CLOCK, DEFAULTS, bronze_rows, plan, same_rows, silver_rows
from ringlake.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA, SILVER_COLUMNS
from ringlake.sources import bronze, jdbc, scratch, tables


def _landed(spark, tmp_path):
    base = str(tmp_path / "raw")
    rows = bronze_rows(
        spark,
        {"created_at": "2024-01-10T03:05:00"}, {"created_at": "2024-01-10T03:45:00"},
        {"created_at": "2024-02-01T23:00:00"}, {"created_at": "2025-12-31T00:00:00"},
    )
    bronze.land(rows, base, F.to_timestamp("created_at"))
    return rows, base


def test_landing_layout_and_scan(spark, tmp_path):
    rows, base = _landed(spark, tmp_path)
    folders = {os.path.relpath(os.path.dirname(f), base) for f in glob.glob(f"{base}/**/*.parquet", recursive=True)}
    assert folders == {
        "year=2024/month=01/day=10/hour=03", "year=2024/month=02/day=01/hour=23", "year=2025/month=12/day=31/hour=00",
    }
    back = bronze.scan(spark, base)
    assert same_rows(back.select(*BRONZE_COLUMNS), rows)
    assert {tuple(r) for r in back.select("year", "month", "day", "hour", "minute").collect()} == {
        (2024, 1, 10, 3, 5), (2024, 1, 10, 3, 45), (2024, 2, 1, 23, 0), (2025, 12, 31, 0, 0),
    }


def test_landing_appends_at_the_current_time(spark, tmp_path):
    base = str(tmp_path / "raw")
    for _ in range(2):
        bronze.land(bronze_rows(spark, {}), base)
    back = bronze.scan(spark, base)
    assert back.count() == 2
    assert back.select(F.make_date("year", "month", "day") >= F.date_sub(F.current_date(), 1)).first()[0]


def test_date_filter_prunes_folders(spark, tmp_path):
    _, base = _landed(spark, tmp_path)
    part = bronze.scan(spark, base, "year=2024/month=01/")
    assert part.count() == 2
    assert {os.path.dirname(f).rsplit("raw/", 1)[1] for f in part.inputFiles()} == {"year=2024/month=01/day=10/hour=03"}
    late = bronze.scan(spark, base, "day=31")  # no leading step: a predicate on partitions
    scan = next(line for line in plan(late).splitlines() if "FileScan" in line)
    assert late.count() == 1 and "day#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    for wrong in ("2024-01", "minute=3", "year"):
        with pytest.raises(ValueError):
            bronze.scan(spark, base, wrong)


def test_scan_reads_needed_columns_only(spark, tmp_path):
    _, base = _landed(spark, tmp_path)
    explained = plan(bronze.scan(spark, base).where("status = 'active'").select("zone"))
    assert "ReadSchema: struct<status:string,zone:string>" in explained
    assert "EqualTo(status,active)" in explained


def test_merge_schema(spark, tmp_path):
    base = str(tmp_path / "raw")
    at = F.to_timestamp("created_at")
    bronze.land(bronze_rows(spark, {"subscription_id": "VT1"}).drop("anomaly_reason"), base, at)
    extra = bronze_rows(spark, {"subscription_id": "VT2", "anomaly_reason": "x"}).withColumn("note", F.lit("new"))
    bronze.land(extra, base, at)
    merged = bronze.scan(spark, base, merge_schema=True)
    assert {(r.subscription_id, r.anomaly_reason, r.note) for r in merged.collect()} == {("VT1", None, None), ("VT2", "x", "new")}


def test_files_of_other_writers(spark, tmp_path):
    """Partition fields inside the file as well, and a null-typed column in one batch."""
    base = str(tmp_path / "raw")
    for month, reason in ((1, None), (2, "x")):
        folder = f"{base}/year=2024/month={month:02d}/day=03/hour=04"
        os.makedirs(folder)
        row = {**DEFAULTS, "anomaly_reason": reason, "year": 2024, "month": month, "day": 3, "hour": 4, "minute": 5}
        pq.write_table(pa.Table.from_pylist([row]), f"{folder}/batch.parquet")
    typed = bronze.scan(spark, base, "year=2024/month=02")
    assert typed.select("anomaly_reason", "month", "minute").collect() == [("x", 2, 5)]
    empty = bronze.scan(spark, base, "year=2024/month=01", conform=True)
    assert empty.schema == typed.schema
    assert {(r.month, r.anomaly_reason) for r in typed.unionByName(empty).collect()} == {(1, None), (2, "x")}


def test_only_the_filtered_folder_is_listed(spark, tmp_path):
    _, base = _landed(spark, tmp_path)
    os.makedirs(f"{base}/year=2023/odd=1")
    with open(f"{base}/year=2023/odd=1/x.parquet", "w") as file:
        file.write("no parquet")
    assert bronze.scan(spark, base, "year=2024/month=01").count() == 2
    assert bronze.scan(spark, base, "year=2024/month=01/day=11").count() == 0
    assert bronze.scan(spark, base, "year=2024/month=01").columns == [f.name for f in BRONZE_SCHEMA]


def test_replace_then_append(spark, tmp_path):
    silver = silver_rows(spark, {}, {"zone": None, "package_type": "daily"}, {"activation_date": None})
    path = str(tmp_path / "silver")
    for _ in range(2):
        tables.replace_silver(silver, "t_replace", path)
    back = tables.read_silver(spark, "t_replace")
    assert back.columns == SILVER_COLUMNS and same_rows(back, silver)
    assert os.path.isdir(f"{path}/package_type=combo/zone=north/activation_year=2024")
    tables.append_silver(silver, "t_replace")
    assert tables.read_silver(spark, "t_replace").count() == 6
    pruned = tables.read_silver(spark, "t_replace").where("zone = 'north'")
    assert "zone" in plan(pruned).split("PartitionFilters: [")[1].split("]")[0]


def test_v2_catalog_is_recognised_by_configuration(spark):
    assert not tables.has_v2_catalog(spark, "silver.subscriptions")
    assert not tables.has_v2_catalog(spark, "lake.silver.subscriptions")
    spark.conf.set("spark.sql.catalog.lake", "org.example.Catalog")
    try:
        assert tables.has_v2_catalog(spark, "lake.silver.subscriptions")
    finally:
        spark.conf.unset("spark.sql.catalog.lake")


class _Recorder:
    """Stands in for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def record(*args, **kwargs):
            self.told[name] = args or kwargs
            return self

        return record


def test_jdbc_options():
    target = jdbc.JdbcTarget("jdbc:x://host/db", "public.t", {"user": "u"}, connections=4, batch_rows=50)
    frame = type("Frame", (), {"write": _Recorder()})()
    jdbc.overwrite(frame, target)
    told = frame.write.told
    assert told["mode"] == ("overwrite",) and told["jdbc"] == ("jdbc:x://host/db", "public.t")
    assert told["options"] == {
        "user": "u", "numPartitions": "4", "batchsize": "50", "fetchsize": "50", "truncate": "false",
    }
    session = type("Session", (), {"read": _Recorder()})()
    jdbc.read(session, target, "activation_date", "2023-01-01", "2024-01-01")
    options = session.read.told["options"]
    assert options["partitionColumn"] == "activation_date" and options["numPartitions"] == "4"
    assert (options["lowerBound"], options["upperBound"]) == ("2023-01-01", "2024-01-01")
    session = type("Session", (), {"read": _Recorder()})()
    jdbc.read(session, target)
    assert "numPartitions" not in session.read.told["options"]


def test_jdbc_write_reaches_the_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.overwrite(silver_rows(spark, {}), jdbc.JdbcTarget("jdbc:nosuchdb://host/db", "t"))


def test_scratch_uses_the_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            settings = {"spark.checkpoint.dir": "/shared/ckpt/"}

            @classmethod
            def get(cls, key, default=None):
                return cls.settings.get(key, default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "app"

    assert scratch.shared_folder(Session) == "/shared/ckpt"
    Session.conf.settings = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session)


def test_written_rows_and_size(spark):
    rows = silver_rows(spark, {}, {"zone": None})
    kept = scratch.written(rows, "check")
    assert same_rows(kept, rows) and kept.columns == rows.columns
    assert CLOCK.now == kept.first().last_updated


def test_scratch_folders_go(spark):
    first = scratch.shared_folder(spark)
    assert scratch.shared_folder(spark) == first
    with scratch.scope(spark):
        kept = scratch.written(silver_rows(spark, {}), "check")
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
