"""Packing the many small files of landed hours into few of a target size.

Packed rows are written beside the tree, below a folder that listings skip.  One manifest
then says both what was packed and which landed files it replaces (``Lake``), so a
reader (``bronze.scan``) finds every row once, before, between and after.  The replaced
files go later, with ``vacuum``, when no reader has them open and the file stream has
taken them.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ringlake.schemas import BRONZE_SCHEMA, LANDING_PARTITIONS
from ringlake.sources.bronze import PACKED, filter_steps, packed_root, partition_predicate, relative, scan
from ringlake.sources.lake import Lake, Stored
from ringlake.sources.scratch import written

TARGET_BYTES = 128 << 20


def file_sizes(spark: SparkSession, base: str, date_filter: str | None = None) -> DataFrame:
    """(year, month, day, hour, file, bytes) of the landed files; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base)
    )
    file = relative(F.col("path"))
    steps = [F.regexp_extract("file", rf"(?:^|/){c}=(\d+)", 1).cast("int").alias(c) for c in LANDING_PARTITIONS]
    sizes = listed.select(file.alias("file"), F.col("length").alias("bytes")).where("file <> ''").select(*steps, "file", "bytes")
    return sizes.where(partition_predicate(date_filter)) if filter_steps(date_filter) else sizes


def size_histogram(sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Files, bytes, and files below half of the target, per landed hour."""
    small = F.col("bytes") * 2 < target_bytes
    return sizes.groupBy(*LANDING_PARTITIONS).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.count_if(small).alias("small_files"),
        F.coalesce(F.sum(F.when(small, F.col("bytes"))), F.lit(0)).alias("small_bytes"),
    )


def compact(spark: SparkSession, base: str, date_filter: str | None = None, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the files below half of the target of all hours that have two or more; returns how many files went in.

    Hours that were packed before are packed again with what has landed since.  Name a
    part that is no longer landed in; its small files are listed on the driver.
    """
    root = packed_root(base)
    lake = Lake(spark, root)
    replaced = set(lake.settings.get("replaced", []))
    sizes = file_sizes(spark, base, date_filter)
    if replaced:
        sizes = sizes.join(spark.createDataFrame([(f,) for f in replaced], "file string"), "file", "left_anti").select(*sizes.columns)
    sizes = written(sizes, "file-sizes")
    many = size_histogram(sizes, target_bytes).where("small_files > 1")
    hours = written(many.select(*LANDING_PARTITIONS, F.ceil(F.col("small_bytes") / target_bytes).cast("int").alias("chunks")), "hours")
    small = sizes.where(F.col("bytes") * 2 < target_bytes).join(hours, LANDING_PARTITIONS)
    files = [r["file"] for r in small.select("file").collect()]
    if not files:
        return 0
    names = {tuple(r) for r in hours.select(*LANDING_PARTITIONS).collect()}
    chosen = lambda v: tuple(int(v[c]) for c in LANDING_PARTITIONS) in names
    rows = spark.read.schema(BRONZE_SCHEMA).option("basePath", base).parquet(*[f"{base.rstrip('/')}/{unquote(f)}" for f in files])
    rows = rows.withColumn("__at", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    before = lake.tables.get(PACKED)
    if before is not None and before.where(chosen).leaves:
        rows = rows.unionByName(lake.read(PACKED, before.where(chosen)).withColumn("__at", F.xxhash64("subscription_id", "created_at")))
    # One task, hence one file, for each chunk of an hour.
    dealt = rows.join(F.broadcast(hours), LANDING_PARTITIONS).withColumn("__chunk", F.pmod("__at", "chunks"))
    tasks = int(hours.agg(F.sum("chunks")).first()[0])
    dealt = dealt.repartition(tasks, *LANDING_PARTITIONS, "__chunk").select(*BRONZE_SCHEMA.names)
    staged = lake.stage(dealt, PACKED, LANDING_PARTITIONS)
    kept = before.where(lambda v: not chosen(v)) if before is not None else Stored(staged.schema, staged.partition_by)
    lake.commit({PACKED: kept.and_also(staged)}, {"replaced": sorted(replaced | set(files))})
    return len(files)


def vacuum(spark: SparkSession, base: str) -> int:
    """Delete the landed files that packed ones replace; returns how many."""
    lake = Lake(spark, packed_root(base))
    gone = lake.settings.get("replaced", [])
    if gone:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path
        files = jvm_path(base).getFileSystem(spark._jsc.hadoopConfiguration())
        for file in gone:
            files.delete(jvm_path(f"{base.rstrip('/')}/{unquote(file)}"), False)
        lake.commit(lake.tables, {"replaced": []})
    return len(gone)


def landed_files(spark: SparkSession, base: str) -> DataFrame:
    """Rows and files per landed hour, as a scan finds them."""
    rows = scan(spark, base).select(*LANDING_PARTITIONS, F.input_file_name().alias("file"))
    return rows.groupBy(*LANDING_PARTITIONS).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))
