"""Incremental bronze -> silver ingestion of newly landed files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ringlake.functions.clock import Clock
from ringlake.plans.silver import to_silver
from ringlake.schemas import BRONZE_SCHEMA, SILVER_COLUMNS, SILVER_PARTITIONS
from ringlake.sources.lake import NO_VALUE
from ringlake.sources.tables import with_partitions

# Keeps the first run over a large tree from becoming one batch.
BATCH_BYTES = str(64 << 30)
FILE = "bronze_file"


def bronze_stream(spark: SparkSession, base: str, part: str = "", **limits: str) -> DataFrame:
    """Files that appear below ``base``, or below its dated ``part``, which shortens the listing; rows name their file.

    ``limits`` are reader options such as ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``.
    """
    limits = limits or {"maxBytesPerTrigger": BATCH_BYTES}
    reader = spark.readStream.schema(BRONZE_SCHEMA).option("basePath", base).options(**limits)
    return reader.parquet(f"{base.rstrip('/')}/{part.strip('/')}".rstrip("/")).select("*", F.col("_metadata.file_path").alias(FILE))


def ingest(
    spark: SparkSession,
    base: str,
    target: str,
    checkpoint: str,
    clock: Clock = Clock(),
    every: str | None = None,
    part: str = "",
    **limits: str,
) -> StreamingQuery:
    """Start the ingestion into the silver table below ``target``.

    By default it takes all files present and stops; ``every`` (for example
    "30 seconds") keeps it running.  A batch is rebalanced, so each table partition gets few
    files, and has a folder of its own, named by query and batch.  A log beside the
    target names the batches that count and the bronze files that they took: a batch that
    is repeated after a failure counts once, and a second or renewed checkpoint takes
    no file again and replaces nothing.  Run one query at a time into a target.
    """

    def store(silver: DataFrame, batch: int) -> None:
        key = f"{_query_id(spark, checkpoint)}-{batch}"
        done = committed(spark, target)
        if key in done:
            return
        rows = silver.join(_taken(spark, target, done), FILE, "left_anti") if done else silver
        with_partitions(rows).drop(FILE).write.mode("overwrite").partitionBy(*SILVER_PARTITIONS).parquet(f"{target}/batch={key}")
        rows.select(FILE).distinct().write.mode("overwrite").parquet(f"{_log(target)}/batch={key}")

    silver = to_silver(bronze_stream(spark, base, part, **limits), clock, keep=[FILE])
    writer = silver.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


# --- log ------------------------------------------------------------------------------
def _log(target: str) -> str:
    return f"{target.rstrip('/')}-log"


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """What Spark names the query by for as long as its checkpoint lives."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def committed(spark: SparkSession, target: str) -> list[str]:
    """Batches whose log entry is complete; it is written after their rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_log(target)}/batch=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(s.getPath().getParent().getName().removeprefix("batch=") for s in found)


def _taken(spark: SparkSession, target: str, batches: list[str]) -> DataFrame:
    return spark.read.schema(f"{FILE} string").parquet(*[f"{_log(target)}/batch={b}" for b in batches])


# --- reading --------------------------------------------------------------------------
def _stored(spark: SparkSession, target: str, batches: list[str]) -> DataFrame:
    rows = spark.createDataFrame([], BRONZE_SCHEMA)
    schema = with_partitions(to_silver(rows, Clock())).schema.add("batch", "string")
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", target).parquet(*[f"{target}/batch={b}" for b in batches])


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all batches that count, in the silver contract."""
    return _stored(spark, target, committed(spark, target)).select(*SILVER_COLUMNS)


def create_table(spark: SparkSession, table: str, target: str) -> DataFrame:
    """Register what is ingested as a table, or add the partitions of batches that came since."""
    keys = ["batch", *SILVER_PARTITIONS]
    batches = committed(spark, target)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _stored(spark, target, []).schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(keys)}) LOCATION '{target}'")
    known = {r[0].split("/")[0].removeprefix("batch=") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [b for b in batches if b not in known]
    if new:
        leaves = _stored(spark, target, new).select(*keys).distinct().collect()  # a row for each new partition
        specs = [", ".join(f"{k}='{NO_VALUE if r[k] is None else r[k]}'" for k in keys) for r in leaves]
        for at in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {table} ADD {' '.join(f'PARTITION ({spec})' for spec in specs[at : at + 500])}")
    return spark.table(table).select(*SILVER_COLUMNS)
