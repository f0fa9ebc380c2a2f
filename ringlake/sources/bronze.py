"""Landing and scanning the Hive-partitioned bronze Parquet tree."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ringlake.functions.rules import landing_fields
from ringlake.schemas import BRONZE_SCHEMA, LANDING_PARTITIONS
from ringlake.sources.lake import Lake


def land(batch: DataFrame, base: str, at: Column | None = None) -> None:
    """Append a batch below ``year=/month=/day=/hour=``.

    ``at`` is the landing time of each row, the current time by default.  The
    rebalance hint gives each hour few, evenly sized files and lets adaptive
    execution split an hour that holds most of the batch.
    """
    stamped = batch.withColumns(landing_fields(F.current_timestamp() if at is None else at))
    (
        stamped.hint("rebalance", *LANDING_PARTITIONS)
        .write.mode("append")
        .partitionBy(*LANDING_PARTITIONS)
        .parquet(base)
    )


def scan(
    spark: SparkSession,
    base: str,
    date_filter: str | None = None,
    merge_schema: bool = False,
    conform: bool = False,
) -> DataFrame:
    """Read the tree, or the part named by ``date_filter`` such as ``year=2024/month=01``.

    Steps of the filter that begin the landing order are a folder: only that folder is
    listed, and the partition columns stay in the result.  Other steps are predicates
    on partition columns.  A part that does not exist has no rows.  With
    ``merge_schema`` the schema is the union of the files' own schemas.

    Some writers store a column without any value as a null-typed integer, which the
    contract's schema cannot read.  With ``conform`` files are grouped by the types in
    their footers, each group is one scan, cast to the contract, and their rows
    are put together: such a column is NULL there.

    Files that ``compact`` has packed are read from where it put them.
    """
    rest, folder = dict(filter_steps(date_filter)), base.rstrip("/")
    for name in LANDING_PARTITIONS:
        if name not in rest:
            break
        folder += f"/{name}={rest.pop(name)}"
    packed = Lake(spark, packed_root(base))
    if _exists(spark, folder):
        tree = _tree(spark, base, folder, merge_schema, conform, packed.settings.get("replaced", []))
    else:
        tree = spark.createDataFrame([], BRONZE_SCHEMA)
    if packed.tables:
        more = packed.read(PACKED)
        if date_filter:
            more = more.where(partition_predicate(date_filter))
        tree = tree.unionByName(more, allowMissingColumns=True)
    return tree.where(partition_predicate("/".join(f"{k}={v}" for k, v in rest.items()))) if rest else tree


PACKED = "bronze"


def packed_root(base: str) -> str:
    """Hidden from whatever lists the tree."""
    return f"{base.rstrip('/')}/_packed"


def relative(path: Column) -> Column:
    """A landed file's path from its year on."""
    return F.regexp_extract(path, f"({LANDING_PARTITIONS[0]}=[^?]*)$", 1)


def _without(tree: DataFrame, files: list[str]) -> DataFrame:
    """The rows of all but these files; their number is what a compaction packed and has not deleted yet."""
    if not files:
        return tree
    gone = tree.sparkSession.createDataFrame([(f,) for f in files], "__gone string")
    return tree.withColumn("__file", relative(F.col("_metadata.file_path"))).join(gone, F.col("__file") == F.col("__gone"), "left_anti").drop("__file")


def _tree(spark: SparkSession, base: str, folder: str, merge_schema: bool, conform: bool, gone: list[str]) -> DataFrame:
    reader = spark.read.option("basePath", base)
    if not merge_schema and not conform:
        return _without(reader.schema(BRONZE_SCHEMA).parquet(folder), gone)
    merging = spark.read.option("basePath", base).option("mergeSchema", "true")
    if not conform:
        return _without(merging.parquet(folder), gone)
    if _merged(spark, base, [folder]) is not None:
        return _conformed(_without(merging.parquet(folder), gone))
    files = [unquote(f) for f in reader.schema(BRONZE_SCHEMA).parquet(folder).inputFiles()]
    groups = type_groups(spark, base, files)
    return reduce(DataFrame.unionByName, [_conformed(_without(merging.parquet(*g), gone)) for g in groups])


def _conformed(rows: DataFrame) -> DataFrame:
    held = set(rows.columns)
    return rows.select(
        *[(F.col(f.name) if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA]
    )


def _merged(spark: SparkSession, base: str, paths: list[str]) -> dict[str, str] | None:
    """Types by column of these files' footers, which executors read; None where a column has two."""
    try:
        schema = spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        return None
    return {f.name: f.dataType.simpleString() for f in schema}


def type_groups(spark: SparkSession, base: str, files: list[str]) -> list[list[str]]:
    """Files in groups within which every column has one type.

    Files of one writing job are looked at together, and halved where they differ;
    then what agrees is put together, so there are as many groups as there are mixtures
    of types, however many files.
    """
    by_writer: dict[str, list[str]] = {}
    for file in sorted(files):
        writer = re.search(r"part-\d+-([0-9a-f-]{36})", file)
        by_writer.setdefault(writer[1] if writer else file, []).append(file)

    def split(some: list[str]) -> list[tuple[list[str], dict[str, str]]]:
        types = _merged(spark, base, some)
        if types is not None:
            return [(some, types)]
        half = len(some) // 2
        return split(some[:half]) + split(some[half:])

    with ThreadPoolExecutor(16) as pool:
        found = [piece for pieces in pool.map(split, by_writer.values()) for piece in pieces]
    kinds: dict[str, set[str]] = {}
    for _, types in found:
        for name, kind in types.items():
            kinds.setdefault(name, set()).add(kind)
    mixed = sorted(name for name, seen in kinds.items() if len(seen) > 1)
    groups: dict[tuple, list[str]] = {}
    for some, types in found:
        groups.setdefault(tuple(types.get(name) for name in mixed), []).extend(some)
    return list(groups.values())


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def filter_steps(date_filter: str | None) -> list[tuple[str, str]]:
    steps = [tuple(step.split("=", 1)) for step in (date_filter or "").strip("/").split("/") if step]
    unknown = [step[0] for step in steps if len(step) != 2 or step[0] not in LANDING_PARTITIONS]
    if unknown:
        raise ValueError(f"not a landing partition: {unknown}")
    return steps


def partition_predicate(date_filter: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name) == int(value) for name, value in filter_steps(date_filter)])
