"""Tables of a warehouse as folders that never change, made current together by one manifest.

A table's rows lie in leaf folders ``lake_version=<run>/<partition>=<value>/...``.  A run writes
new leaves beside the old ones.  The manifest names the leaves that count, with the rows
that the footers of their files hold; it is a numbered file, put in place by one
rename, and the highest number is current.  So readers find all tables as one run left
them, whatever happens between two writes, and a replaced partition costs a line.

The manifest grows with partitions (categories and calendar days), not with rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
import json
from urllib.parse import unquote
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

VERSION = "lake_version"
FOLDER = "_manifests"
KEPT = 2  # manifests, and the leaves they name, that stay for readers that have them open
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

Values = dict[str, str | None]


def leaf_values(leaf: str) -> Values:
    """Partition values of a leaf folder, as text."""
    pairs = [step.split("=", 1) for step in leaf.split("/")]
    return {unquote(k): None if v == NO_VALUE else unquote(v) for k, v in pairs if k != VERSION}


@dataclass
class Stored:
    """A table: its schema, partition columns, rows by leaf folder, and how many leaves its versions were written with."""

    schema: T.StructType
    partition_by: list[str]
    leaves: dict[str, int] = field(default_factory=dict)
    versions: dict[str, int] = field(default_factory=dict)

    def where(self, holds: Callable[[Values], bool]) -> Stored:
        leaves = {k: n for k, n in self.leaves.items() if holds(leaf_values(k))}
        return Stored(self.schema, self.partition_by, leaves, self.versions)

    def and_also(self, other: Stored) -> Stored:
        """The leaves of both, as a table of the other's schema."""
        leaves = {**self.leaves, **other.leaves}
        used = {leaf.split("/")[0] for leaf in leaves}
        versions = {k: n for k, n in {**self.versions, **other.versions}.items() if k in used}
        return Stored(other.schema, other.partition_by, leaves, versions)

    def folders(self) -> list[str]:
        """The leaves, with a version's own folder in place of all of its leaves."""
        by_version: dict[str, list[str]] = {}
        for leaf in sorted(self.leaves):
            by_version.setdefault(leaf.split("/")[0], []).append(leaf)
        return [f for version, leaves in by_version.items() for f in ([version] if len(leaves) == self.versions[version] else leaves)]

    def values(self, column: str) -> set[str | None]:
        return {leaf_values(leaf)[column] for leaf in self.leaves}

    def rows(self) -> int:
        return sum(self.leaves.values())


class Lake:
    """The tables that the newest manifest below ``root`` names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.number, self.tables, self.settings = 0, {}, {}
        self._staged: list[str] = []
        numbers = self._numbers()
        if numbers:
            self.number = numbers[-1]
            self.tables, self.settings = self._parsed(self.number)

    # --- files -----------------------------------------------------------------------
    def _path(self, below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        files, folder = self._files(), self._path(FOLDER)
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[2:-5]) for n in names if n.startswith("m-") and n.endswith(".json"))

    @staticmethod
    def _name(number: int) -> str:
        return f"{FOLDER}/m-{number:09d}.json"

    def _parsed(self, number: int) -> tuple[dict[str, Stored], dict]:
        stream = self._files().open(self._path(self._name(number)))
        try:
            body = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        tables = {k: Stored(T.StructType.fromJson(t["schema"]), t["partition_by"], t["leaves"], t["versions"]) for k, t in body["tables"].items()}
        return tables, body["settings"]

    # --- reading ---------------------------------------------------------------------
    def folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def read(self, name: str, stored: Stored | None = None) -> DataFrame:
        """The rows of a table, or of some of its leaves: one scan of just these folders."""
        stored = stored or self.tables[name]
        if not stored.leaves:
            return self.spark.createDataFrame([], stored.schema)
        paths = [f"{self.folder(name)}/{folder}" for folder in stored.folders()]
        reader = self.spark.read.schema(stored.schema).option("basePath", self.folder(name))
        return reader.parquet(*paths).select(*stored.schema.names)

    def rewritten(self, name: str) -> DataFrame:
        """The leaves that the newest manifest names and the one before does not, with their rows."""
        before = self._parsed(self.number - 1)[0] if self.number - 1 in self._numbers() else {}
        new = Stored(self.tables[name].schema, self.tables[name].partition_by)
        known = before[name].leaves if name in before else {}
        columns = new.partition_by
        found = [
            (*[leaf_values(leaf)[c] for c in columns], n) for leaf, n in sorted(self.tables[name].leaves.items()) if leaf not in known
        ]
        shown = self.spark.createDataFrame(found, ", ".join([*[f"`{c}` string" for c in columns], "rows long"]))
        return shown.select(*[F.col(c).cast(new.schema[c].dataType) for c in columns], "rows")

    # --- writing ---------------------------------------------------------------------
    def stage(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> Stored:
        """Write rows to new leaves, which no manifest names yet.

        The counts come from the footers of the files that were committed, so tasks that
        ran twice count once.  Give ``df`` a rebalance hint to get few files a leaf.
        """
        columns, version = partition_by or [], f"{VERSION}=r{uuid.uuid4().hex}"
        path = f"{self.folder(name)}/{version}"
        self._staged.append(path)
        df.write.partitionBy(*columns).parquet(path) if columns else df.write.parquet(path)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name not in columns] + [T.StructField(c, df.schema[c].dataType) for c in columns])
        counted = self._counted(path, schema).collect()
        leaves = {unquote(r["folder"]).split(f"/{version}", 1)[1].strip("/"): r["n"] for r in counted}
        held = {f"{version}/{leaf}".rstrip("/"): n for leaf, n in leaves.items() if n}
        return Stored(schema, columns, held, {version: len(held)} if held else {})

    def _counted(self, path: str, schema: T.StructType) -> DataFrame:
        """Rows by folder.  No column is read, so this takes the row counts of the footers.

        Rows are counted by file first: their folder is cut out of a path once a file, not once a row.
        """
        file = F.input_file_name().alias("file")
        files = self.spark.read.schema(schema).parquet(path).groupBy(file).agg(F.count(F.lit(1)).alias("n"))
        return files.groupBy(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).agg(F.sum("n").alias("n"))

    def discard(self) -> None:
        """Delete what was staged and not committed."""
        for path in self._staged:
            self._files().delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)
        self._staged = []

    def commit(self, tables: dict[str, Stored], settings: dict | None = None) -> None:
        """Make these tables, and no others, the current ones."""
        body = {
            "settings": settings or {},
            "tables": {k: {"schema": t.schema.jsonValue(), "partition_by": t.partition_by, "leaves": t.leaves, "versions": t.versions} for k, t in tables.items()},
        }
        files = self._files()
        files.mkdirs(self._path(FOLDER))
        draft = self._path(f"{FOLDER}/.draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(body).encode()))
        out.close()
        self._put(draft, self._path(self._name(self.number + 1)))
        self.number, self.tables, self.settings, self._staged = self.number + 1, tables, settings or {}, []
        self._forget()

    def _put(self, draft, place) -> None:
        """One rename, which fails where another run has put this number in place."""
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(draft, place, none)

    def _forget(self) -> None:
        """Delete old manifests, with leaves that no kept one names; leaves of runs under way are not touched."""
        numbers = self._numbers()
        kept = {(k, leaf) for n in numbers[-KEPT:] for k, t in self._parsed(n)[0].items() for leaf in t.leaves}
        files = self._files()
        for number in numbers[:-KEPT]:
            for name, table in self._parsed(number)[0].items():
                for leaf in table.leaves:
                    if (name, leaf) not in kept:
                        files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder(name)}/{leaf}"), True)
            files.delete(self._path(self._name(number)), False)

    # --- catalog ---------------------------------------------------------------------
    def attach(self, name: str, table: str) -> None:
        """Register a table's current leaves in the session catalog as the partitions of ``table``."""
        stored = self.tables[name]
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
        keys = [VERSION, *stored.partition_by]
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}, {VERSION} string) USING parquet "
            f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{self.folder(name)}'"
        )
        leaves = sorted(stored.leaves)
        for at in range(0, len(leaves), 500):
            specs = []
            for leaf in leaves[at : at + 500]:
                steps = dict(step.split("=", 1) for step in leaf.split("/"))
                shown = ", ".join("{}='{}'".format(k, unquote(v).replace("\\", "\\\\").replace("'", "\\'")) for k, v in steps.items())
                specs.append(f"PARTITION ({shown})")
            self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(specs)}")
