"""Exchange of a table with a relational database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Where a table lives and how many connections may be open at once."""

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 16
    batch_rows: int = 10_000
    truncate: bool = False

    def options(self) -> dict[str, str]:
        return {
            **self.properties,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
            "fetchsize": str(self.batch_rows),
        }


def overwrite(df: DataFrame, target: JdbcTarget) -> None:
    """Replace the table; with ``truncate`` an existing one keeps its grants and column types."""
    options = {**target.options(), "truncate": str(target.truncate).lower()}
    df.write.mode("overwrite").options(**options).jdbc(target.url, target.table)


def read(
    spark: SparkSession,
    target: JdbcTarget,
    split_on: str | None = None,
    low: object = None,
    high: object = None,
) -> DataFrame:
    """Read the table; with ``split_on`` (number, date or timestamp) in parallel ranges.

    ``low`` and ``high`` only shape the ranges: rows outside them, and rows without a
    value, are read as well.
    """
    options = target.options()
    if split_on is None:
        del options["numPartitions"]
    else:
        options |= {"partitionColumn": split_on, "lowerBound": str(low), "upperBound": str(high)}
    return spark.read.format("jdbc").options(url=target.url, dbtable=target.table, **options).load()
