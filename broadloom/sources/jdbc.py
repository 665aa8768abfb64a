"""JDBC tables; connection settings are always arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    driver: str
    properties: dict = field(default_factory=dict)

    def options(self, **more) -> dict:
        return {"url": self.url, "driver": self.driver, **self.properties, **more}


def scan_jdbc(spark: SparkSession, target: JdbcTarget, table: str) -> DataFrame:
    """Whole table over one connection."""
    return spark.read.format("jdbc").options(**target.options(dbtable=table)).load()


def scan_jdbc_partitioned(
    spark: SparkSession, target: JdbcTarget, table: str, column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """Parallel read split on a numeric column.

    The bounds only place the splits; rows outside them go to the edge ones.
    """
    split = dict(partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
    return spark.read.format("jdbc").options(**target.options(dbtable=table, **split)).load()


def scan_jdbc_query(spark: SparkSession, target: JdbcTarget, query: str) -> DataFrame:
    """Result of a query the database runs."""
    return scan_jdbc(spark, target, f"({query}) q")


def scan_jdbc_incremental(spark: SparkSession, target: JdbcTarget, table: str, column: str, since) -> DataFrame:
    """Rows newer than the last seen value; the filter runs in the database."""
    rows = scan_jdbc(spark, target, table)
    return rows if since is None else rows.filter(F.col(column) > F.lit(since))


def sink_jdbc(df: DataFrame, target: JdbcTarget, table: str, mode: str = "errorifexists", connections: int = 8) -> None:
    """Write rows over at most ``connections`` parallel connections."""
    if mode not in ("errorifexists", "append", "overwrite"):
        raise ValueError(f"unknown save mode {mode!r}")
    options = target.options(dbtable=table, numPartitions=str(connections))
    df.write.format("jdbc").options(**options).mode(mode).save()
