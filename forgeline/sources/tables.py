"""Stored tables: a Parquet directory per table, or an RDBMS table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


def scan_table(spark: SparkSession, root: str, table: str, layer: str = "ods") -> DataFrame:
    """A table of a layer, read with its declared schema (no footer is read for it)."""
    return spark.read.schema(schemas.table_schema(table, layer)).parquet(f"{root}/{table}")


def jdbc_read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan, split into ranges of ``partition_column``."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **extra}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned scan needs both bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def scan_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
