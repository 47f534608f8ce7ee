"""Relational source read in parallel over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    schema: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; a partition column with its bounds makes the read parallel.

    The bounds only place the cuts: rows outside them fall into the outer partitions.
    """
    options = {
        "url": url,
        "dbtable": f"{schema}.{table}" if schema else table,
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        "pushDownLimit": "true",
    }
    if (partition_column is None) != (bounds is None):
        raise ValueError("a partition column and its bounds go together")
    if partition_column is not None:
        options["partitionColumn"] = partition_column
        options["lowerBound"], options["upperBound"] = (str(bound) for bound in bounds)
        options["numPartitions"] = str(partitions)
    return options


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], properties: Mapping[str, str] | None = None
) -> DataFrame:
    """A table of a relational database. Filters and column choices run in the database."""
    return spark.read.format("jdbc").options(**options, **(properties or {})).load()
