"""Reading tables, samples, counts and parameterised SQL."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sample_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k per task, no full sort)."""
    return df.orderBy(*order).limit(n)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_sql(
    spark: SparkSession,
    query: str,
    params: Mapping[str, Any] | None = None,
    fetch_all: bool = True,
    **tables: DataFrame,
) -> DataFrame:
    """SQL with named parameters over the given frames; all rows, or only the first.

    Parameters are bound as values and frames by name (``{orders}``), never spliced in.
    """
    result = spark.sql(query, args=dict(params or {}), **tables)
    return result if fetch_all else result.limit(1)
