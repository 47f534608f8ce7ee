"""One query over tables of two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_sources(
    spark: SparkSession, query: str, sources: dict[str, dict[str, DataFrame]]
) -> DataFrame:
    """SQL over ``{source: {table: frame}}``, with tables named ``{source_table}``.

    Each frame keeps its own pushdown: files prune columns and row groups, a database
    runs its filters itself. Only what is left meets in the join.
    """
    tables = {
        f"{source}_{table}": frame
        for source, frames in sources.items()
        for table, frame in frames.items()
    }
    return spark.sql(query, **tables)
