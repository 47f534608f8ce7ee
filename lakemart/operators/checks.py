"""Data checks and column facts: what a catalogue declares, computed on the data."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE_LIMIT = 50
SKETCH_BITS = 8
MERGE_GROUPS = 256


def outside_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose value is not in the declared list; nulls are reported apart."""
    value = F.col(column)
    problem = F.when(value.isNull(), F.lit("null")).when(~value.isin(allowed), F.lit("outside"))
    return df.withColumn("problem", problem).where(F.col("problem").isNotNull())


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and keys with a null part.

    Counting combines within each task first, so one very frequent key stays cheap.
    """
    has_null = reduce(or_, [F.col(key).isNull() for key in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .withColumn(
            "problem",
            F.when(has_null, F.lit("null key")).when(
                F.col("row_count") > 1, F.lit("duplicate")
            ),
        )
        .where(F.col("problem").isNotNull())
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_name, null_count, row_count``: one pass, one row per column."""
    names = columns or df.columns
    facts = df.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(name).isNull()).alias(f"n{i}") for i, name in enumerate(names)],
    )
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("null_count"), "row_count")
        for i, name in enumerate(names)
    ]
    return facts.select(F.inline(F.array(*entries)))


def data_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, min_value, max_value, value_count``: one pass, one row per column."""
    facts = []
    for i, name in enumerate(columns):
        facts += [F.min(name).alias(f"a{i}"), F.max(name).alias(f"z{i}")]
        facts.append(F.count(name).alias(f"n{i}"))
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"a{i}").cast("string").alias("min_value"),
            F.col(f"z{i}").cast("string").alias("max_value"),
            F.col(f"n{i}").alias("value_count"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*facts).select(F.inline(F.array(*entries)))


def spread() -> Column:
    """Grouping key of a first merge round.

    Sketches of all tasks would otherwise meet in one reducer; with it they are merged in
    :data:`MERGE_GROUPS` tasks, and only as many partial rows reach the last one.
    """
    return F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("merge_group")


def distinct_sketch(column: str) -> Column:
    """Sketch of the distinct values of a column, about two kilobytes whatever their number."""
    return F.theta_sketch_agg(F.col(column).cast("string"), SKETCH_BITS)


def distinct_estimate(sketch: str) -> Column:
    """Distinct count of merged sketches.

    A theta sketch keeps the hashes themselves until it holds ``2 ** SKETCH_BITS`` of
    them, so the result is exact below that and an estimate above: enough to decide
    whether there are fewer than :data:`VALUE_LIMIT`.
    """
    return F.theta_sketch_estimate(F.theta_union_agg(sketch, SKETCH_BITS))


def possible_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, value``: one row per column and distinct value, null included.

    All columns go through one distinct, which combines within each task first; no list of
    values is gathered in one row.
    """
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ]
    return df.select(F.inline(F.array(*entries))).distinct()
