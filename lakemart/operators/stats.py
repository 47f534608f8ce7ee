"""Statistics over suite results and sessions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.money import exact_sum, percent, units


def _total_time() -> Column:
    """Seconds summed as whole microseconds, so the total does not depend on the merge order."""
    return exact_sum(units("execution_time", 6), 6, "decimal(28,6)").cast("double")


def _statistics() -> list[Column]:
    time = F.col("execution_time")
    seconds = _total_time() / F.nullif(F.count(time), F.lit(0))
    good = F.count_if(F.col("success"))
    return [
        F.count("*").alias("total_queries"),
        good.alias("successful"),
        (F.count("*") - good).alias("failed"),
        percent(good, F.count("*")).alias("success_rate"),
        F.coalesce(seconds, F.lit(0.0)).alias("avg_execution_time"),
        F.coalesce(F.min(time), F.lit(0.0)).alias("min_execution_time"),
        F.coalesce(F.max(time), F.lit(0.0)).alias("max_execution_time"),
    ]


def suite_statistics(results: DataFrame) -> DataFrame:
    """One row over ``success, execution_time``; times count where there is one.

    No results give no row.
    """
    return results.agg(*_statistics()).where(F.col("total_queries") > 0)


def difficulty_statistics(
    results: DataFrame, group: str, difficulty_of: Mapping[str, str]
) -> DataFrame:
    """The same statistics for each difficulty, and for ``all`` results together.

    The catalogue of groups is an expression; each result is counted under its own
    difficulty and under ``all`` before anything is shuffled.
    """
    difficulty = F.lit(None).cast("string")
    for name, level in difficulty_of.items():
        difficulty = F.when(F.col(group) == name, F.lit(level)).otherwise(difficulty)
    levels = F.explode(F.array(difficulty, F.lit("all")))
    return (
        results.select("success", "execution_time", levels.alias("difficulty"))
        .where(F.col("difficulty").isNotNull())
        .groupBy("difficulty")
        .agg(*_statistics())
    )


def session_counters(results: DataFrame, session: str) -> DataFrame:
    """Queries, successes, failures, total and mean time per session."""
    total = F.coalesce(_total_time(), F.lit(0.0))
    good = F.count_if(F.col("success"))
    return results.groupBy(session).agg(
        F.count("*").alias("total_queries"),
        good.alias("successful_queries"),
        (F.count("*") - good).alias("failed_queries"),
        total.alias("total_time"),
        (total / F.count("*")).alias("avg_time"),
    )
