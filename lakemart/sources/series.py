"""Row generators and the daily spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_series(bounds: DataFrame, first: str, last: str, step: str = "1 day") -> DataFrame:
    """``day`` from ``first`` to ``last`` of a one-row frame, both included.

    The length is bounded by the calendar, not by the data.
    """
    days = F.expr(f"sequence(`{first}`, `{last}`, interval {step})")
    return bounds.select(F.explode(days).alias("day"))


def integer_series(spark: SparkSession, first: int, last: int) -> DataFrame:
    """``id`` from ``first`` to ``last``, both included, generated in all tasks."""
    return spark.range(first, last + 1)


def daily_spine(daily: DataFrame, day: str, measures: list[str]) -> DataFrame:
    """Every day of the range has a row; missing measures are zero."""
    bounds = daily.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    spine = date_series(bounds, "first", "last").withColumnRenamed("day", day)
    filled = [F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures]
    return spine.join(daily.select(day, *measures), day, "left").select(day, *filled)
