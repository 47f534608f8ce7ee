"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(column: str) -> Column:
    return F.col(column).cast("date")


def month_start(column: str) -> Column:
    return F.date_trunc("month", F.col(column)).cast("date")


def iso_weekday(column: str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.extract(F.lit("dayofweek_iso"), F.col(column))
