"""Insert rows whose key is not there yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.keyfilter import key_filter, may_hold


def first_per_key(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in a stated order.

    The engine applies the limit of one row per key before the shuffle too, so a key
    holding a third of all rows sends at most one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_place", F.row_number().over(ranked)).where("_place = 1").drop("_place")
    )


def absent_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    order: list[str | Column],
    prefilter: bool = False,
) -> DataFrame:
    """Incoming rows to insert: one per key, and only for keys the target does not have.

    With ``prefilter`` the target's keys first pass a bounded filter over the incoming ones, so
    that few of a large target's rows are shuffled; the incoming keys are read twice.
    """
    held = target.select(*keys)
    if prefilter:
        held = may_hold(held, keys, key_filter(incoming, keys))
    return first_per_key(incoming, keys, order).join(held, keys, "left_anti")


def insert_absent(
    target: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    order: list[str | Column],
    prefilter: bool = False,
) -> DataFrame:
    """The target after the insert; existing rows are never changed."""
    absent = absent_rows(target, incoming, keys, order, prefilter)
    return target.unionByName(absent.select(*target.columns))
