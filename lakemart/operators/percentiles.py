"""Exact interpolated percentiles whose state stays bounded at any row count.

The built-in ``percentile`` keeps one counter per distinct value in one final task. Here one
pass counts rows per value without its low ``BITS`` bits. The wanted positions are narrowed on
these counters by groups of bits, never with more than ``2 ** BITS`` rows per position at once,
and one more pass looks at the rows around each position. The counters add up, so they can be
kept and merged with those of new rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 15
PASSES = 4


def value_counters(df: DataFrame, value: Column) -> DataFrame:
    """``low, n``: rows per whole-number ``value`` without its low bits; nulls don't count."""
    low = F.shiftright(value.cast("bigint"), BITS).alias("low")
    return df.where(value.isNotNull()).groupBy(low).agg(F.count("*").alias("n"))


def exact_percentiles(
    df: DataFrame,
    value: Column,
    fractions: Sequence[float],
    counters: DataFrame | None = None,
) -> DataFrame:
    """One row with ``percentiles array<double>`` for a whole-number ``value``.

    Nulls don't count; without any value the array is null. ``counters``, those of
    :func:`value_counters` for the same rows, spare the first of two passes; several rows for
    one ``low`` add up.
    """
    values = df.select(value.cast("bigint").alias("value")).where(F.col("value").isNotNull())
    if counters is None:
        counters = value_counters(values, F.col("value"))
    running = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    everything = running.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    shift = BITS * (PASSES - 2)  # of a value without its low bits
    counts = counters.groupBy(F.shiftright("low", shift).alias("prefix")).agg(
        F.sum("n").alias("n")
    )
    counts = counts.select(
        "prefix",
        "n",
        F.sum("n").over(running).alias("upto"),
        F.sum("n").over(everything).alias("total"),
    )
    # rows before the position, and the fraction of the way to the row after it
    last = F.col("total") - 1
    positions = []
    for i, fraction in enumerate(fractions):
        exact = F.lit(float(fraction)) * last
        for side, rank in enumerate((F.floor(exact), F.ceil(exact))):
            positions.append(
                F.struct(
                    F.lit(i).alias("slot"),
                    F.lit(side).alias("side"),
                    rank.alias("rank"),
                    (exact - F.floor(exact)).alias("weight"),
                )
            )
    found = _hit(counts.select("*", F.inline(F.array(*positions))))

    for level in range(PASSES - 3, -1, -1):
        outer, shift = shift, BITS * level
        found = _narrowed(counters, "low", outer, F.shiftright("low", shift), F.sum("n"), found)
    found = _narrowed(values, "value", BITS, F.col("value"), F.count("*"), found)

    ends = found.groupBy("slot").agg(
        F.max(F.when(F.col("side") == 0, F.col("prefix"))).alias("low"),
        F.max(F.when(F.col("side") == 1, F.col("prefix"))).alias("high"),
        F.max("weight").alias("weight"),
    )
    at = F.col("low") * (1 - F.col("weight")) + F.col("high") * F.col("weight")
    pairs = F.array_sort(F.collect_list(F.struct("slot", at.alias("at"))))
    found = F.when(F.count("*") > 0, F.transform(pairs, lambda p: p["at"]))
    return ends.agg(found.alias("percentiles"))


def _narrowed(
    rows: DataFrame, value: str, outer: int, prefix: Column, count: Column, found: DataFrame
) -> DataFrame:
    """The next, longer prefix of each position, among the rows that have the one found."""
    # two rows per fraction by construction, so the broadcast is bounded
    counts = (
        rows.join(F.broadcast(found), F.shiftright(value, outer) == F.col("prefix"))
        .groupBy("slot", "side", "rank", "weight", prefix.alias("next"))
        .agg(count.alias("n"))
        .withColumnRenamed("next", "prefix")
    )
    per_slot = Window.partitionBy("slot", "side").orderBy("prefix")
    per_slot = per_slot.rowsBetween(Window.unboundedPreceding, 0)
    return _hit(counts.withColumn("upto", F.sum("n").over(per_slot)))


def _hit(counts: DataFrame) -> DataFrame:
    """The prefix holding each wanted rank, with the rank counted from its first row."""
    before = F.col("upto") - F.col("n")
    return counts.where((F.col("upto") > F.col("rank")) & (before <= F.col("rank"))).select(
        "slot", "side", (F.col("rank") - before).alias("rank"), "weight", "prefix"
    )
