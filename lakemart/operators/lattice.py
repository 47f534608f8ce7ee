"""Lattice count: how many numbers fall inside the unit circle of a fixed lattice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two moduli and the scale of the lattice.
X_MODULUS = 317
Y_MODULUS = 271
SCALE = 100.0


def inside_circle(number: Column) -> Column:
    x = (number % X_MODULUS) / F.lit(SCALE)
    y = (number % Y_MODULUS) / F.lit(SCALE)
    return x * x + y * y < F.lit(1.0)


def lattice_count(numbers: DataFrame, column: str = "id") -> DataFrame:
    """``inside, n, estimate`` in one counting pass; the estimate is 4 * inside / n."""
    counts = numbers.agg(
        F.count_if(inside_circle(F.col(column))).alias("inside"), F.count("*").alias("n")
    )
    estimate = F.lit(4.0) * F.col("inside") / F.col("n")
    return counts.select("inside", "n", estimate.alias("estimate"))
