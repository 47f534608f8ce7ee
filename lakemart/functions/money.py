"""Exact money arithmetic.

Prices arrive as doubles. A total must not depend on the order in which partitions are
merged, so prices are summed as whole cents, in 64-bit numbers.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(12,2)"
TOTAL = "decimal(22,2)"
AVERAGE = "decimal(20,2)"


def price(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(PRICE)


def units(column: str | Column, scale: int = 2) -> Column:
    """The amount in whole units of ``10 ** -scale``, halves rounded away from zero.

    The rule is that of :func:`price`: the written decimal counts, so 1.005 is 101 cents. The
    cast goes through text for a double, which costs about as much again as the sum. It fails
    on values that are not numbers or too large, instead of counting them as 0.
    """
    value = F.col(column) if isinstance(column, str) else column
    number = F.when(F.isnan(value), F.raise_error(F.lit("not a number"))).otherwise(value)
    return (number.cast(f"decimal(18,{scale})") * F.lit(10**scale)).cast("bigint")


def exact_sum(whole: Column, scale: int, kind: str = TOTAL) -> Column:
    """Sum of whole units as a decimal of the given scale.

    The low 20 bits and the rest are added up apart, each in a 64-bit number: one group
    can then hold 2^43 rows of any realistic price before either sum is full, and the
    engine raises an error rather than wrap around.
    """
    high = F.sum(F.shiftright(whole, 20)).cast("decimal(20,0)")
    low = F.sum(whole.bitwiseAND((1 << 20) - 1)).cast("decimal(20,0)")
    total = high * F.lit(Decimal(1 << 20)) + low
    return (total * F.lit(Decimal(1).scaleb(-scale))).cast(kind)


def half_up_average(total: str, count: str) -> Column:
    """``total / count`` rounded to cents, halves away from zero, in whole-number arithmetic.

    A decimal or double division followed by a cast rounds twice and moves exact ties.
    """
    cents = F.expr(f"sign({total}) * ((abs({total}) * 200 + {count}) div ({count} * 2))")
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(AVERAGE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Unrounded ratio of two exact sums; null for an empty denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
