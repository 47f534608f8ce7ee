"""A bounded filter over the keys of a table, to spare other rows a shuffle.

Keys are hashed to one of a fixed number of bits, and the set bits are kept as 64-bit masks. The
filter never misses a key of the table; it lets others pass with the share of bits set. Its size
is bounded by the number of bits, whatever the table, so it may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24  # 2^18 masks: 4 MB


def _position(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_filter(rows: DataFrame, keys: list[str], bits: int = BITS) -> DataFrame:
    """``mask_number, mask``: at most ``bits / 64`` rows; rows with a null key are left out.

    Masks are combined in each task before they are shuffled.
    """
    whole = rows.dropna(subset=keys).select(_position(keys, bits).alias("at"))
    bit = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(at & 63 AS INT))")
    return whole.groupBy(F.shiftright("at", 6).alias("mask_number")).agg(
        F.bit_or(bit).alias("mask")
    )


def may_hold(
    rows: DataFrame, keys: list[str], filter_rows: DataFrame, bits: int = BITS
) -> DataFrame:
    """The rows whose key may be one of those the filter was made of."""
    at = _position(keys, bits)
    probed = rows.withColumn("_at", at).withColumn("_mask_number", F.shiftright("_at", 6))
    # at most bits / 64 rows by construction
    met = probed.join(F.broadcast(filter_rows), F.col("_mask_number") == F.col("mask_number"))
    hit = F.expr("shiftright(mask, CAST(_at & 63 AS INT)) & 1") == 1
    return met.where(hit).select(*rows.columns)
