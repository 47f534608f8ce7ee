import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.operators.percentiles import exact_percentiles, value_counters

FRACTIONS = [0.8, 0.24, 0.5, 0.0, 1.0]

CASES = {
    "one value": [5],
    "two values": [1, 2],
    "all equal": [7] * 40,
    "a third equal": [1000] * 100 + list(range(200)),
    "wide range": [3**i for i in range(38)] + [10**17, 10**17 + 1],
    "negative": [-5, -4, -(10**12), 0, 12, 10**12],
}


@pytest.mark.parametrize("name", CASES)
def test_narrowing_equals_sorted_values(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    found = exact_percentiles(df, F.col("v"), FRACTIONS).first().percentiles
    wanted = [float(np.percentile(np.array(values, dtype=float), f * 100)) for f in FRACTIONS]
    assert found == pytest.approx(wanted, rel=1e-12)


def test_narrowing_equals_built_in(spark):
    df = spark.range(20_000).select((F.hash("id") % 5_000_000).cast("bigint").alias("v"))
    narrowed = exact_percentiles(df, F.col("v"), FRACTIONS).first().percentiles
    wanted = F.array(*[F.lit(f) for f in FRACTIONS])
    counted = df.agg(F.percentile("v", wanted).alias("p")).first().p
    assert narrowed == pytest.approx(counted, rel=1e-15)


def test_no_values_give_null(spark):
    df = spark.createDataFrame([(None,)], "v bigint")
    assert exact_percentiles(df, F.col("v"), [0.5]).first().percentiles is None
    assert exact_percentiles(df.limit(0), F.col("v"), [0.5]).first().percentiles is None


@pytest.mark.parametrize("name", CASES)
def test_kept_counters_spare_a_pass(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    counters = value_counters(df.limit(0), F.col("v"))
    for part in (values[::2], values[1::2]):
        rows = spark.createDataFrame([(v,) for v in part], "v bigint")
        counters = counters.unionByName(value_counters(rows, F.col("v")))
    found = exact_percentiles(df, F.col("v"), FRACTIONS, counters).first().percentiles
    assert found == exact_percentiles(df, F.col("v"), FRACTIONS).first().percentiles
