import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakemart.functions.money import exact_sum, half_up_average, percent, price, ratio, units


def test_exact_sum_of_prices(spark):
    draw = random.Random(1)
    prices = [round(draw.uniform(-1e7, 1e7), 2) for _ in range(5000)] + [0.1] * 1000
    df = spark.createDataFrame([(p,) for p in prices], "p double").repartition(16)
    wanted = sum(Decimal(str(p)) for p in prices)
    assert df.agg(exact_sum(units("p"), 2).alias("s")).first().s == wanted


def test_exact_sum_beyond_a_64_bit_total(spark):
    df = spark.range(1000).select(F.lit(9 * 10**16).cast("bigint").alias("v"))
    assert df.agg(exact_sum(F.col("v"), 2, "decimal(38,2)").alias("s")).first().s == 9 * 10**17


def test_sum_without_values_is_null(spark):
    df = spark.createDataFrame([(None,)], "p double")
    assert df.agg(exact_sum(units("p"), 2).alias("s")).first().s is None


@pytest.mark.parametrize(
    ("value", "scale", "wanted"), [(1.005, 2, 101), (0.285, 2, 29), (0.125, 2, 13), (2.5, 0, 3), (-1.25, 1, -13)]
)
def test_units(spark, value, scale, wanted):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(units("v", scale).alias("u")).first().u == wanted


def test_a_price_that_is_no_number_fails(spark):
    df = spark.createDataFrame([(float("nan"),)], "p double")
    with pytest.raises(PySparkException):
        df.agg(exact_sum(units("p"), 2).alias("s")).collect()


def test_averages_and_ratios(spark):
    df = spark.sql("SELECT 0.05BD AS total, 2L AS n, 0L AS none")
    row = df.select(
        half_up_average("total", "n").alias("average"),
        ratio(F.col("total"), F.col("n")).alias("ratio"),
        ratio(F.col("total"), F.col("none")).alias("undefined"),
        percent(F.col("n"), F.lit(8)).alias("percent"),
    ).first()
    assert (row.average, row.ratio, row.percent) == (Decimal("0.03"), 0.025, 25.0)
    assert row.undefined is None


@pytest.mark.parametrize(
    ("total", "n", "wanted"), [("-1.00", 3, "-0.33"), ("-2.00", 3, "-0.67"), ("-0.05", 2, "-0.03")]
)
def test_average_of_a_negative_total(spark, total, n, wanted):
    df = spark.sql(f"SELECT CAST('{total}' AS DECIMAL(22,2)) AS total, {n}L AS n")
    assert df.select(half_up_average("total", "n").alias("a")).first().a == Decimal(wanted)


def test_price_and_units_round_alike(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (-2.675,), (10.0,)], "v double")
    rows = df.select(price("v").alias("price"), units("v").alias("units")).collect()
    assert [int(r.price * 100) for r in rows] == [r.units for r in rows]
