from datetime import date, datetime
from decimal import Decimal

import pytest
from tests.conftest import SMALL
from pyspark.sql import functions as F

from lakemart.plans.marts import (
    Marts,
    as_of,
    customer_totals,
    product_performance,
    sales_summary,
    with_segment,
)
from lakemart.plans.registry import TESTED
from lakemart.session import new_dir


def orders_of(spark, rows):
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def orders(spark):
    return orders_of(
        spark,
        [
            (1, 10, 0.01, datetime(2024, 1, 1, 8)),
            (2, 10, 0.02, datetime(2024, 1, 1, 23, 59)),
            (3, 20, 100.10, datetime(2024, 1, 3)),
            (4, 20, 50.05, datetime(2024, 1, 3)),
            (5, 30, 9.99, datetime(2024, 1, 4)),
        ],
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(10, "Ann"), (20, "Bob"), (30, "Cid"), (40, "no orders")], "c_custkey bigint, c_name string"
    )


def test_sales_summary_rounds_ties_up(orders):
    rows = {r.sale_date: r for r in sales_summary(orders).collect()}
    assert set(rows) == {date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 4)}
    first = rows[date(2024, 1, 1)]
    assert (first.total_amount, first.order_count) == (Decimal("0.03"), 2)
    assert first.avg_order_value == Decimal("0.02")  # 0.015 exactly, half up
    assert rows[date(2024, 1, 3)].avg_order_value == Decimal("75.08")  # 75.075


def test_as_of_is_the_day_after_the_last_sale(orders):
    assert as_of(orders).first().as_of == date(2024, 1, 5)


def test_customer_stats(orders, customers):
    rows = {r.customer_id: r for r in with_segment(customer_totals(orders, customers)).collect()}
    assert set(rows) == {10, 20, 30}
    bob = rows[20]
    assert bob.email == "customer20@example.com"
    assert (bob.total_orders, bob.lifetime_value) == (2, Decimal("150.15"))
    assert (bob.first_order_date, bob.last_order_date) == (date(2024, 1, 3), date(2024, 1, 3))
    segments = {k: r.customer_segment for k, r in rows.items()}
    assert segments == {10: "New", 20: "VIP", 30: "Regular"}


def test_segments_of_no_customers(spark, orders, customers):
    totals = customer_totals(orders.limit(0), customers)
    assert with_segment(totals).count() == 0


def test_lines_alone_give_quantity_and_revenue(spark):
    """Questions that ask for no sale date read no orders."""
    marts = Marts(spark, SMALL)
    for key in ("q12_top_products", "q30_top_products_per_category"):
        plan = TESTED[key].run(marts)._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderkey" not in plan and "o_orderdate" not in plan


def test_line_without_an_order_counts_as_sold(spark):
    line = "bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_discount double"
    lines = spark.createDataFrame([(1, 7, 2.0, 10.0, 0.0)], f"l_orderkey {line}")
    none = spark.createDataFrame([], "o_orderkey bigint, o_orderdate timestamp_ntz")
    parts = spark.createDataFrame(
        [(7, "a", "b", 1, 1.0), (8, "c", "d", 1, 1.0)],
        "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    )
    rows = {r.product_id: r for r in product_performance(lines, none, parts).collect()}
    assert (rows[7].total_quantity_sold, rows[7].last_sale_date) == (2, None)
    assert rows[8].total_quantity_sold == 0


def test_customer_with_a_third_of_all_orders(spark, customers):
    rows = spark.range(30_000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 10).otherwise(20 + F.col("id") % 20_000).alias("o_custkey"),
        F.lit(12.34).alias("o_totalprice"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
    )
    hot = customer_totals(rows, customers).where("customer_id = 10").first()
    assert (hot.total_orders, hot.lifetime_value) == (10_000, Decimal("123400.00"))
    assert hot.avg_order_value == Decimal("12.34")


def test_order_with_a_third_of_all_lines_is_split(spark):
    """With thresholds of kilobytes, as with the real ones on a cluster."""
    key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50_000).cast("bigint")
    lines = spark.range(300_000).select(
        key.alias("l_orderkey"),
        (F.col("id") % 1000).alias("l_partkey"),
        F.lit(1.0).alias("l_quantity"),
        F.lit(10.0).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"),
    )
    days = F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate")
    orders = spark.range(50_000).select(F.col("id").alias("o_orderkey"), days)
    parts = spark.range(1000).select(
        F.col("id").alias("p_partkey"),
        F.lit("x").alias("p_name"),
        F.lit("SMALL").alias("p_type"),
        F.lit(1).alias("p_size"),
        F.lit(1.0).alias("p_retailprice"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        products = product_performance(lines, orders, parts)
        rows = products.collect()
        plan = products._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert {(r.total_quantity_sold, r.total_revenue) for r in rows} == {(300, Decimal("2700.00"))}
    assert "SortMergeJoin(skew=true)" in plan


def test_unsold_parts_stay(spark, orders):
    lines = spark.createDataFrame(
        [(1, 7, 2.0, 10.0, 0.1), (3, 7, 1.0, 5.05, 0.0), (99, 7, 1.0, 1000.0, 0.0)],
        "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
        "l_discount double",
    )
    parts = spark.createDataFrame(
        [(7, "bolt", "SMALL", 3, 900.1), (8, "nut", "LARGE", 50, 1.0)],
        "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    )
    rows = {r.product_id: r for r in product_performance(lines, orders, parts).collect()}
    assert rows[7].total_quantity_sold == 4  # a line without an order counts as sold
    assert rows[7].total_revenue == Decimal("1014.05")
    assert rows[7].last_sale_date == date(2024, 1, 3)
    assert (rows[8].total_quantity_sold, rows[8].total_revenue) == (0, Decimal("0.00"))
    assert rows[8].last_sale_date is None
    assert (rows[8].category, rows[8].units_in_stock) == ("LARGE", 50)


def test_stored_marts_answer_every_question_alike(spark):
    computed = Marts(spark, SMALL)
    stored = computed.save(new_dir(spark, "marts"))
    for question in TESTED.values():
        left = sorted(map(str, question.run(computed).collect()))
        right = sorted(map(str, question.run(stored).collect()))
        assert left == right, question.key


def test_facts_are_scanned_narrowly(spark):
    plan = Marts(spark, SMALL).products._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "o_totalprice" not in plan and "CartesianProduct" not in plan
    month = TESTED["q06_month_revenue"].run(Marts(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2000-12-01T00:00)" in month
