"""The business questions over the marts.

Each question is a function from :class:`Marts` to a DataFrame. Periods, limits and
thresholds are parameters. Every ranking ends with the key, so ties are settled.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.calendar import iso_weekday, month_start
from lakemart.functions.money import percent, ratio
from lakemart.plans.marts import Marts


def _amount() -> Column:
    return F.sum("total_amount")


def _orders() -> Column:
    return F.sum("order_count")


def _month(first: date) -> Column:
    """Rows of one calendar month, bounds included."""
    start = F.lit(first)
    return F.col("sale_date").between(start, F.last_day(start))


def _top(df: DataFrame, by: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(by), key).limit(n)


# counts, totals and extremes


def sales_rows(m: Marts) -> DataFrame:
    return m.sales.agg(F.count("*").alias("row_count"))


def max_daily_revenue(m: Marts) -> DataFrame:
    return m.sales.agg(F.max("total_amount").alias("max_revenue"))


def customer_count(m: Marts) -> DataFrame:
    return m.customer_totals.agg(F.count("*").alias("customer_count"))


def average_check(m: Marts) -> DataFrame:
    """Revenue over orders, so that a busy day weighs more than a quiet one."""
    return m.sales.agg(ratio(_amount(), _orders()).alias("avg_check"))


def category_products(m: Marts, category: str = "Электроника") -> DataFrame:
    return m.products.where(F.col("category") == category).agg(
        F.count("*").alias("product_count")
    )


# filters


def month_revenue(m: Marts, month: date = date(2024, 12, 1)) -> DataFrame:
    return m.sales.where(_month(month)).agg(_amount().alias("revenue"))


def recent_orders(m: Marts, days: int = 7) -> DataFrame:
    return m.sales_from(m.days_back(days)).agg(_orders().alias("order_count"))


def low_stock(m: Marts, limit: int = 20) -> DataFrame:
    return m.products.where(F.col("units_in_stock") < limit).select(
        "product_id", "product_name", "units_in_stock"
    )


def vip_count(m: Marts) -> DataFrame:
    return m.customers.where(F.col("customer_segment") == "VIP").agg(
        F.count("*").alias("vip_count")
    )


def recent_revenue(m: Marts, days: int = 30) -> DataFrame:
    return m.sales_from(m.days_back(days)).agg(_amount().alias("revenue"))


# rankings


def top_customers(m: Marts, n: int = 5) -> DataFrame:
    rows = m.customer_totals.select("customer_id", "customer_name", "lifetime_value")
    return _top(rows, "lifetime_value", "customer_id", n)


def top_products(m: Marts, n: int = 3) -> DataFrame:
    rows = m.products.select("product_id", "product_name", "total_revenue")
    return _top(rows, "total_revenue", "product_id", n)


def top_days(m: Marts, n: int = 10) -> DataFrame:
    return _top(m.sales.select("sale_date", "total_amount"), "total_amount", "sale_date", n)


def most_expensive_products(m: Marts, n: int = 5) -> DataFrame:
    rows = m.products.select("product_id", "product_name", "avg_price")
    return _top(rows, "avg_price", "product_id", n)


def highest_check_customers(m: Marts, n: int = 3) -> DataFrame:
    rows = m.customer_totals.select("customer_id", "customer_name", "avg_order_value")
    return _top(rows, "avg_order_value", "customer_id", n)


# groupings


def segment_value(m: Marts) -> DataFrame:
    return m.customers.groupBy("customer_segment").agg(
        ratio(F.sum("lifetime_value"), F.count("*")).alias("avg_ltv")
    )


def products_per_category(m: Marts) -> DataFrame:
    return m.products.groupBy("category").agg(F.count("*").alias("product_count"))


def monthly_revenue(m: Marts, year: int = 2024) -> DataFrame:
    in_year = F.col("sale_date").between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31)))
    return (
        m.sales.where(in_year)
        .groupBy(month_start("sale_date").alias("month"))
        .agg(_amount().alias("revenue"))
        .orderBy("month")
    )


def weekday_check(m: Marts) -> DataFrame:
    return (
        m.sales.groupBy(iso_weekday("sale_date").alias("weekday"))
        .agg(ratio(_amount(), _orders()).alias("avg_check"))
        .orderBy("weekday")
    )


def segment_distribution(m: Marts) -> DataFrame:
    """The window sees one row per segment."""
    counts = m.customers.groupBy("customer_segment").agg(F.count("*").alias("customer_count"))
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return counts.withColumn("pct", percent(F.col("customer_count"), everyone))


# statistics


def last_month_check(m: Marts, months: int = 1) -> DataFrame:
    return m.sales_from(m.months_back(months)).agg(ratio(_amount(), _orders()).alias("avg_check"))


def median_daily_revenue(m: Marts) -> DataFrame:
    """One value per calendar day, so the exact median is bounded."""
    return m.sales.agg(F.median(F.col("total_amount").cast("double")).alias("median_revenue"))


def vip_percent(m: Marts) -> DataFrame:
    vip = F.count_if(F.col("customer_segment") == "VIP")
    return m.customers.agg(percent(vip, F.count("*")).alias("vip_pct"))


def total_revenue(m: Marts) -> DataFrame:
    return m.sales.agg(_amount().alias("revenue"))


def orders_per_customer(m: Marts) -> DataFrame:
    return m.customer_totals.agg(ratio(F.sum("total_orders"), F.count("*")).alias("avg_orders"))


# several conditions


def category_revenue_above(
    m: Marts, category: str = "Электроника", limit: int = 100_000
) -> DataFrame:
    wanted = (F.col("category") == category) & (F.col("total_revenue") > limit)
    return m.products.where(wanted).select("product_id", "product_name", "total_revenue")


def frequent_buyers(m: Marts, orders: int = 10, value: int = 50_000) -> DataFrame:
    wanted = (F.col("total_orders") > orders) & (F.col("lifetime_value") > value)
    return m.customer_totals.where(wanted).select(
        "customer_id", "customer_name", "total_orders", "lifetime_value"
    )


def strong_days(m: Marts, orders: int = 50) -> DataFrame:
    average = m.sales.agg(ratio(_amount(), F.count("*")).alias("average")).scalar()
    wanted = (F.col("total_amount").cast("double") > average) & (F.col("order_count") > orders)
    return m.sales.where(wanted).select("sale_date", "total_amount", "order_count")


def unsold_products(m: Marts, days: int = 30) -> DataFrame:
    last = F.col("last_sale_date")
    return m.products.where(last.isNull() | (last < m.days_back(days))).select(
        "product_id", "product_name", "last_sale_date"
    )


def top_products_per_category(m: Marts, n: int = 3) -> DataFrame:
    """The limit per category is applied before the shuffle as well as after it."""
    ranked = Window.partitionBy("category").orderBy(F.desc("total_revenue"), "product_id")
    return (
        m.products.select("category", "product_id", "product_name", "total_revenue")
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= n)
    )


# time


def recent_sales(m: Marts, days: int = 30) -> DataFrame:
    return (
        m.sales_from(m.days_back(days))
        .select("sale_date", "total_amount", "order_count")
        .orderBy("sale_date")
    )


def compare_months(
    m: Marts, month: date = date(2024, 12, 1), previous: date = date(2024, 11, 1)
) -> DataFrame:
    def revenue(first: date) -> Column:
        return F.coalesce(F.sum(F.when(_month(first), F.col("total_amount"))), F.lit(0))

    both = m.sales.where(_month(month) | _month(previous)).agg(
        revenue(month).alias("revenue"), revenue(previous).alias("previous_revenue")
    )
    difference = F.col("revenue") - F.col("previous_revenue")
    return both.select(
        "revenue",
        "previous_revenue",
        difference.alias("difference"),
        percent(difference, F.col("previous_revenue")).alias("change_pct"),
    )


def best_weekday(m: Marts) -> DataFrame:
    days = m.sales.groupBy(iso_weekday("sale_date").alias("weekday")).agg(
        ratio(_amount(), F.count("*")).alias("avg_revenue")
    )
    return _top(days, "avg_revenue", "weekday", 1)


def best_month(m: Marts) -> DataFrame:
    months = m.sales.groupBy(month_start("sale_date").alias("month")).agg(_amount().alias("revenue"))
    return _top(months, "revenue", "month", 1)


def check_by_month(m: Marts) -> DataFrame:
    """The window sees one row per month."""
    months = m.sales.groupBy(month_start("sale_date").alias("month")).agg(
        ratio(_amount(), _orders()).alias("avg_check")
    )
    before = F.lag("avg_check").over(Window.orderBy("month"))
    return months.withColumn("change", F.col("avg_check") - before)


# analysis


def inactive_customers(m: Marts, days: int = 30) -> DataFrame:
    return m.customer_totals.where(F.col("last_order_date") < m.days_back(days)).select(
        "customer_id", "customer_name", "last_order_date"
    )


def running_out(m: Marts, limit: int = 20) -> DataFrame:
    return low_stock(m, limit).orderBy("units_in_stock", "product_id")


def vip_revenue_share(m: Marts) -> DataFrame:
    value = F.col("lifetime_value")
    vip = F.sum(F.when(F.col("customer_segment") == "VIP", value).otherwise(F.lit(0)))
    return m.customers.agg(percent(vip, F.sum(value)).alias("vip_share"))


def category_revenue(m: Marts) -> DataFrame:
    return (
        m.products.groupBy("category")
        .agg(F.sum("total_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def repeat_buyer_percent(m: Marts, orders: int = 5) -> DataFrame:
    repeat = F.count_if(F.col("total_orders") > orders)
    return m.customer_totals.agg(percent(repeat, F.count("*")).alias("repeat_pct"))


# further published questions


def average_daily_revenue(m: Marts) -> DataFrame:
    return m.sales.agg(ratio(_amount(), F.count("*")).alias("avg_revenue"))


def orders_yesterday(m: Marts) -> DataFrame:
    return m.sales_from(m.days_back(1)).agg(_orders().alias("order_count"))


def all_sales(m: Marts) -> DataFrame:
    return m.sales
