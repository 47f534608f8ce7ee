"""The three analytical marts, computed from order facts or read back from storage."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.calendar import day
from lakemart.functions.money import TOTAL, exact_sum, half_up_average, price, units
from lakemart.operators.percentiles import exact_percentiles
from lakemart.session import remove_dir
from lakemart.sources.tables import read_table

VIP_FRACTION = 0.80
REGULAR_FRACTION = 0.24


def sales_summary(orders: DataFrame) -> DataFrame:
    """One row per order day. Partial sums leave each task, so a hot day costs nothing extra."""
    daily = orders.groupBy(day("o_orderdate").alias("sale_date")).agg(
        exact_sum(units("o_totalprice"), 2).alias("total_amount"),
        F.count("*").alias("order_count"),
    )
    return daily.withColumn("avg_order_value", half_up_average("total_amount", "order_count"))


def as_of(orders: DataFrame) -> DataFrame:
    """The day after the last sale: the anchor of every relative date (one row)."""
    return orders.agg(F.date_add(F.max("o_orderdate").cast("date"), 1).alias("as_of"))


def customer_totals(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Customers with orders, without the segment.

    Orders are aggregated before the join: both join sides then have one row per
    customer, so a customer holding a third of all orders does not skew the join.
    """
    totals = orders.groupBy("o_custkey").agg(
        F.count("*").alias("total_orders"),
        exact_sum(units("o_totalprice"), 2).alias("lifetime_value"),
        F.min("o_orderdate").cast("date").alias("first_order_date"),
        F.max("o_orderdate").cast("date").alias("last_order_date"),
    )
    return described_customers(totals, customer)


def described_customers(totals: DataFrame, customer: DataFrame) -> DataFrame:
    """Totals by ``o_custkey`` with the columns of the mart."""
    key = F.col("c_custkey")
    return totals.join(customer, totals.o_custkey == customer.c_custkey).select(
        key.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")).alias("email"),
        "total_orders",
        "lifetime_value",
        "first_order_date",
        "last_order_date",
        half_up_average("lifetime_value", "total_orders").alias("avg_order_value"),
    )



def in_cents() -> Column:
    return (F.col("lifetime_value") * 100).cast("bigint")


def with_segment(totals: DataFrame, counters: DataFrame | None = None) -> DataFrame:
    """VIP from the 80th percentile of lifetime value, Regular from the 24th, else New.

    The cuts read nothing but the values; their two passes share one shuffle of the totals.
    ``counters``, where they are kept, spare the first pass.
    """
    fractions = [VIP_FRACTION, REGULAR_FRACTION]
    cuts = exact_percentiles(totals, in_cents(), fractions, counters).scalar()
    value = in_cents().cast("double")
    segment = (
        F.when(value >= cuts[0], F.lit("VIP"))
        .when(value >= cuts[1], F.lit("Regular"))
        .otherwise(F.lit("New"))
    )
    return totals.withColumn("customer_segment", segment)


def product_performance(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """One row per part; parts never sold stay, with no last sale date.

    Quantity and revenue come from the lines alone, so a line without an order counts as sold;
    it has no date. Only the last sale date needs the orders: a question that does not ask for
    it neither joins nor reads them. Parts are summed before their shuffle, and an order
    holding very many lines is split by the adaptive skew join.
    """
    net = units("l_extendedprice") * (F.lit(100) - units("l_discount"))
    sold = lineitem.groupBy(F.col("l_partkey").alias("sold_part")).agg(
        exact_sum(units("l_quantity"), 2).alias("quantity"),
        exact_sum(net, 4).alias("revenue"),
    )
    dated = (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("l_partkey").alias("dated_part"))
        .agg(F.max("o_orderdate").cast("date").alias("last_sale_date"))
    )
    return described_products(sold, dated, part)


def described_products(sold: DataFrame, dated: DataFrame, part: DataFrame) -> DataFrame:
    """Sums by ``sold_part`` and last days by ``dated_part`` with the columns of the mart."""
    parts = part.join(sold, F.col("p_partkey") == F.col("sold_part"), "left")
    return parts.join(dated, F.col("p_partkey") == F.col("dated_part"), "left").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.coalesce("quantity", F.lit(0)).cast("bigint").alias("total_quantity_sold"),
        F.coalesce("revenue", F.lit(0).cast(TOTAL)).alias("total_revenue"),
        price("p_retailprice").alias("avg_price"),
        F.col("p_size").alias("units_in_stock"),
        "last_sale_date",
    )


class Marts:
    """Marts computed from the fact tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._facts: dict[str, DataFrame] = {}

    def _fact(self, name: str) -> DataFrame:
        if name not in self._facts:
            self._facts[name] = read_table(self.spark, self.folder, name)
        return self._facts[name]

    @cached_property
    def sales(self) -> DataFrame:
        return sales_summary(self._fact("orders"))

    @cached_property
    def as_of(self) -> DataFrame:
        return as_of(self._fact("orders"))

    @cached_property
    def customer_totals(self) -> DataFrame:
        return customer_totals(self._fact("orders"), self._fact("customer"))

    @cached_property
    def customers(self) -> DataFrame:
        return with_segment(self.customer_totals)

    @cached_property
    def products(self) -> DataFrame:
        return product_performance(
            self._fact("lineitem"), self._fact("orders"), self._fact("part")
        )

    def sales_from(self, first_day: Column) -> DataFrame:
        """Days from ``first_day`` on, filtered on the raw column so the scan can skip."""
        orders = self._fact("orders")
        return sales_summary(
            orders.where(F.col("o_orderdate") >= first_day.cast("timestamp_ntz"))
        )

    def days_back(self, days: int) -> Column:
        return F.date_sub(self.as_of.scalar(), days)

    def months_back(self, months: int) -> Column:
        return F.add_months(self.as_of.scalar(), -months)

    def save(self, target: str) -> "StoredMarts":
        """Write the marts once, so that questions read them instead of the facts.

        ``rebalance`` lets the adaptive engine size the files, also for a category with
        most of the products. Rows are sorted within files by the columns questions filter
        and rank on, so that row groups can be skipped by their statistics. The customer
        totals are read several times to place the segments: they are written first, below the
        target, and removed at the end.
        """
        self.sales.hint("rebalance").sortWithinPartitions("sale_date").write.mode(
            "overwrite"
        ).parquet(f"{target}/sales_summary")
        staged = f"{target}/_customer_totals"
        self.customer_totals.write.mode("overwrite").parquet(staged)
        customers = with_segment(self.spark.read.parquet(staged))
        customers.hint("rebalance").sortWithinPartitions(
            F.desc("lifetime_value")
        ).write.mode("overwrite").parquet(f"{target}/customer_stats")
        self.products.hint("rebalance", "category").sortWithinPartitions(
            "category", F.desc("total_revenue")
        ).write.mode("overwrite").parquet(f"{target}/product_performance")
        remove_dir(self.spark, staged)
        return StoredMarts(self.spark, target)


class StoredMarts(Marts):
    """The same marts read back from the folder :meth:`Marts.save` wrote."""

    @cached_property
    def sales(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/sales_summary")

    @cached_property
    def as_of(self) -> DataFrame:
        return self.sales.agg(F.date_add(F.max("sale_date"), 1).alias("as_of"))

    @cached_property
    def customers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/customer_stats")

    @cached_property
    def customer_totals(self) -> DataFrame:
        return self.customers.drop("customer_segment")

    @cached_property
    def products(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/product_performance")

    def sales_from(self, first_day: Column) -> DataFrame:
        return self.sales.where(F.col("sale_date") >= first_day)
