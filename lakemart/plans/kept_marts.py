"""Marts kept up with new facts: each load is summed up once, and merged when it is read.

Layout below the folder::

    loads/<load>/days          sums and counts of each order day
    loads/<load>/customers     sums, counts and dates of each customer
    loads/<load>/products      quantity and revenue of each part
    loads/<load>/last_sales    last order day of each part
    loads/<load>/order_days    day of each order, for lines that come later
    loads/<load>/early_lines   lines whose order had not come yet
    loads/<load>/counters      change of the lifetime value counters that place the segments
    log/                       one row for each load: its name and the loads it replaces

A load reads the new facts and, of what is kept, only sums of the customers it touches, and
days of orders that its lines miss. The log row is written last, so a load that died is never
read, and a load whose name is known adds nothing.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.calendar import day
from lakemart.functions.money import TOTAL, exact_sum, half_up_average, units
from lakemart.operators.percentiles import value_counters
from lakemart.plans.marts import (
    Marts,
    described_customers,
    described_products,
    in_cents,
    with_segment,
)
from lakemart.session import remove_dir
from lakemart.sources.tables import path_missing, read_table

MOST_LOADS = 16
WHOLE = "decimal(26,4)"
LOG = "load string, replaces array<string>, committed_at timestamp"

# Key and merge of each kept table; sums of decimals are exact, whatever their order.
_SUM, _MIN, _MAX = "sum", "min", "max"
STATES: dict[str, tuple[list[str], dict[str, str]]] = {
    "days": (["sale_date"], {"total_amount": _SUM, "order_count": _SUM}),
    "customers": (
        ["o_custkey"],
        {
            "total_orders": _SUM,
            "lifetime_value": _SUM,
            "first_order_date": _MIN,
            "last_order_date": _MAX,
        },
    ),
    "products": (["l_partkey"], {"quantity": _SUM, "revenue": _SUM}),
    "last_sales": (["l_partkey"], {"last_sale_date": _MAX}),
    "order_days": (["o_orderkey"], {"order_date": _MAX}),
    "early_lines": (["l_orderkey", "l_partkey"], {}),
    "counters": (["low"], {"n": _SUM}),
}


def merged(parts: DataFrame, name: str) -> DataFrame:
    """Kept rows of some loads as one row for each key; tasks sum up what they read first."""
    key, facts = STATES[name]
    if not facts:
        return parts.distinct()
    kinds = dict(parts.dtypes)
    made = [
        getattr(F, how)(fact).cast(kinds[fact]).alias(fact) for fact, how in facts.items()
    ]
    return parts.groupBy(*key).agg(*made)


class KeptMarts(Marts):
    """Marts over loads of ``orders`` and ``lineitem``; customers and parts are given whole.

    The tables of ``dimensions`` stay as they are while loads are kept: the counters that place
    the segments count customers known when their orders came.
    """

    def __init__(self, spark: SparkSession, folder: str, dimensions: str):
        super().__init__(spark, folder)
        self.dimensions = dimensions

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.folder}/log")
        except AnalysisException as error:
            if not path_missing(error):
                raise
            return self.spark.createDataFrame([], LOG)

    def loads(self) -> list[str]:
        """Names of the loads to read: those no later one replaces, a bounded number."""
        log = self._log()
        gone = log.select(F.explode("replaces").alias("load"))
        return sorted(r.load for r in log.join(gone, "load", "left_anti").distinct().collect())

    def _parts(self, name: str, loads: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder}/loads/{load}/{name}" for load in loads])

    def kept(self, name: str) -> DataFrame:
        """One of the kept tables, merged over all loads."""
        loads = self.loads()
        if not loads:
            raise ValueError("nothing is loaded")
        return merged(self._parts(name, loads), name)

    def _dimension(self, name: str) -> DataFrame:
        return read_table(self.spark, self.dimensions, name)

    def add(self, orders: DataFrame, lineitem: DataFrame, load: str) -> None:
        """Sum up new orders and lines as a load of the given name.

        Lines may come before, with or after their order; an order comes once.
        """
        if not self._log().where(F.col("load") == load).isEmpty():
            return
        before = self.loads()
        if len(before) >= MOST_LOADS:
            before = [self.compact()]
        path = f"{self.folder}/loads/{load}"

        def written(rows: DataFrame, name: str) -> DataFrame:
            rows.write.mode("overwrite").parquet(f"{path}/{name}")
            return self._parts(name, [load])

        cents = exact_sum(units("o_totalprice"), 2)

        def of_days() -> None:
            daily = orders.groupBy(day("o_orderdate").alias("sale_date"))
            facts = [cents.alias("total_amount"), F.count("*").alias("order_count")]
            written(daily.agg(*facts), "days")

        def of_customers() -> None:
            totals = orders.groupBy("o_custkey").agg(
                F.count("*").alias("total_orders"),
                cents.alias("lifetime_value"),
                F.min("o_orderdate").cast("date").alias("first_order_date"),
                F.max("o_orderdate").cast("date").alias("last_order_date"),
            )
            touched = written(totals, "customers")
            written(self._counter_changes(touched, before), "counters")

        def of_products() -> None:
            net = units("l_extendedprice") * (F.lit(100) - units("l_discount"))
            sold = lineitem.groupBy("l_partkey").agg(
                exact_sum(units("l_quantity"), 2).alias("quantity"),
                exact_sum(net, 4, WHOLE).alias("revenue"),  # rounded once, when it is read
            )
            written(sold, "products")

        def of_last_sales() -> None:
            dates = orders.select("o_orderkey", day("o_orderdate").alias("order_date"))
            dates = written(dates, "order_days")
            lines = lineitem.select("l_orderkey", "l_partkey")
            ordered = F.col("l_orderkey") == F.col("o_orderkey")
            missed = lines.join(dates, ordered, "left_anti").distinct()
            missed = written(missed, "early_lines")
            found = lines.join(dates, ordered).select("l_partkey", "order_date")
            if before:
                early = self._parts("early_lines", before).join(dates, ordered)
                found = found.unionByName(early.select(*found.columns))
                if not missed.isEmpty():
                    known = missed.join(self._parts("order_days", before), ordered)
                    found = found.unionByName(known.select(*found.columns))
            last = found.groupBy("l_partkey").agg(F.max("order_date").alias("last_sale_date"))
            written(last, "last_sales")

        # tables that don't wait for each other are written at the same time
        with ThreadPoolExecutor(4) as pool:
            work = [pool.submit(w) for w in (of_days, of_customers, of_products, of_last_sales)]
        for done in work:
            done.result()
        self._commit(load, [])

    def _counter_changes(self, touched: DataFrame, before: list[str]) -> DataFrame:
        """Counters of the touched customers' new totals, less those of their old ones."""
        known = self._dimension("customer").select(F.col("c_custkey").alias("o_custkey"))
        touched = touched.select("o_custkey", "lifetime_value").join(known, "o_custkey", "left_semi")
        new, old = touched, None
        if before:
            keys = touched.select("o_custkey")
            kept = self._parts("customers", before).select("o_custkey", "lifetime_value")
            kept = kept.join(keys, "o_custkey", "left_semi")
            old = kept.groupBy("o_custkey").agg(
                F.sum("lifetime_value").cast(TOTAL).alias("lifetime_value")
            )
            new = old.unionByName(touched).groupBy("o_custkey").agg(
                F.sum("lifetime_value").cast(TOTAL).alias("lifetime_value")
            )
        changes = value_counters(new, in_cents())
        if old is not None:
            less = value_counters(old, in_cents()).withColumn("n", -F.col("n"))
            changes = changes.unionByName(less).groupBy("low").agg(F.sum("n").alias("n"))
        return changes.where("n <> 0")

    def _commit(self, load: str, replaces: list[str]) -> None:
        row = self.spark.createDataFrame([(load, replaces)], "load string, replaces array<string>")
        row = row.withColumn("committed_at", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/log")
        for name in ("sales", "as_of", "customer_totals", "customers", "products"):
            self.__dict__.pop(name, None)

    def compact(self) -> str:
        """Merge all loads into one, which replaces them; returns its name.

        Lines whose order has come meanwhile are no longer early, and counters at 0 go.
        """
        loads, load = self.loads(), f"merged-{uuid.uuid4().hex}"
        for name in STATES:
            rows = merged(self._parts(name, loads), name)
            if name == "early_lines":
                days = self._parts("order_days", loads)
                rows = rows.join(days, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
            elif name == "counters":
                rows = rows.where("n <> 0")
            rows.write.parquet(f"{self.folder}/loads/{load}/{name}")
        self._commit(load, loads)
        return load

    def remove_replaced(self) -> None:
        """Remove the folders of loads that others replace, once nothing reads them."""
        gone = self._log().select(F.explode("replaces").alias("load")).distinct()
        for row in gone.toLocalIterator():
            remove_dir(self.spark, f"{self.folder}/loads/{row.load}")

    @cached_property
    def sales(self) -> DataFrame:
        daily = self.kept("days")
        return daily.withColumn("avg_order_value", half_up_average("total_amount", "order_count"))

    @cached_property
    def as_of(self) -> DataFrame:
        return self._parts("days", self.loads()).agg(
            F.date_add(F.max("sale_date"), 1).alias("as_of")
        )

    @cached_property
    def customer_totals(self) -> DataFrame:
        return described_customers(self.kept("customers"), self._dimension("customer"))

    @cached_property
    def customers(self) -> DataFrame:
        return with_segment(self.customer_totals, self.kept("counters"))

    @cached_property
    def products(self) -> DataFrame:
        sold = self.kept("products").withColumn("revenue", F.col("revenue").cast(TOTAL))
        sold = sold.withColumnRenamed("l_partkey", "sold_part")
        dated = self.kept("last_sales").withColumnRenamed("l_partkey", "dated_part")
        return described_products(sold, dated, self._dimension("part"))

    def sales_from(self, first_day: Column) -> DataFrame:
        """Days from ``first_day`` on; the bound reaches the scan of the kept days."""
        rows = self._parts("days", self.loads()).where(F.col("sale_date") >= first_day)
        return merged(rows, "days").withColumn(
            "avg_order_value", half_up_average("total_amount", "order_count")
        )
