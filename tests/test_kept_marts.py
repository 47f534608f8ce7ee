"""Marts kept up by loads against marts computed from all facts."""

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL

from lakemart.functions.calendar import day
from lakemart.operators.percentiles import value_counters
from lakemart.plans import kept_marts
from lakemart.plans.kept_marts import KeptMarts
from lakemart.plans.marts import Marts, in_cents
from lakemart.plans.registry import TESTED
from lakemart.session import new_dir, path_exists
from lakemart.sources.tables import read_table

NAMES = ["sales", "customers", "products"]


def facts(spark, number, loads):
    orders, lines = (read_table(spark, SMALL, name) for name in ("orders", "lineitem"))
    late = F.col("l_orderkey") + F.col("l_linenumber") % 2
    return (
        orders.where(F.col("o_orderkey") % loads == number),
        lines.where(late % loads == number),
    )


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def whole(spark):
    marts = Marts(spark, SMALL)
    return {name: rows(getattr(marts, name)) for name in NAMES}


def equal(marts, whole):
    return all(rows(getattr(marts, name)) == whole[name] for name in NAMES)


def test_loads_add_up(spark, whole, tmp_path):
    marts = KeptMarts(spark, new_dir(spark, "kept"), SMALL)
    with pytest.raises(ValueError):
        marts.sales.count()
    for number in range(3):
        # facts of earlier loads are not there any more: a load reads its own only
        folder = tmp_path / f"facts-{number}"
        for name, df in zip(("orders", "lineitem"), facts(spark, number, 3)):
            df.write.parquet(f"{folder}/{name}")
        own = [spark.read.parquet(f"{folder}/{name}") for name in ("orders", "lineitem")]
        marts.add(*own, f"day-{number}")
        folder.rename(tmp_path / f"away-{number}")
        counters = value_counters(marts.customer_totals, in_cents()).where("n <> 0")
        assert rows(marts.kept("counters").where("n <> 0")) == rows(counters)
    assert equal(marts, whole)
    for number in range(3):
        marts.add(*facts(spark, number, 3), f"day-{number}")  # repeated
    assert equal(marts, whole) and marts.loads() == [f"day-{n}" for n in range(3)]


def test_dead_load_is_not_seen(spark, whole, monkeypatch):
    marts = KeptMarts(spark, new_dir(spark, "kept"), SMALL)
    marts.add(*facts(spark, 0, 2), "a")
    before = rows(marts.sales)
    with monkeypatch.context() as patch:
        patch.setattr(KeptMarts, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            marts.add(*facts(spark, 1, 2), "b")
    assert rows(marts.sales) == before and marts.loads() == ["a"]
    marts.add(*facts(spark, 1, 2), "b")
    assert equal(marts, whole)


def test_many_loads_are_merged(spark, whole, monkeypatch):
    monkeypatch.setattr(kept_marts, "MOST_LOADS", 2)
    marts = KeptMarts(spark, new_dir(spark, "kept"), SMALL)
    for number in range(5):
        marts.add(*facts(spark, number, 5), f"day-{number}")
        assert len(marts.loads()) <= 2
    assert equal(marts, whole)
    marts.compact()
    assert marts.kept("early_lines").isEmpty()  # all orders have come
    marts.add(*facts(spark, 0, 5), "day-0")  # known, though replaced
    marts.remove_replaced()
    assert not path_exists(spark, f"{marts.folder}/loads/day-0")
    assert equal(marts, whole) and len(marts.loads()) == 1


def test_questions_on_kept_marts(spark):
    marts = KeptMarts(spark, new_dir(spark, "kept"), SMALL)
    for number in range(2):
        marts.add(*facts(spark, number, 2), f"day-{number}")
    plain = Marts(spark, SMALL)
    for key in ("q10_revenue_last_days", "q20_segment_distribution", "q29_not_sold_recently"):
        name = next((k for k in TESTED if k.startswith(key.split("_")[0] + "_")), key)
        assert rows(TESTED[name].run(marts)) == rows(TESTED[name].run(plain))


def test_lines_of_no_order_and_empty_loads(spark):
    marts = KeptMarts(spark, new_dir(spark, "kept"), SMALL)
    orders, lines = facts(spark, 0, 1)
    marts.add(orders.limit(0), lines.limit(0), "empty")
    assert marts.sales.isEmpty() and marts.customers.isEmpty()
    assert marts.products.where("last_sale_date IS NOT NULL").isEmpty()
    some = lines.where("l_orderkey % 2 = 0")
    marts.add(orders.where("o_orderkey % 2 = 1"), some, "lines without orders")
    assert marts.products.where("last_sale_date IS NOT NULL").isEmpty()
    assert not marts.products.where("total_quantity_sold > 0").isEmpty()
    marts.add(orders.where("o_orderkey % 2 = 0"), lines.limit(0), "their orders")
    wanted = some.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_partkey")
    wanted = wanted.agg(F.max(day("o_orderdate")).alias("last_sale_date"))
    assert rows(marts.kept("last_sales")) == rows(wanted)
