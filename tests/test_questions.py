"""Values worked out beforehand on the medium test tables."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tests.conftest import MEDIUM, SMALL

from lakemart.plans import questions as q
from lakemart.plans.ask import ask, run_suite, show
from lakemart.plans.corpus import BY_TEXT, QUESTIONS, VARIANTS, questions_by_difficulty
from lakemart.plans.registry import TESTED
from lakemart.plans.marts import Marts


@pytest.fixture(scope="module")
def marts(spark):
    return Marts(spark, MEDIUM)


VALUES = {
    "q01_sales_rows": 2399,
    "q02_max_daily_revenue": Decimal("4272218.02"),
    "q03_customer_count": 1500,
    "q04_average_check": 250562.64133733333,
    "q05_category_products": 331,
    "q06_month_revenue": Decimal("48838753.25"),
    "q07_recent_orders": 52,
    "q09_vip_count": 300,
    "q10_recent_revenue": Decimal("50088615.34"),
    "q21_last_month_check": 259532.2003030303,
    "q22_median_daily_revenue": 1500030.12,
    "q23_vip_percent": 20.0,
    "q24_total_revenue": Decimal("3758439620.06"),
    "q25_orders_per_customer": 10.0,
    "q38_vip_revenue_share": 30.775484544874367,
    "q40_repeat_buyer_percent": 92.93333333333334,
    "q41_average_daily_revenue": 1566669.2872280118,
    "q42_orders_yesterday": 2,
}

ROWS = {
    "q08_low_stock": 761,
    "q18_monthly_revenue": 12,
    "q20_segment_distribution": 3,
    "q26_category_revenue_above": 160,
    "q27_frequent_buyers": 624,
    "q28_strong_days": 877,
    "q29_unsold_products": 1376,
    "q30_top_products_per_category": 18,
    "q31_recent_sales": 30,
    "q35_check_by_month": 80,
    "q36_inactive_customers": 1324,
    "q37_running_out": 761,
}


@pytest.mark.parametrize("key", VALUES)
def test_single_values(marts, key):
    assert TESTED[key].run(marts).first()[0] == VALUES[key]


@pytest.mark.parametrize("key", ROWS)
def test_row_counts(marts, key):
    assert TESTED[key].run(marts).count() == ROWS[key]


def test_comparison_of_months(marts):
    row = TESTED["q32_compare_months"].run(marts).first()
    assert (row.revenue, row.previous_revenue) == (Decimal("48838753.25"), Decimal("50541089.82"))
    assert row.difference == Decimal("-1702336.57")


def test_best_weekday_and_month(marts):
    weekday = TESTED["q33_best_weekday"].run(marts).first()
    assert (weekday.weekday, weekday.avg_revenue) == (6, 1629424.4598529413)
    month = TESTED["q34_best_month"].run(marts).first()
    assert (month.month, month.revenue) == (date(1995, 7, 1), Decimal("55704459.55"))


def test_parameters(marts):
    assert q.top_customers(marts, n=3).count() == 3
    assert q.month_revenue(marts).first().revenue is None  # no sales in the published month
    assert q.compare_months(marts).first().change_pct is None


def test_published_and_tested_parameters():
    published = {question.key: question for question in QUESTIONS}
    assert "DATE '2024-12-01'" in published["q06_month_revenue"].sql
    assert "DATE '2000-12-01'" in TESTED["q06_month_revenue"].sql
    assert published["q26_category_revenue_above"].options["limit"] == 100_000
    assert all("{" not in question.sql for question in [*QUESTIONS, *VARIANTS])


def test_other_wordings(marts):
    assert len(BY_TEXT) == len(QUESTIONS) + len(VARIANTS)
    assert BY_TEXT["Покажи топ-3 клиента по сумме покупок"].run(marts).count() == 3
    assert BY_TEXT["Топ-5 клиентов по сумме покупок"].run(marts).count() == 5
    assert BY_TEXT["Какой топ-5 товаров?"].run(marts).count() == 5


def test_suite_sets():
    assert len(QUESTIONS) == 44
    assert [len(questions_by_difficulty(d)) for d in ("easy", "medium", "hard")] == [10, 15, 15]
    assert len(questions_by_difficulty("anything")) == 40


def test_ask_gives_rows_and_chart(spark):
    marts = Marts(spark, SMALL)
    ranking = ask(marts, "Топ-10 дней с максимальной выручкой")
    assert ranking.chart["chart_type"] == "line"
    assert ranking.chart["title"] == "Топ-10 дней с максимальной выручкой"
    assert ranking.chart_rows.count() == ranking.rows.count() == 10
    single = ask(marts, "Сколько клиентов в базе данных?")
    assert single.chart["chart_type"] == "none" and single.chart_rows is None
    top = ask(marts, "Какие 3 товара принесли больше всего выручки?")
    assert top.chart["chart_type"] == "bar" and top.chart["x_column"] == "product_name"
    assert top.chart["y_column"] == "product_id"  # the first numeric column, as published
    shown = [r.product_id for r in top.chart_rows.orderBy("place").collect()]
    ranked = top.rows.orderBy(F.desc("total_revenue"), "product_id").collect()
    assert shown == [r.product_id for r in ranked]


@pytest.mark.parametrize("kind", ["bar", "horizontal_bar"])
def test_chart_shows_the_first_rows_of_the_result(spark, kind):
    """Sixty rows, of which the first twenty in result order are shown."""
    name = "long name of a product" if kind == "horizontal_bar" else "n"
    rows = spark.range(60).repartition(7).select(
        F.concat(F.lit(name), F.col("id")).alias("label"), (F.col("id") * 37 % 60).alias("v")
    )
    ordered = rows.orderBy(F.desc("v"))
    with show(ordered, "топ товаров", "SELECT label, v FROM t ORDER BY v DESC LIMIT 60") as answer:
        assert answer.chart["chart_type"] == kind
        shown = sorted((r.place, r.v) for r in answer.chart_rows.collect())
    assert shown == [(n + 1, 59 - n) for n in range(20)]
    assert not answer.rows.is_cached


def test_show_any_result(spark):
    values = [("a", 1), ("a", 2), ("b", 3), ("b", 4), ("b", 5)]
    rows = spark.createDataFrame(values, "k string, n int")
    answer = show(rows, "доля", "")
    assert answer.chart["chart_type"] == "pie"
    assert sum(r.pct for r in answer.chart_rows.collect()) == pytest.approx(100)


def test_suite_records_failures(spark):
    from dataclasses import replace

    from lakemart.operators.stats import suite_statistics

    marts = Marts(spark, SMALL)
    good = QUESTIONS[0]
    bad = replace(good, plan=lambda m: m.sales.selectExpr("raise_error('broken')"))
    results = run_suite(marts, [good, bad], {good.text: "row_count"}, model="plans")
    stats = suite_statistics(results).first()
    assert (stats.total_queries, stats.successful, stats.failed) == (2, 1, 1)
    first, second = results.orderBy(F.desc("success")).collect()
    assert "row_count" in first.answer and first.matches_expected and first.model == "plans"
    assert first.timestamp is not None and first.expected == "row_count"
    assert second.answer is None and not second.matches_expected and "broken" in second.error
    assert stats.success_rate == 50.0


def test_suite_judges_the_whole_result(spark):
    from dataclasses import replace

    marts = Marts(spark, SMALL)
    many = replace(QUESTIONS[0], plan=lambda m: spark.range(40).selectExpr("concat('V', id) AS v"))
    for wanted, found in (("v37", True), ("v40", False)):
        row = run_suite(marts, [many], {many.text: wanted}).first()
        assert row.matches_expected is found and row.answer.count("\n") == 4
    none = replace(many, plan=lambda m: spark.range(0).selectExpr("id"))
    assert run_suite(marts, [none], {many.text: "1"}).first().matches_expected is False
    assert run_suite(marts, [many]).first().matches_expected is None
