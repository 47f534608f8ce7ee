"""The question catalogue: published text, plan, and the SQL a log would show for it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date
from typing import Any

from pyspark.sql import DataFrame

from lakemart.plans import questions as q
from lakemart.plans.marts import Marts


@dataclass(frozen=True)
class Question:
    """``options`` are the published parameters; ``tested`` replaces some on the test tables,
    which cover other years, categories and volumes. The SQL is written over the same names.
    """

    key: str
    text: str
    plan: Callable[..., DataFrame]
    sql_text: str
    options: dict[str, Any] = field(default_factory=dict)
    tested: dict[str, Any] = field(default_factory=dict)

    @property
    def sql(self) -> str:
        return self.sql_text.format(**self.options)

    def run(self, marts: Marts) -> DataFrame:
        return self.plan(marts, **self.options)

    def on_test_tables(self) -> "Question":
        return replace(self, options={**self.options, **self.tested})


# The question texts are the published ones, in their published order.
QUESTIONS = [
    Question(
        "q01_sales_rows",
        "Сколько всего записей в таблице sales_summary?",
        q.sales_rows,
        "SELECT count(*) AS row_count FROM sales_summary",
    ),
    Question(
        "q02_max_daily_revenue",
        "Какая была максимальная выручка за один день?",
        q.max_daily_revenue,
        "SELECT max(total_amount) AS max_revenue FROM sales_summary",
    ),
    Question(
        "q03_customer_count",
        "Сколько клиентов в базе данных?",
        q.customer_count,
        "SELECT count(*) AS customer_count FROM customer_stats",
    ),
    Question(
        "q04_average_check",
        "Какое среднее значение чека?",
        q.average_check,
        "SELECT CAST(sum(total_amount) AS DOUBLE) / sum(order_count) AS avg_check "
        "FROM sales_summary",
    ),
    Question(
        "q05_category_products",
        "Сколько товаров в категории Электроника?",
        q.category_products,
        "SELECT count(*) AS product_count FROM product_performance WHERE category = '{category}'",
        {"category": "Электроника"},
        {"category": "PROMO"},
    ),
    Question(
        "q06_month_revenue",
        "Какая была выручка в декабре 2024?",
        q.month_revenue,
        "SELECT sum(total_amount) AS revenue FROM sales_summary "
        "WHERE sale_date >= DATE '{month}' AND sale_date <= last_day(DATE '{month}')",
        {"month": date(2024, 12, 1)},
        {"month": date(2000, 12, 1)},
    ),
    Question(
        "q07_recent_orders",
        "Сколько заказов было сделано в последние 7 дней?",
        q.recent_orders,
        "SELECT CAST(sum(order_count) AS BIGINT) AS order_count FROM sales_summary "
        "WHERE sale_date >= (SELECT as_of FROM anchor) - INTERVAL {days} DAY",
        {"days": 7},
    ),
    Question(
        "q08_low_stock",
        "Какие товары имеют остаток меньше 20 единиц?",
        q.low_stock,
        "SELECT product_id, product_name, units_in_stock FROM product_performance "
        "WHERE units_in_stock < {limit}",
        {"limit": 20},
    ),
    Question(
        "q09_vip_count",
        "Сколько VIP клиентов в базе?",
        q.vip_count,
        "SELECT count(*) AS vip_count FROM customer_stats WHERE customer_segment = 'VIP'",
    ),
    Question(
        "q10_recent_revenue",
        "Какая была выручка за последние 30 дней?",
        q.recent_revenue,
        "SELECT sum(total_amount) AS revenue FROM sales_summary "
        "WHERE sale_date >= (SELECT as_of FROM anchor) - INTERVAL {days} DAY",
        {"days": 30},
    ),
    Question(
        "q11_top_customers",
        "Покажи топ-5 клиентов по сумме покупок",
        q.top_customers,
        "SELECT customer_id, customer_name, lifetime_value FROM customer_stats "
        "ORDER BY lifetime_value DESC, customer_id LIMIT {n}",
        {"n": 5},
    ),
    Question(
        "q12_top_products",
        "Какие 3 товара принесли больше всего выручки?",
        q.top_products,
        "SELECT product_id, product_name, total_revenue FROM product_performance "
        "ORDER BY total_revenue DESC, product_id LIMIT {n}",
        {"n": 3},
    ),
    Question(
        "q13_top_days",
        "Топ-10 дней с максимальной выручкой",
        q.top_days,
        "SELECT sale_date, total_amount FROM sales_summary "
        "ORDER BY total_amount DESC, sale_date LIMIT {n}",
        {"n": 10},
    ),
    Question(
        "q14_most_expensive_products",
        "5 самых дорогих товаров по средней цене",
        q.most_expensive_products,
        "SELECT product_id, product_name, avg_price FROM product_performance "
        "ORDER BY avg_price DESC, product_id LIMIT {n}",
        {"n": 5},
    ),
    Question(
        "q15_highest_check_customers",
        "3 клиента с самым высоким средним чеком",
        q.highest_check_customers,
        "SELECT customer_id, customer_name, avg_order_value FROM customer_stats "
        "ORDER BY avg_order_value DESC, customer_id LIMIT {n}",
        {"n": 3},
    ),
    Question(
        "q16_segment_value",
        "Средний LTV клиентов по сегментам",
        q.segment_value,
        "SELECT customer_segment, CAST(sum(lifetime_value) AS DOUBLE) / count(*) AS avg_ltv "
        "FROM customer_stats GROUP BY customer_segment",
    ),
    Question(
        "q17_products_per_category",
        "Количество товаров в каждой категории",
        q.products_per_category,
        "SELECT category, count(*) AS product_count FROM product_performance GROUP BY category",
    ),
    Question(
        "q18_monthly_revenue",
        "Выручка по месяцам за 2024 год",
        q.monthly_revenue,
        "SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, "
        "sum(total_amount) AS revenue FROM sales_summary "
        "WHERE sale_date BETWEEN DATE '{year}-01-01' AND DATE '{year}-12-31' "
        "GROUP BY 1 ORDER BY 1",
        {"year": 2024},
        {"year": 2000},
    ),
    Question(
        "q19_weekday_check",
        "Средний чек по дням недели",
        q.weekday_check,
        "SELECT CAST(isodow(sale_date) AS INTEGER) AS weekday, "
        "CAST(sum(total_amount) AS DOUBLE) / sum(order_count) AS avg_check "
        "FROM sales_summary GROUP BY 1 ORDER BY 1",
    ),
    Question(
        "q20_segment_distribution",
        "Распределение клиентов по сегментам",
        q.segment_distribution,
        "SELECT customer_segment, count(*) AS customer_count, "
        "100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct "
        "FROM customer_stats GROUP BY customer_segment",
    ),
    Question(
        "q21_last_month_check",
        "Какой средний чек за последний месяц?",
        q.last_month_check,
        "SELECT CAST(sum(total_amount) AS DOUBLE) / sum(order_count) AS avg_check "
        "FROM sales_summary WHERE sale_date >= (SELECT as_of FROM anchor) - INTERVAL {months} MONTH",
        {"months": 1},
    ),
    Question(
        "q22_median_daily_revenue",
        "Какова медианная выручка за день?",
        q.median_daily_revenue,
        "SELECT median(CAST(total_amount AS DOUBLE)) AS median_revenue FROM sales_summary",
    ),
    Question(
        "q23_vip_percent",
        "Какой процент клиентов относится к VIP сегменту?",
        q.vip_percent,
        "SELECT 100.0::DOUBLE * count(*) FILTER (WHERE customer_segment = 'VIP') / count(*) "
        "AS vip_pct FROM customer_stats",
    ),
    Question(
        "q24_total_revenue",
        "Какова общая выручка за весь период?",
        q.total_revenue,
        "SELECT sum(total_amount) AS revenue FROM sales_summary",
    ),
    Question(
        "q25_orders_per_customer",
        "Сколько в среднем заказов делает один клиент?",
        q.orders_per_customer,
        "SELECT avg(total_orders) AS avg_orders FROM customer_stats",
    ),
    Question(
        "q26_category_revenue_above",
        "Какие товары из категории Электроника принесли больше 100000 рублей выручки?",
        q.category_revenue_above,
        "SELECT product_id, product_name, total_revenue FROM product_performance "
        "WHERE category = '{category}' AND total_revenue > {limit}",
        {"category": "Электроника", "limit": 100_000},
        {"category": "PROMO", "limit": 1_500_000},
    ),
    Question(
        "q27_frequent_buyers",
        "Клиенты с более чем 10 заказами и суммой покупок больше 50000",
        q.frequent_buyers,
        "SELECT customer_id, customer_name, total_orders, lifetime_value FROM customer_stats "
        "WHERE total_orders > {orders} AND lifetime_value > {value}",
        {"orders": 10, "value": 50_000},
    ),
    Question(
        "q28_strong_days",
        "Дни когда выручка была выше среднего и количество заказов больше 50",
        q.strong_days,
        "SELECT sale_date, total_amount, order_count FROM sales_summary "
        "WHERE CAST(total_amount AS DOUBLE) > "
        "(SELECT CAST(sum(total_amount) AS DOUBLE) / count(*) FROM sales_summary) "
        "AND order_count > {orders}",
        {"orders": 50},
        {"orders": 6},
    ),
    Question(
        "q29_unsold_products",
        "Товары которые не продавались последние 30 дней",
        q.unsold_products,
        "SELECT product_id, product_name, last_sale_date FROM product_performance "
        "WHERE last_sale_date IS NULL "
        "OR last_sale_date < (SELECT as_of FROM anchor) - INTERVAL {days} DAY",
        {"days": 30},
    ),
    Question(
        "q30_top_products_per_category",
        "Топ-3 товара по выручке в каждой категории",
        q.top_products_per_category,
        "SELECT * FROM (SELECT category, product_id, product_name, total_revenue, "
        "CAST(row_number() OVER (PARTITION BY category "
        "ORDER BY total_revenue DESC, product_id) AS INTEGER) AS place "
        "FROM product_performance) WHERE place <= {n}",
        {"n": 3},
    ),
    Question(
        "q31_recent_sales",
        "Динамика продаж за последние 30 дней",
        q.recent_sales,
        "SELECT sale_date, total_amount, order_count FROM sales_summary "
        "WHERE sale_date >= (SELECT as_of FROM anchor) - INTERVAL {days} DAY ORDER BY sale_date",
        {"days": 30},
    ),
    Question(
        "q32_compare_months",
        "Сравни выручку декабря 2024 с ноябрем 2024",
        q.compare_months,
        "SELECT revenue, previous_revenue, revenue - previous_revenue AS difference, "
        "100.0::DOUBLE * CAST(revenue - previous_revenue AS DOUBLE) "
        "/ CAST(previous_revenue AS DOUBLE) AS change_pct FROM (SELECT "
        "sum(total_amount) FILTER (WHERE sale_date BETWEEN DATE '{month}' "
        "AND last_day(DATE '{month}')) AS revenue, "
        "sum(total_amount) FILTER (WHERE sale_date BETWEEN DATE '{previous}' "
        "AND last_day(DATE '{previous}')) AS previous_revenue FROM sales_summary)",
        {"month": date(2024, 12, 1), "previous": date(2024, 11, 1)},
        {"month": date(2000, 12, 1), "previous": date(2000, 11, 1)},
    ),
    Question(
        "q33_best_weekday",
        "В какой день недели обычно больше всего продаж?",
        q.best_weekday,
        "SELECT CAST(isodow(sale_date) AS INTEGER) AS weekday, "
        "CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_revenue "
        "FROM sales_summary GROUP BY 1 ORDER BY avg_revenue DESC, weekday LIMIT 1",
    ),
    Question(
        "q34_best_month",
        "Какой был самый успешный месяц по выручке?",
        q.best_month,
        "SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, "
        "sum(total_amount) AS revenue FROM sales_summary "
        "GROUP BY 1 ORDER BY revenue DESC, month LIMIT 1",
    ),
    Question(
        "q35_check_by_month",
        "Как менялся средний чек по месяцам?",
        q.check_by_month,
        "SELECT month, avg_check, avg_check - lag(avg_check) OVER (ORDER BY month) AS change "
        "FROM (SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, "
        "CAST(sum(total_amount) AS DOUBLE) / sum(order_count) AS avg_check "
        "FROM sales_summary GROUP BY 1)",
    ),
    Question(
        "q36_inactive_customers",
        "Какие клиенты не делали покупок последние 30 дней?",
        q.inactive_customers,
        "SELECT customer_id, customer_name, last_order_date FROM customer_stats "
        "WHERE last_order_date < (SELECT as_of FROM anchor) - INTERVAL {days} DAY",
        {"days": 30},
    ),
    Question(
        "q37_running_out",
        "Какие товары скоро закончатся на складе?",
        q.running_out,
        "SELECT product_id, product_name, units_in_stock FROM product_performance "
        "WHERE units_in_stock < {limit} ORDER BY units_in_stock, product_id",
        {"limit": 20},
    ),
    Question(
        "q38_vip_revenue_share",
        "Какая доля выручки приходится на VIP клиентов?",
        q.vip_revenue_share,
        "SELECT 100.0::DOUBLE * CAST(sum(lifetime_value) FILTER "
        "(WHERE customer_segment = 'VIP') AS DOUBLE) "
        "/ CAST(sum(lifetime_value) AS DOUBLE) AS vip_share FROM customer_stats",
    ),
    Question(
        "q39_category_revenue",
        "Какие категории товаров самые прибыльные?",
        q.category_revenue,
        "SELECT category, sum(total_revenue) AS revenue FROM product_performance "
        "GROUP BY category ORDER BY revenue DESC, category",
    ),
    Question(
        "q40_repeat_buyer_percent",
        "Какой процент клиентов совершил больше 5 покупок?",
        q.repeat_buyer_percent,
        "SELECT 100.0::DOUBLE * count(*) FILTER (WHERE total_orders > {orders}) / count(*) "
        "AS repeat_pct FROM customer_stats",
        {"orders": 5},
    ),
    Question(
        "q41_average_daily_revenue",
        "Какая средняя выручка за день?",
        q.average_daily_revenue,
        "SELECT CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_revenue FROM sales_summary",
    ),
    Question(
        "q42_orders_yesterday",
        "Сколько заказов было вчера?",
        q.orders_yesterday,
        "SELECT CAST(sum(order_count) AS BIGINT) AS order_count FROM sales_summary "
        "WHERE sale_date = (SELECT as_of FROM anchor) - INTERVAL 1 DAY",
    ),
    Question(
        "q43_top_five_products",
        "Какой топ-5 товаров?",
        q.top_products,
        "SELECT product_id, product_name, total_revenue FROM product_performance "
        "ORDER BY total_revenue DESC, product_id LIMIT {n}",
        {"n": 5},
    ),
    Question(
        "q44_all_sales",
        "SELECT * FROM sales_summary",
        q.all_sales,
        "SELECT * FROM sales_summary",
    ),
]

BY_KEY = {question.key: question for question in QUESTIONS}


def _variant(key: str, text: str, **options: Any) -> Question:
    question = BY_KEY[key]
    return replace(question, text=text, options={**question.options, **options})


# Other published wordings of the same questions.
VARIANTS = [
    _variant("q01_sales_rows", "Сколько записей в таблице sales_summary?"),
    _variant("q03_customer_count", "Сколько клиентов в базе?"),
    _variant("q07_recent_orders", "Сколько заказов было за последние 7 дней?"),
    _variant("q11_top_customers", "Топ-5 клиентов по сумме покупок"),
    _variant("q11_top_customers", "Покажи топ-3 клиента по сумме покупок", n=3),
    _variant("q12_top_products", "Топ-3 товара по выручке"),
    _variant(
        "q26_category_revenue_above",
        "Какие товары из категории Электроника принесли больше 100000 рублей?",
    ),
]
BY_TEXT = {question.text: question for question in [*QUESTIONS, *VARIANTS]}

# The suite groups, five questions each, and the difficulty of each group.
GROUPS = [
    "simple",
    "filter",
    "ranking",
    "grouping",
    "statistics",
    "complex",
    "temporal",
    "analytical",
]
GROUP_DIFFICULTY = {
    "simple": "easy",
    "filter": "easy",
    "ranking": "medium",
    "grouping": "medium",
    "statistics": "medium",
    "complex": "hard",
    "temporal": "hard",
    "analytical": "hard",
}


def questions_by_difficulty(difficulty: str) -> list[Question]:
    """Questions of the groups of one difficulty; any other name returns all of them."""
    suite = QUESTIONS[: 5 * len(GROUPS)]
    chosen = [
        question
        for i, question in enumerate(suite)
        if GROUP_DIFFICULTY[GROUPS[i // 5]] == difficulty
    ]
    return chosen or suite
