"""Choosing a chart for a result and preparing the rows it shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.money import percent
from lakemart.functions.text import is_aggregated, is_distribution, is_top_n, title

MANY_ROWS = 100
PIE_ROWS = 10
BAR_ROWS = 20
SCATTER_ROWS = 5
LONG_LABEL = 15

# Confidence, title and reason of each outcome. The title of a drawn chart
# is the question itself; the one given here is used when there is no question.
OUTCOMES = {
    "empty": (1.0, "Нет данных для визуализации", "Запрос не вернул результатов"),
    "single": (1.0, "Единичное значение", "Результат - одно число, график не требуется"),
    "many_rows": (0.8, "Детальные данные", "Слишком много строк, лучше показать таблицу"),
    "timeseries": (0.9, "Динамика", "Временной ряд с числовой метрикой"),
    "ranking": (0.95, "Топ", "Топ-N запрос с категориями и числовыми значениями"),
    "no_ranking": (0.6, "Рейтинг", "Не удалось определить категорию и значение"),
    "distribution": (
        0.85,
        "Распределение",
        "Запрос о распределении с небольшим количеством категорий",
    ),
    "no_distribution": (
        0.6,
        "Распределение",
        "Не удалось определить структуру для круговой диаграммы",
    ),
    "comparison": (0.8, "Сравнение", "Сравнение категорий по числовой метрике"),
    "correlation": (0.75, "Зависимость", "Две числовые метрики для анализа зависимости"),
    "default": (0.5, "Результаты запроса", "Не удалось определить оптимальный тип графика"),
}
DRAWN = {"timeseries", "ranking", "distribution", "comparison", "correlation"}


def recommend_charts(flags: DataFrame, log: DataFrame) -> DataFrame:
    """The chart for each result of ``log`` (``result_id, question, sql``).

    ``flags`` has one row per result. The rules are one expression over the joined row,
    so a whole log is decided in a single join; results without a log entry have an
    empty question.
    """
    question = F.coalesce("question", F.lit(""))
    sql = F.coalesce("sql", F.lit(""))
    numeric = F.col("first_numeric")
    category = F.col("first_category")
    label = F.coalesce("first_category", "first_text")
    has_number = numeric.isNotNull()
    nothing = F.lit(None).cast("string")

    def outcome(
        name: str, chart: str | Column = "table", x: Column = nothing, y: Column = nothing
    ) -> Column:
        confidence, heading, reason = OUTCOMES[name]
        return F.struct(
            (F.lit(chart) if isinstance(chart, str) else chart).alias("chart_type"),
            (title(question, heading) if name in DRAWN else F.lit(heading)).alias("title"),
            x.alias("x_column"),
            y.alias("y_column"),
            F.lit(confidence).alias("confidence"),
            F.lit(reason).alias("reason"),
        )

    bars = F.when(F.col("label_length") > LONG_LABEL, F.lit("horizontal_bar")).otherwise(
        F.lit("bar")
    )
    ranking = F.when(
        label.isNotNull() & has_number, outcome("ranking", bars, label, numeric)
    ).otherwise(outcome("no_ranking"))
    distribution = F.when(
        category.isNotNull() & has_number, outcome("distribution", "pie", category, numeric)
    ).otherwise(outcome("no_distribution"))

    chosen = (
        F.when(F.col("is_empty"), outcome("empty", "none"))
        .when(F.col("is_single_value"), outcome("single", "none"))
        .when((F.col("num_rows") > MANY_ROWS) & ~is_aggregated(sql), outcome("many_rows"))
        .when(
            F.col("has_timeseries") & has_number,
            outcome("timeseries", "line", F.col("first_datetime"), numeric),
        )
        .when(is_top_n(question, sql), ranking)
        .when(is_distribution(question) & (F.col("num_rows") <= PIE_ROWS), distribution)
        .when(F.col("has_categories") & has_number, outcome("comparison", "bar", category, numeric))
        .when(
            (F.col("numeric_columns") >= 2) & (F.col("num_rows") > SCATTER_ROWS),
            outcome("correlation", "scatter", numeric, F.col("second_numeric")),
        )
        .otherwise(outcome("default"))
    )
    return flags.join(log, "result_id", "left").select("result_id", F.inline(F.array(chosen)))


def line_frame(df: DataFrame, x: str, y: str) -> DataFrame:
    """Points in time order; a text axis is parsed first."""
    axis = F.col(x)
    if dict(df.dtypes)[x] == "string":
        axis = F.to_timestamp_ntz(axis)
    return df.select(axis.alias(x), y).orderBy(x)


def bar_frame(
    df: DataFrame, x: str, y: str, order: Sequence[str | Column] = (), n: int = BAR_ROWS
) -> DataFrame:
    """The first rows in the order of the result, numbered by ``place``.

    Without sort keys it is the order that ``df`` has itself: the limit stands on its own sort,
    and the rows it leaves, at most ``n``, are numbered as they come.
    """
    if not order:
        first = df.limit(n).withColumn("_came", F.monotonically_increasing_id())
        return first.select(F.row_number().over(Window.orderBy("_came")).alias("place"), x, y)
    shown = df.orderBy(*order).limit(n)
    place = F.row_number().over(Window.orderBy(*order))
    return shown.select(place.alias("place"), x, y)


def horizontal_bar_frame(
    df: DataFrame, x: str, y: str, order: Sequence[str | Column] = (), n: int = BAR_ROWS
) -> DataFrame:
    """The same rows from last to first, so that the first ends up on top."""
    return bar_frame(df, x, y, order, n).orderBy(F.desc("place"))


def pie_frame(
    df: DataFrame, x: str, y: str, order: Sequence[str | Column] = (), n: int = PIE_ROWS
) -> DataFrame:
    """The first rows with their percentage of the shown total."""
    shown = bar_frame(df, x, y, order, n)
    total = F.sum(y).over(Window.partitionBy())
    return shown.withColumn("pct", percent(F.col(y), total))


def scatter_frame(df: DataFrame, x: str, y: str) -> DataFrame:
    """All points; the colour follows y."""
    return df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(y).alias("colour"))


def chart_frame(
    df: DataFrame,
    chart_type: str,
    x: str | None,
    y: str | None,
    order: Sequence[str | Column] = (),
) -> DataFrame | None:
    """The rows of a recommended chart, or None where the result itself is shown."""
    if chart_type == "line":
        return line_frame(df, x, y)
    if chart_type == "bar":
        return bar_frame(df, x, y, order)
    if chart_type == "horizontal_bar":
        return horizontal_bar_frame(df, x, y, order)
    if chart_type == "pie":
        return pie_frame(df, x, y, order)
    if chart_type == "scatter":
        return scatter_frame(df, x, y)
    return None
