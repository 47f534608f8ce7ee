from datetime import date

import pytest
from pyspark.sql import functions as F

from lakemart.operators import charts
from lakemart.operators.profile import keep_profile, kept_profile, profile, result_flags


def classes(df):
    rows = profile(df).collect()
    return {r.column_name: r.column_class for r in rows}


def labels(spark, distinct, rows):
    """``rows`` rows with ``distinct`` labels."""
    return spark.range(rows).select(F.concat(F.lit("v"), F.col("id") % distinct).alias("label"))


@pytest.mark.parametrize(
    ("distinct", "rows", "wanted"),
    [
        (49, 99, "categorical"),
        (50, 101, "text"),  # fifty labels are too many
        (49, 98, "text"),  # exactly half the rows
        (1, 2, "text"),
        (1, 3, "categorical"),
        (5000, 20000, "text"),
        (49, 20000, "categorical"),
    ],
)
def test_category_borders(spark, distinct, rows, wanted):
    assert classes(labels(spark, distinct, rows)) == {"label": wanted}


def test_classes_by_type(spark):
    df = spark.sql(
        "SELECT 1 AS i, 1.5BD AS d, true AS b, DATE'2024-01-01' AS day, "
        "TIMESTAMP'2024-01-01 00:00:00' AS t, 'x' AS s, '2024-01-05' AS written, "
        "array(1) AS a, CAST(null AS string) AS nothing"
    )
    assert classes(df) == {
        "i": "numeric",
        "d": "numeric",
        "b": "numeric",
        "day": "datetime",
        "t": "datetime",
        "s": "text",
        "written": "datetime",
        "a": "text",
        "nothing": "categorical",
    }


def test_date_share_border(spark):
    def mixed(good, bad):
        rows = [("2024-01-15",)] * good + [("no date",)] * bad + [(None,)] * 50
        return spark.createDataFrame(rows, "s string")

    assert classes(mixed(81, 19)) == {"s": "datetime"}
    assert classes(mixed(80, 20)) == {"s": "categorical"}


def test_nulls_count_as_rows_not_as_values(spark):
    rows = [("a",), ("b",), (None,), (None,), (None,)]
    assert classes(spark.createDataFrame(rows, "s string")) == {"s": "categorical"}


def test_empty_result(spark):
    rows = profile(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r.num_rows, r.num_cols, r.column_class) for r in rows] == [(0, 0, None)] * 2
    flags = result_flags(profile(spark.createDataFrame([], "a int, b string"))).first()
    assert flags.is_empty and not flags.is_single_value


def test_flags(spark):
    df = spark.sql("SELECT 7 AS n, 'x' AS s")
    flags = result_flags(profile(df, "r")).first()
    assert flags.is_single_value and not flags.has_timeseries and not flags.has_categories
    assert (flags.first_numeric, flags.second_numeric, flags.first_text) == ("n", None, "s")
    two = result_flags(profile(spark.sql("SELECT 7 AS n, 8 AS m"))).first()
    assert not two.is_single_value and (two.first_numeric, two.second_numeric) == ("n", "m")


def test_column_names_with_dots_and_blanks(spark):
    df = spark.sql("SELECT 'a' AS `x.y`, 1 AS `sum of z`, 'b' AS `it's a ``tick```, 2 AS `a\\\\b`")
    assert classes(df) == {
        "x.y": "text",
        "sum of z": "numeric",
        "it's a `tick`": "text",
        "a\\\\b": "numeric",
    }


FLAGS = (
    "result_id string, num_rows bigint, is_empty boolean, is_single_value boolean, "
    "has_timeseries boolean, has_categories boolean, numeric_columns bigint, "
    "first_numeric string, second_numeric string, first_datetime string, "
    "first_category string, first_text string, label_length int"
)


def choose(spark, question="", sql="", **facts):
    row = {
        "result_id": "r",
        "num_rows": 20,
        "is_empty": False,
        "is_single_value": False,
        "has_timeseries": False,
        "has_categories": False,
        "numeric_columns": 0,
        "first_numeric": None,
        "second_numeric": None,
        "first_datetime": None,
        "first_category": None,
        "first_text": None,
        "label_length": None,
    }
    row.update(facts)
    flags = spark.createDataFrame([row], FLAGS)
    log = spark.createDataFrame(
        [("r", question, sql)], "result_id string, question string, sql string"
    )
    return charts.recommend_charts(flags, log).first()


NUMBER = {"numeric_columns": 1, "first_numeric": "n"}
TWO = {"numeric_columns": 2, "first_numeric": "n", "second_numeric": "m"}
DAYS = {"has_timeseries": True, "first_datetime": "d"}
GROUPS = {"has_categories": True, "first_category": "g", "label_length": 5}
ORDERED = "select a order by a limit 5"

BRANCHES = [
    # what the result is like, question, sql -> chart, confidence, x, y
    ({"is_empty": True, **DAYS, **NUMBER}, "", "", ("none", 1.0, None, None)),
    ({"is_single_value": True, **DAYS, **NUMBER}, "", "", ("none", 1.0, None, None)),
    ({"num_rows": 101, **DAYS, **NUMBER}, "", "select", ("table", 0.8, None, None)),
    ({"num_rows": 101, **DAYS, **NUMBER}, "", "select sum(a)", ("line", 0.9, "d", "n")),
    ({"num_rows": 100, **DAYS, **NUMBER}, "", "select", ("line", 0.9, "d", "n")),
    ({**DAYS}, "", "", ("table", 0.5, None, None)),
    ({**GROUPS, **NUMBER}, "", ORDERED, ("bar", 0.95, "g", "n")),
    ({**GROUPS, **NUMBER, "label_length": 15}, "", ORDERED, ("bar", 0.95, "g", "n")),
    ({**GROUPS, **NUMBER, "label_length": 16}, "", ORDERED, ("horizontal_bar", 0.95, "g", "n")),
    (
        {**NUMBER, "first_text": "t", "label_length": 16},
        "",
        ORDERED,
        ("horizontal_bar", 0.95, "t", "n"),
    ),
    ({**GROUPS}, "", ORDERED, ("table", 0.6, None, None)),
    ({**TWO}, "", ORDERED, ("table", 0.6, None, None)),
    ({**GROUPS, **NUMBER, "num_rows": 10}, "доля", "", ("pie", 0.85, "g", "n")),
    ({**GROUPS, **NUMBER, "num_rows": 11}, "доля", "", ("bar", 0.8, "g", "n")),
    ({**NUMBER, "first_text": "t", "num_rows": 3}, "доля", "", ("table", 0.6, None, None)),
    ({**GROUPS, **NUMBER}, "", "", ("bar", 0.8, "g", "n")),
    ({**TWO, "num_rows": 6}, "", "", ("scatter", 0.75, "n", "m")),
    ({**TWO, "num_rows": 5}, "", "", ("table", 0.5, None, None)),
    ({**NUMBER}, "", "", ("table", 0.5, None, None)),
]


@pytest.mark.parametrize(("facts", "question", "sql", "wanted"), BRANCHES)
def test_chart_choice(spark, facts, question, sql, wanted):
    row = choose(spark, question, sql, **facts)
    assert (row.chart_type, row.confidence, row.x_column, row.y_column) == wanted


def test_titles_and_reasons(spark):
    assert choose(spark, "", "", **DAYS, **NUMBER).title == "Динамика"
    assert choose(spark, "продажи ПО дням", "", **DAYS, **NUMBER).title == "Продажи по дням"
    empty = choose(spark, "вопрос", "", is_empty=True)
    assert empty.title == "Нет данных для визуализации"
    assert empty.reason == "Запрос не вернул результатов"


def test_result_without_log_entry(spark):
    flags = result_flags(profile(spark.sql("SELECT 7 AS n"), "r"))
    log = spark.createDataFrame([], "result_id string, question string, sql string")
    assert charts.recommend_charts(flags, log).first().chart_type == "none"


def numbered(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("k"), "id").alias("k"), (F.col("id") * 10).alias("v")
    )


def test_bar_frames(spark):
    df = numbered(spark, 25)
    bars = charts.bar_frame(df, "k", "v", [F.desc("v")]).collect()
    assert [r.place for r in bars] == list(range(1, 21))
    assert (bars[0].v, bars[-1].v) == (240, 50)
    flipped = charts.horizontal_bar_frame(df, "k", "v", [F.desc("v")]).collect()
    assert [r.v for r in flipped] == [r.v for r in reversed(bars)]
    assert charts.bar_frame(numbered(spark, 3), "k", "v", ["v"]).count() == 3


def test_pie_frame_shares_the_shown_total(spark):
    rows = charts.pie_frame(numbered(spark, 11), "k", "v", ["v"]).collect()
    assert len(rows) == 10 and sum(r.pct for r in rows) == pytest.approx(100)


def test_line_frame_parses_and_sorts(spark):
    df = spark.createDataFrame([("2024-01-03", 1), ("2024-01-01", 2)], "d string, v int")
    rows = charts.line_frame(df, "d", "v").collect()
    assert [r.d.date() for r in rows] == [date(2024, 1, 1), date(2024, 1, 3)]


def test_scatter_frame_keeps_all_points(spark):
    df = numbered(spark, 500).withColumn("w", F.col("v") + 1)
    rows = charts.scatter_frame(df, "v", "w")
    assert rows.count() == 500 and rows.columns == ["x", "y", "colour"]


def test_dispatch(spark):
    df = numbered(spark, 3)
    for kind in ("line", "bar", "horizontal_bar", "pie", "scatter"):
        x = "v" if kind in ("line", "scatter") else "k"
        assert charts.chart_frame(df, kind, x, "v", ["v"]).count() == 3
    assert charts.chart_frame(df, "table", None, None, []) is None


def test_kept_loads_profile_like_all_rows(spark, tmp_path):
    df = labels(spark, 40, 5000).withColumn("n", F.col("label").substr(2, 9).cast("int"))
    df = df.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")).cast("string"))
    df = df.withColumn("long", F.repeat("label", F.col("n") + 1)).drop("n").withColumn("n", F.lit(1))
    target = str(tmp_path)
    for load, part in (("a", "< 7"), ("b", "between 7 and 30"), ("c", "> 30"), ("d", "> 99")):
        own = df.where(f"CAST(substr(label, 2) AS int) {part}")
        keep_profile(own, "all", target, load)
    keep_profile(df.where("CAST(substr(label, 2) AS int) < 7"), "all", target, "a")  # again
    keep_profile(df.limit(0), "none", target, "a")
    wanted = profile(df, "all").unionAll(profile(df.limit(0), "none"))
    assert sorted(map(repr, kept_profile(spark, target).collect())) == sorted(
        map(repr, wanted.collect())
    )
    parts = spark.read.parquet(target)
    assert parts.count() == 4 * 4 + 4  # a row per column and load, whatever the rows
