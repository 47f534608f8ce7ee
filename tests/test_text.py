import random
import re

import pytest
from pyspark.sql import functions as F

from lakemart.functions import text
from lakemart.operators.phrases import with_terms
from lakemart.operators.steps import last_query


def column_of(spark, values, build):
    schema = ", ".join(f"c{i} string" for i in range(len(values[0])))
    df = spark.createDataFrame(values, schema).coalesce(1)
    return [r[0] for r in df.select(build(*[F.col(c) for c in df.columns])).collect()]


FENCED = [
    ("  SELECT 1  ", "SELECT 1"),
    (" \tSELECT 1\n\n", "SELECT 1"),
    ("```sql\nSELECT 1\n```", "SELECT 1"),
    ("text ```SQL\nSELECT 2``` more", "SELECT 2"),
    ("``` sql SELECT 3```", "l SELECT 3"),  # three characters go before trimming
    ("```\nSELECT 4\n``` end", "SELECT 4"),
    ("```python\nx\n``` and ```sql\nSELECT 5```", "SELECT 5"),
    ("sql first ```SELECT 6```", "first"),  # any part counts, also the one before the fence
    ("open ```", ""),
    ("```", ""),
    ("", ""),
    ("```a``` ```b```", "a"),
]


def test_fenced_sql(spark):
    found = column_of(spark, [(a,) for a, _ in FENCED], text.fenced_sql)
    assert found == [wanted for _, wanted in FENCED]


AGGREGATED = [
    ("SELECT a FROM t", False),
    ("select SUM(a) from t", True),
    ("select a from t GROUP BY a", True),
    ("select count (*) from t", False),
    ("select max(a), min(b)", True),
    ("x HAVING y", True),
    (None, False),
]


def test_aggregated(spark):
    found = column_of(spark, [(a,) for a, _ in AGGREGATED], text.is_aggregated)
    assert found == [wanted for _, wanted in AGGREGATED]


TOP = [
    ("ТОП клиентов", "select a order by a", True),
    ("ТОП клиентов", "select a", False),
    ("клиенты", "select a ORDER BY a LIMIT 3", True),
    ("клиенты", "select a order by a", False),
    ("самые дорогие", "select a order by a", True),
    ("больше всего", "select a order by a", True),
    ("laptop", "select a order by a", True),
]


def test_top_n(spark):
    found = column_of(spark, [(a, b) for a, b, _ in TOP], text.is_top_n)
    assert found == [wanted for _, _, wanted in TOP]


def test_distribution(spark):
    values = [("Распределение",), ("ДОЛЯ",), ("доли",), ("Процент VIP",), ("сколько",), (None,)]
    assert column_of(spark, values, text.is_distribution) == [True, True, False, True, False, False]


TITLES = [
    ("", "Топ"),
    ("топ-5 Клиентов VIP", "Топ-5 клиентов vip"),
    ("a" * 79, "A" + "a" * 78),
    ("B" * 80, "B" * 77 + "..."),
    ("ж" * 200, "ж" * 77 + "..."),
    ("x", "X"),
]


def test_titles(spark):
    found = column_of(spark, [(a,) for a, _ in TITLES], lambda c: text.title(c, "Топ"))
    assert found == [wanted for _, wanted in TITLES]


def test_synonyms(spark):
    values = [("Сколько ВСЕГО заказов в среднем?",), ("средний чек",), ("клиенты",), (None,)]
    tags = column_of(spark, values, text.synonym_tags)
    assert tags == [["average", "count", "total"], ["average"], [], []]


ERRORS = [
    ("bad HINT: do this HINT: or that", "bad ", "general"),
    ("SQL syntax error: x", "SQL syntax error: x", "syntax"),
    ("Database operational error: x", "Database operational error: x", "operational"),
    ("Database error: RATE LIMIT", "Database error: RATE LIMIT", "rate_limit"),
    ("Database error: x", "Database error: x", "database"),
    ("Unexpected error during query execution: x",) * 2 + ("unexpected",),
]


def test_errors(spark):
    values = [(a,) for a, _, _ in ERRORS]
    assert column_of(spark, values, text.before_hint) == [b for _, b, _ in ERRORS]
    assert column_of(spark, values, text.error_kind) == [c for _, _, c in ERRORS]


def test_reported_errors(spark):
    values = [("syntax", "x"), ("operational", "x"), ("database", "x"), ("other", "x")]
    assert column_of(spark, values, text.query_error) == [
        "SQL syntax error: x",
        "Database operational error: x",
        "Database error: x",
        "Unexpected error during query execution: x",
    ]
    request = column_of(spark, [("SELECT a", "no a HINT: b")], text.repair_request)[0]
    assert request.startswith("SQL Query Error:\n\nQuery:\nSELECT a\n\nError:\nno a \n\nPlease")


def test_matches_expected(spark):
    values = [("Total: 42 RUB", "42 rub"), ("Total", "43"), (None, "x"), ("abc", "")]
    assert column_of(spark, values, text.matches_expected) == [True, False, False, True]


def test_last_query(spark):
    steps = spark.createDataFrame(
        [
            (1, 1, "sql_db_query", '{"query": "SELECT 1"}'),
            (1, 2, "sql_db_query", "SELECT 2"),
            (1, 3, "sql_db_query", '{"other": "x"}'),
            (1, 4, "sql_db_schema", "SELECT 9"),
            (2, 1, "sql_db_query", ""),
            (3, 1, "sql_db_query", '{"query": "SELECT \\"a\\""}'),
            (4, 1, "sql_db_query", None),
        ],
        "conversation int, step int, tool string, tool_input string",
    )
    found = {r.conversation: r.sql for r in last_query(steps, "conversation", "step").collect()}
    assert found == {1: "SELECT 2", 3: 'SELECT "a"'}


@pytest.mark.parametrize("build", [text.is_aggregated, text.is_distribution, text.error_kind])
def test_expressions_need_no_shuffle_and_no_python(spark, build):
    df = spark.createDataFrame([("a",)], "t string").select(build(F.col("t")).alias("x"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_many_phrases(spark):
    made = random.Random(1)
    texts = [(n, "".join(made.choice("abcdé 日") for _ in range(made.randrange(0, 60)))) for n in range(150)]
    texts += [(200, None), (201, ""), (202, "ABC 😀 x" * 300), (203, "аБв")]
    phrases = [(f"t{n % 900}", "".join(made.choice("abcdé ") for _ in range(made.randrange(1, 8)))) for n in range(2000)]
    phrases += [("short", "日"), ("smile", "😀"), ("none", "zzzz"), ("upper", "ABC"), ("cyr", "абв"), ("x", None), (None, "a")]
    given = spark.createDataFrame(texts, "k int, body string")

    def expected(catalogue):
        out = []
        for k, body in texts:
            terms = {t for t, p in catalogue if t and p and body is not None and p in body.lower()}
            out.append((k, sorted(terms)))
        return out

    for extra in ([], [("all", "")]):
        catalogue = spark.createDataFrame(phrases + extra, "term string, phrase string")
        found = with_terms(given, "k", "body", catalogue).select("k", "terms")
        assert sorted((r.k, r.terms) for r in found.collect()) == expected(phrases + extra)


def test_phrases_of_any_length_at_any_place(spark):
    said = "needles in hay, é"
    texts = [(1, "x" * ((1 << 20) - 3) + said), (2, "nee"), (3, "dles in hay"), (4, ""), (5, None)]
    texts += [(6, said * 3), (7, "needles\0in hay"), (8, "n"), (9, said[:9])]
    phrases = [(f"t{n}", said[:n]) for n in range(1, len(said) + 1)]
    phrases += [("end", said[-6:]), ("zero", "\0in"), ("none", "\0\0\0\0\0")]
    given = spark.createDataFrame(texts, "k int, body string")
    catalogue = spark.createDataFrame(phrases, "term string, phrase string")
    found = with_terms(given, "k", "body", catalogue).select("k", "terms")
    expected = [(k, sorted(t for t, p in phrases if p in (body or ""))) for k, body in texts]
    assert sorted((r.k, r.terms) for r in found.collect()) == expected
    for no_texts, no_phrases in ((given.where("k < 0"), catalogue), (given, catalogue.where("term = ''"))):
        left = with_terms(no_texts, "k", "body", no_phrases)
        assert left.where("size(terms) > 0").count() == 0 and left.count() == no_texts.count()


def test_runs_of_no_phrase_are_not_sent(spark):
    made = random.Random(2)
    texts = [(n, "".join(made.choice("abcdefgh ") for _ in range(1000))) for n in range(200)]
    given = spark.createDataFrame([*texts, (200, "at wxyz uvw")], "k int, body string")
    catalogue = spark.createDataFrame([("t", "wxyz uvw")], "term string, phrase string")
    found = with_terms(given, "k", "body", catalogue)
    assert [r.k for r in found.collect() if r.terms] == [200]

    counted = {"ShuffleExchangeExec": "shuffleRecordsWritten", "BroadcastExchangeExec": "numOutputRows"}

    def sent(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return sent(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return sent(node.plan())
        own = node.metrics().apply(counted[kind]).value() if kind in counted else 0
        return own + sum(sent(node.children().apply(i)) for i in range(node.children().size()))

    assert 0 < sent(found._jdf.queryExecution().executedPlan()) < 2000


def test_the_plan_does_not_grow_with_the_phrases(spark):
    texts = spark.createDataFrame([(1, "x")], "k int, body string")

    def size(n):
        rows = [(f"t{i}", f"phrase {i}") for i in range(n)]
        df = with_terms(texts, "k", "body", spark.createDataFrame(rows, "term string, phrase string"))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return len(re.sub("#[0-9L]+", "", plan))

    assert size(10_000) <= size(10) * 1.05
