"""From a published question to its rows and its chart."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import matches_expected
from lakemart.operators.charts import chart_frame, recommend_charts
from lakemart.operators.profile import profile, result_flags
from lakemart.plans.corpus import BY_TEXT, QUESTIONS, Question
from lakemart.plans.marts import Marts


ANSWER_ROWS = 5  # rows shown as the answer; expected values are looked for in all


@dataclass
class Answer:
    """``rows`` stays a distributed frame; ``chart`` is one row, ``chart_rows`` what it shows.

    The result is kept for further use until ``close``; a ``with`` block closes it at its end.
    """

    question: str
    sql: str
    rows: DataFrame
    chart: dict[str, Any]
    chart_rows: DataFrame | None

    def close(self) -> None:
        self.rows.unpersist()

    def __enter__(self) -> "Answer":
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def show(rows: DataFrame, question: str, sql: str) -> Answer:
    """Profile any result, choose its chart and prepare the rows of the chart.

    The profile reads a kept copy of the result; blocks lost with an executor are computed
    again. A chart of the first rows takes them from the query itself, whose order a copy need
    not hand on.
    """
    kept = rows.select("*").persist(StorageLevel.MEMORY_AND_DISK)
    log = kept.sparkSession.createDataFrame(
        [("result", question, sql)], "result_id string, question string, sql string"
    )
    chart = recommend_charts(result_flags(profile(kept)), log).first().asDict()
    shown = chart_frame(rows, chart["chart_type"], chart["x_column"], chart["y_column"])
    return Answer(question, sql, kept, chart, shown)


def ask(marts: Marts, text: str) -> Answer:
    """Answer a published question with its published parameters."""
    question = BY_TEXT[text]
    return show(question.run(marts), question.text, question.sql)


def run_suite(
    marts: Marts,
    questions: Sequence[Question] = tuple(QUESTIONS),
    expected: Mapping[str, str] | None = None,
    model: str = "published plans",
) -> DataFrame:
    """Run the questions and return one record for each: the input of the suite statistics.

    A question fails if its query fails; the failure is recorded and the suite goes on. The
    answer shows the first rows of the result as JSON. ``expected`` gives, by the question's text,
    a value that any row of the result should hold; ``matches_expected`` is null for questions
    without one. ``model`` names what answered.
    """
    expected = expected or {}
    records = []
    for question in questions:
        started = datetime.now(timezone.utc)
        start = time.monotonic()
        answer = error = None
        matches = False
        wanted = expected.get(question.text)
        try:
            rows = question.run(marts)
            rows.write.format("noop").mode("overwrite").save()
            spent = round(time.monotonic() - start, 2)
            told = rows.select(F.to_json(F.struct("*")).alias("row"))
            if wanted is not None:
                holds = F.max(matches_expected(F.col("row"), F.lit(wanted)))
                matches = bool(told.agg(holds).first()[0])
            answer = "\n".join(r.row for r in told.limit(ANSWER_ROWS).collect())
        except (PySparkException, Py4JJavaError) as failure:
            spent, error, matches = None, str(failure), False
        judged = None if wanted is None else matches
        record = (question.text, answer, question.sql, spent, error is None, error, started)
        records.append((*record, model, wanted, judged))
    return marts.spark.createDataFrame(
        records,
        "question string, answer string, sql string, execution_time double, success boolean, "
        "error string, timestamp timestamp, model string, expected string, "
        "matches_expected boolean",
    )
