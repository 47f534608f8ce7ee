"""Operators over the steps of a conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import step_query

SQL_TOOL = "sql_db_query"


def last_query(
    steps: DataFrame,
    conversation: str,
    step: str,
    tool: str = "tool",
    tool_input: str = "tool_input",
    path: str = "$.query",
) -> DataFrame:
    """The last non-empty query the SQL tool was called with, per conversation.

    One ``max_by`` per conversation, combined within each task: a conversation of any
    length is never collected.
    """
    queries = steps.where(F.col(tool) == SQL_TOOL).select(
        conversation, step, step_query(F.col(tool_input), path).alias("sql")
    )
    return (
        queries.where(F.col("sql") != "")
        .groupBy(conversation)
        .agg(F.max_by("sql", step).alias("sql"))
    )
