"""A query log derived from the events table, for the text and session operators.

The statement uses only what Spark SQL and DuckDB share, so both sides of a comparison
start from the same log. Each event type stands for one kind of question.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.sources.tables import read_table

LOG_SQL = """
SELECT event_id, user_id, event_type,
  event_type <> 'error' AS success,
  value AS execution_time,
  CASE event_type
    WHEN 'view' THEN 'покажи ТОП-5 страниц пользователя ' || CAST(user_id AS STRING)
    WHEN 'click' THEN 'Распределение кликов, соотношение по типам'
    WHEN 'purchase' THEN 'Сколько всего покупок сделал за весь период наблюдения ПОЛЬЗОВАТЕЛЬ '
      || CAST(user_id AS STRING) || ' вместе с отменёнными и возвращёнными'
    WHEN 'signup' THEN ''
    ELSE 'средний ответ' END AS question,
  CASE event_type
    WHEN 'view' THEN 'SELECT page, COUNT(*) FROM views WHERE user_id = '
      || CAST(user_id AS STRING) || ' GROUP BY page ORDER BY 2 DESC LIMIT 5'
    WHEN 'click' THEN 'select kind, sum(n) from clicks'
    WHEN 'purchase' THEN 'SELECT * FROM purchases ORDER BY value LIMIT 10'
    WHEN 'signup' THEN 'SELECT * FROM signups'
    ELSE 'SELECT MAX(value) FROM errors HAVING 1 = 1' END AS sql,
  CASE event_type
    WHEN 'view' THEN 'Answer: ```sql' || chr(10) || 'SELECT ' || CAST(event_id AS STRING)
      || chr(10) || '``` done'
    WHEN 'click' THEN chr(10) || '``` SQL select ' || CAST(event_id AS STRING) || '```'
    WHEN 'purchase' THEN 'first ```  SELECT ' || CAST(event_id AS STRING) || ' ``` last'
    WHEN 'signup' THEN '   SELECT ' || CAST(event_id AS STRING) || chr(9) || chr(10)
    ELSE 'open ``` ' END AS response,
  CASE WHEN event_type <> 'error' THEN 'closed HINT: retry HINT: ' || CAST(event_id AS STRING)
    WHEN value < 5 THEN 'SQL syntax error: near FROM HINT: column ' || CAST(user_id AS STRING)
    WHEN value < 10 THEN 'Database operational error: timeout'
    WHEN value < 20 THEN 'Request failed: Rate Limit reached'
    WHEN value < 40 THEN 'Database error: ' || CAST(event_id AS STRING)
    ELSE 'Unexpected error during query execution: none' END AS message,
  CASE WHEN value < 5 THEN 'syntax' WHEN value < 10 THEN 'operational'
    WHEN value < 20 THEN 'database' ELSE 'other' END AS failure,
  CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'sql_db_query'
    ELSE 'sql_db_schema' END AS tool,
  CASE event_type
    WHEN 'view' THEN 'SELECT ' || CAST(event_id AS STRING)
    WHEN 'click' THEN '{"query": "SELECT ' || CAST(event_id AS STRING) || '"}'
    WHEN 'purchase' THEN '{"limit": 1}'
    ELSE 'views' END AS tool_input
FROM EVENTS_TABLE
"""


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    text = LOG_SQL.replace("{", "{{").replace("}", "}}").replace("EVENTS_TABLE", "{events}")
    return spark.sql(text, events=read_table(spark, folder, "events"))


def query_log_sql() -> str:
    return LOG_SQL.replace("EVENTS_TABLE", "events")
