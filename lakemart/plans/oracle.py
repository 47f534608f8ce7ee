"""The independent SQL (DuckDB dialect) each registered query is compared with."""

from __future__ import annotations

from lakemart.functions.text import AGGREGATE_MARKS, DISTRIBUTION_STEMS, RANKING_STEMS, SYNONYMS
from lakemart.operators.charts import OUTCOMES
from lakemart.plans.corpus import QUESTIONS as PUBLISHED
from lakemart.plans.querylog import query_log_sql
from lakemart.plans.registry import DOCUMENT_SYNONYMS, TABLES, TURN_PREFIXES, TURN_WORDS

QUESTIONS = [question.on_test_tables() for question in PUBLISHED]

MARTS = """
sales_summary AS (
  SELECT sale_date, total_amount, order_count,
         CAST(CAST((CAST(total_amount * 100 AS HUGEINT) * 2 + order_count) // (2 * order_count)
              AS DECIMAL(20,0)) * 0.01 AS DECIMAL(20,2)) AS avg_order_value
  FROM (SELECT CAST(o_orderdate AS DATE) AS sale_date,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total_amount,
               count(*) AS order_count
        FROM orders GROUP BY 1)),
anchor AS (SELECT CAST(max(sale_date) + INTERVAL 1 DAY AS DATE) AS as_of FROM sales_summary),
customer_totals AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         'customer' || c_custkey || '@example.com' AS email,
         total_orders, lifetime_value, first_order_date, last_order_date,
         CAST(CAST((CAST(lifetime_value * 100 AS HUGEINT) * 2 + total_orders)
              // (2 * total_orders) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(20,2)) AS avg_order_value
  FROM (SELECT o_custkey, count(*) AS total_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS lifetime_value,
               CAST(min(o_orderdate) AS DATE) AS first_order_date,
               CAST(max(o_orderdate) AS DATE) AS last_order_date
        FROM orders GROUP BY o_custkey) JOIN customer ON o_custkey = c_custkey),
customer_stats AS (
  SELECT *, CASE
      WHEN CAST(lifetime_value AS DOUBLE) >=
           (SELECT quantile_cont(CAST(lifetime_value AS DOUBLE), 0.8) FROM customer_totals)
        THEN 'VIP'
      WHEN CAST(lifetime_value AS DOUBLE) >=
           (SELECT quantile_cont(CAST(lifetime_value AS DOUBLE), 0.24) FROM customer_totals)
        THEN 'Regular'
      ELSE 'New' END AS customer_segment
  FROM customer_totals),
product_performance AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(coalesce(quantity, 0) AS BIGINT) AS total_quantity_sold,
         CAST(coalesce(revenue, 0) AS DECIMAL(22,2)) AS total_revenue,
         CAST(p_retailprice AS DECIMAL(12,2)) AS avg_price,
         p_size AS units_in_stock, last_sale_date
  FROM part LEFT JOIN (
    SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(12,2))) AS quantity,
           sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
             AS revenue,
           CAST(max(o_orderdate) AS DATE) AS last_sale_date
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey)
  ON p_partkey = l_partkey)"""


def with_marts(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([MARTS.strip(), *ctes]) + "\n" + body


def question_sql() -> dict[str, str]:
    return {question.key: with_marts(question.sql) for question in QUESTIONS}



def _strip(value: str) -> str:
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


def _any(value: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({value}), '{p}')" for p in phrases) + ")"


MONEY = "decimal(22,2)"

# Columns of the profiled results: name, type, and whether text, number or date.
RESULT_COLUMNS = {
    "q01_sales_rows": [("row_count", "bigint", "numeric")],
    "q08_low_stock": [
        ("product_id", "bigint", "numeric"),
        ("product_name", "string", None),
        ("units_in_stock", "int", "numeric"),
    ],
    "q12_top_products": [
        ("product_id", "bigint", "numeric"),
        ("product_name", "string", None),
        ("total_revenue", MONEY, "numeric"),
    ],
    "q13_top_days": [("sale_date", "date", "datetime"), ("total_amount", MONEY, "numeric")],
    "q16_segment_value": [("customer_segment", "string", None), ("avg_ltv", "double", "numeric")],
    "q17_products_per_category": [
        ("category", "string", None),
        ("product_count", "bigint", "numeric"),
    ],
    "q20_segment_distribution": [
        ("customer_segment", "string", None),
        ("customer_count", "bigint", "numeric"),
        ("pct", "double", "numeric"),
    ],
    "q32_compare_months": [
        ("revenue", "decimal(32,2)", "numeric"),
        ("previous_revenue", "decimal(32,2)", "numeric"),
        ("difference", "decimal(33,2)", "numeric"),
        ("change_pct", "double", "numeric"),
    ],
    "q44_all_sales": [
        ("sale_date", "date", "datetime"),
        ("total_amount", MONEY, "numeric"),
        ("order_count", "bigint", "numeric"),
        ("avg_order_value", "decimal(20,2)", "numeric"),
    ],
}

TABLE_COLUMNS = {
    "orders": [
        ("o_orderkey", "bigint", "numeric"),
        ("o_custkey", "bigint", "numeric"),
        ("o_orderstatus", "string", None),
        ("o_totalprice", "double", "numeric"),
        ("o_orderdate", "timestamp_ntz", "datetime"),
        ("o_orderpriority", "string", None),
    ],
    "customer": [
        ("c_custkey", "bigint", "numeric"),
        ("c_name", "string", None),
        ("c_nationkey", "int", "numeric"),
        ("c_acctbal", "double", "numeric"),
        ("c_mktsegment", "string", None),
    ],
    "documents": [
        ("doc_id", "bigint", "numeric"),
        ("text", "string", None),
        ("lang", "string", None),
        ("source", "string", None),
        ("n_chars", "bigint", "numeric"),
    ],
    "events": [
        ("event_id", "bigint", "numeric"),
        ("ts", "timestamp_ntz", "datetime"),
        ("user_id", "bigint", "numeric"),
        ("event_type", "string", None),
        ("value", "double", "numeric"),
        ("props", "string", None),
    ],
    "part": [
        ("p_partkey", "bigint", "numeric"),
        ("p_name", "string", None),
        ("p_brand", "string", None),
        ("p_type", "string", None),
        ("p_size", "int", "numeric"),
        ("p_retailprice", "double", "numeric"),
    ],
}


def _profile(result: str, source: str, columns: list[tuple[str, str, str | None]]) -> str:
    """One SELECT per column, counted with exact distincts."""
    rows = []
    for i, (name, dtype, declared) in enumerate(columns):
        if declared:
            kind, longest = f"'{declared}'", "CAST(NULL AS INTEGER)"
        else:
            kind = (
                f"CASE WHEN count(TRY_CAST({name} AS TIMESTAMP)) > 0.8 * count({name}) "
                f"AND count({name}) > 0 THEN 'datetime' "
                f"WHEN count(DISTINCT {name}) < 0.5 * count(*) AND count(DISTINCT {name}) < 50 "
                "THEN 'categorical' ELSE 'text' END"
            )
            longest = f"CAST(max(length({name})) AS INTEGER)"
        rows.append(
            f"SELECT '{result}' AS result_id, {i} AS position, '{name}' AS column_name, "
            f"'{dtype}' AS dtype, CASE WHEN count(*) > 0 THEN {kind} END AS column_class, "
            f"count(*) AS num_rows, CASE WHEN count(*) > 0 THEN {len(columns)} ELSE 0 END "
            f"AS num_cols, {longest} AS label_length FROM {source}"
        )
    return "\nUNION ALL ".join(rows)


def _result_profiles() -> tuple[str, ...]:
    """CTEs: the profiled results and ``profiles`` over them."""
    bodies = {question.key: question.sql for question in QUESTIONS}
    ctes = [f"{key} AS ({bodies[key]})" for key in RESULT_COLUMNS]
    selects = [_profile(key, key, columns) for key, columns in RESULT_COLUMNS.items()]
    ctes.append("profiles AS (" + "\nUNION ALL ".join(selects) + ")")
    return tuple(ctes)


FLAGS = """
flags AS (
  SELECT result_id, max(num_rows) AS num_rows, max(num_cols) AS num_cols,
    max(num_rows) = 0 AS is_empty,
    max(num_rows) = 1 AND count(*) FILTER (column_class = 'numeric') = 1 AS is_single_value,
    count(*) FILTER (column_class = 'datetime') > 0 AS has_timeseries,
    count(*) FILTER (column_class = 'categorical') > 0 AS has_categories,
    count(*) FILTER (column_class = 'numeric') AS numeric_columns,
    count(*) FILTER (column_class = 'datetime') AS datetime_columns,
    count(*) FILTER (column_class = 'categorical') AS categorical_columns,
    count(*) FILTER (column_class = 'text') AS text_columns,
    (list(column_name ORDER BY position) FILTER (column_class = 'numeric'))[1] AS first_numeric,
    (list(column_name ORDER BY position) FILTER (column_class = 'numeric'))[2] AS second_numeric,
    (list(column_name ORDER BY position) FILTER (column_class = 'datetime'))[1] AS first_datetime,
    (list(column_name ORDER BY position) FILTER (column_class = 'categorical'))[1]
      AS first_category,
    (list(column_name ORDER BY position) FILTER (column_class = 'text'))[1] AS first_text,
    coalesce(
      (list(label_length ORDER BY position) FILTER (column_class = 'categorical'))[1],
      (list(label_length ORDER BY position) FILTER (column_class = 'text'))[1]) AS label_length
  FROM profiles GROUP BY result_id)"""


def _chart_sql(log: str) -> str:
    """The rules one after the other over ``flags`` and a log of (result_id, question, sql)."""
    number = "first_numeric IS NOT NULL"
    aggregated = _any("sql", AGGREGATE_MARKS)
    asked = f"({_any('question', RANKING_STEMS)} OR {_any('sql', ['limit'])})"
    ranking = f"({asked} AND {_any('sql', ['order by'])})"
    distribution = f"({_any('question', DISTRIBUTION_STEMS)} AND num_rows <= 10)"
    label = "coalesce(first_category, first_text)"
    return f"""
, log(result_id, question, sql) AS (VALUES {log}),
ruled AS (
  SELECT *, CASE
    WHEN is_empty THEN 'empty'
    WHEN is_single_value THEN 'single'
    WHEN num_rows > 100 AND NOT {aggregated} THEN 'many_rows'
    WHEN has_timeseries AND {number} THEN 'timeseries'
    WHEN {ranking} AND {label} IS NOT NULL AND {number} THEN 'ranking'
    WHEN {ranking} THEN 'no_ranking'
    WHEN {distribution} AND first_category IS NOT NULL AND {number} THEN 'distribution'
    WHEN {distribution} THEN 'no_distribution'
    WHEN has_categories AND {number} THEN 'comparison'
    WHEN numeric_columns >= 2 AND num_rows > 5 THEN 'correlation'
    ELSE 'default' END AS rule
  FROM flags JOIN log USING (result_id)),
outcomes(rule, confidence, heading, reason) AS (VALUES
  {", ".join(f"('{k}', {c}::DOUBLE, '{h}', '{r}')" for k, (c, h, r) in OUTCOMES.items())})
SELECT result_id,
  CASE rule WHEN 'empty' THEN 'none' WHEN 'single' THEN 'none' WHEN 'timeseries' THEN 'line'
    WHEN 'ranking' THEN CASE WHEN label_length > 15 THEN 'horizontal_bar' ELSE 'bar' END
    WHEN 'distribution' THEN 'pie' WHEN 'comparison' THEN 'bar' WHEN 'correlation' THEN 'scatter'
    ELSE 'table' END AS chart_type,
  CASE WHEN rule NOT IN ('timeseries', 'ranking', 'distribution', 'comparison', 'correlation')
       THEN heading
    WHEN length(question) BETWEEN 1 AND 79
      THEN upper(substring(question, 1, 1)) || lower(substring(question, 2))
    WHEN length(question) >= 80 THEN substring(question, 1, 77) || '...'
    ELSE heading END AS title,
  CASE rule WHEN 'timeseries' THEN first_datetime WHEN 'ranking' THEN {label}
    WHEN 'distribution' THEN first_category WHEN 'comparison' THEN first_category
    WHEN 'correlation' THEN first_numeric END AS x_column,
  CASE WHEN rule IN ('timeseries', 'ranking', 'distribution', 'comparison') THEN first_numeric
    WHEN rule = 'correlation' THEN second_numeric END AS y_column,
  confidence, reason
FROM ruled JOIN outcomes USING (rule)"""


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chart_log() -> str:
    chosen = [question for question in QUESTIONS if question.key in RESULT_COLUMNS]
    return ", ".join(
        f"({_quote(q.key)}, {_quote(q.text)}, {_quote(q.sql)})" for q in chosen
    )


def _difficulty() -> str:
    statistics = STATISTICS.strip()
    return f"""
WITH log AS ({query_log_sql()}), leveled AS (
  SELECT success, execution_time, CASE WHEN event_type IN ('click', 'view') THEN 'easy'
    WHEN event_type IN ('purchase', 'signup') THEN 'medium' ELSE 'hard' END AS difficulty FROM log
  UNION ALL SELECT success, execution_time, 'all' FROM log)
SELECT difficulty, {statistics} FROM leveled GROUP BY difficulty"""


STATISTICS = """
count(*) AS total_queries, count(*) FILTER (success) AS successful,
count(*) FILTER (NOT success) AS failed,
100.0::DOUBLE * count(*) FILTER (success) / count(*) AS success_rate,
CAST(sum(CAST(execution_time AS DECIMAL(18,6))) AS DOUBLE) / count(execution_time)
  AS avg_execution_time,
min(execution_time) AS min_execution_time, max(execution_time) AS max_execution_time"""

SALES = """
SELECT event_id AS id, event_type AS product, value AS amount, CAST(ts AS DATE) AS date
FROM events"""

RANKED_PRODUCTS = """
SELECT row_number() OVER (ORDER BY total_revenue DESC, product_id) AS place,
  product_name, total_revenue
FROM (SELECT * FROM product_performance ORDER BY total_revenue DESC, product_id LIMIT 20)"""


# A line of digits per customer key.
KEY_BYTES = "CAST(sum(length(CAST(c_custkey AS VARCHAR)) + 1) AS BIGINT)"


def _hash_sql() -> str:
    """Fingerprints of one file per nation, from its lines in order."""
    sums = []
    for name, prime in (("0", 2147483647), ("1", 2147483629)):
        sums.append(f"sum(h{name}) AS s{name}")
        sums.append(f"sum(h{name} * (n % {prime}) % {prime}) % {prime} AS w{name}")
    hashes = ", ".join(
        f"CAST('0x' || md5(line)[{a}:{a + 6}] AS BIGINT) AS h{i}" for i, a in ((0, 1), (1, 8))
    )
    return f"""
WITH lines AS (
  SELECT c_nationkey, line, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1
    AS n
  FROM (SELECT c_nationkey, c_custkey, c_custkey || '|' || c_name AS line FROM customer)
), hashed AS (SELECT *, {hashes} FROM lines),
files AS (
  SELECT c_nationkey, CAST(sum(strlen(line) + 1) AS BIGINT) AS size_bytes, count(*) AS n,
    {", ".join(sums)}
  FROM hashed GROUP BY c_nationkey)
SELECT c_nationkey, size_bytes, md5(concat_ws(':', size_bytes, n, s0, w0, s1, w1)) AS md5hash
FROM files"""


def _all_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
    )


def _synonyms(source: str, value: str, terms: dict[str, list[str]]) -> str:
    made = ", ".join(
        f"CASE WHEN {_any(value, phrases)} THEN '{term}' END"
        for term, phrases in sorted(terms.items())
    )
    return f"SELECT *, concat_ws('|', {made}) AS terms FROM {source}"


def _source_sql() -> dict[str, str]:
    return {
        "s01_csv_ingest": "SELECT * FROM orders",
        "s03_change_detection": "SELECT 1 AS load_number, count(*) AS row_count FROM customer "
        "UNION ALL SELECT 2, 0",
        "s03_stream_changes": "SELECT c_custkey, c_acctbal + c_custkey % 2 AS c_acctbal "
        "FROM customer",
        "s04_lineage": "SELECT 'customer' AS dataset, 'bronze' AS layer, 'csv' AS format, "
        "'local_upload' AS source, count(*) AS row_count, count(*) AS traced_rows FROM customer",
        "s02_file_hashes": _hash_sql(),
        "s05_manifest": "SELECT 'completed' AS status, 'lakehouse-bronze' AS bronze_bucket, "
        f"{KEY_BYTES} AS row_bytes, 0 AS unlisted_files FROM customer",
        "s06_load_check": f"SELECT count(*) > 0 AS verified, {KEY_BYTES} AS row_bytes "
        "FROM customer",
        "s07_partitioned_table": f"SELECT date, count(*) AS row_count FROM ({SALES}) GROUP BY date",
        "s08_rows_per_snapshot": f"SELECT 1 AS place, count(*) AS row_count FROM ({SALES}) "
        f"WHERE product <> 'error' UNION ALL SELECT 2, count(*) FROM ({SALES})",
        "s09_current_rows": SALES,
        "s10_snapshot_list": "SELECT DISTINCT CASE WHEN event_type = 'error' THEN 2 ELSE 1 END "
        "AS place, 'append' AS operation FROM events",
        "s11_first_snapshot": f"SELECT * FROM ({SALES}) WHERE product <> 'error'",
        "s13_cross_source": "SELECT c_mktsegment AS segment, count(*) AS row_count, "
        "sum(CAST(value AS DECIMAL(12,2))) AS amount FROM events "
        "JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment",
        "s14_date_series": "SELECT CAST(unnest(generate_series(min(o_orderdate), "
        "max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders",
        "s14_integer_series": "SELECT unnest(generate_series(1, count(*))) AS id FROM customer",
        "s15_daily_spine": """
WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS sale_date,
    sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total_amount, count(*) AS order_count
  FROM orders GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY))
  AS DATE) AS sale_date FROM daily)
SELECT sale_date, coalesce(total_amount, 0) AS total_amount, coalesce(order_count, 0) AS order_count
FROM spine LEFT JOIN daily USING (sale_date)""",
        "s16_insert_if_absent": with_marts(
            "SELECT sale_date, total_amount FROM sales_summary UNION ALL "
            "SELECT CAST(l_shipdate AS DATE), max(CAST(l_extendedprice AS DECIMAL(12,2))) "
            "FROM lineitem WHERE CAST(l_shipdate AS DATE) NOT IN "
            "(SELECT sale_date FROM sales_summary) GROUP BY 1"
        ),
        "s16_prefiltered_insert": "SELECT o_orderkey AS l_orderkey, 3 AS l_linenumber FROM orders "
        "WHERE o_orderpriority = '1-URGENT' AND NOT EXISTS (SELECT 1 FROM lineitem "
        "WHERE l_orderkey = o_orderkey AND l_linenumber = 3)",
        "s17_row_counts": _all_counts(),
        "s18_sample": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
        "s19_bound_sql": "SELECT o_orderstatus, count(*) AS order_count FROM orders "
        "WHERE o_totalprice > 200000 GROUP BY o_orderstatus",
        "s19_bound_sql_first": "SELECT o_orderkey, o_totalprice FROM orders "
        "WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
        "s20_affected_rows": "SELECT count(*) AS rowcount FROM events",
        "s21_saved_results": "SELECT count(*) AS total_queries, "
        "count(*) FILTER (event_type <> 'error') AS successful, "
        "count(*) FILTER (event_type = 'error') AS failed, count(*) AS saved FROM events",
    }


def _check_sql() -> dict[str, str]:
    def keys(table: str, columns: str, nulls: str) -> str:
        return (
            f"SELECT {columns}, count(*) AS row_count, CASE WHEN {nulls} THEN 'null key' "
            f"ELSE 'duplicate' END AS problem FROM {table} GROUP BY {columns} "
            f"HAVING count(*) > 1 OR {nulls}"
        )

    return {
        "c01_domain_check": "SELECT event_id, event_type, 'outside' AS problem FROM events "
        "WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup')",
        "c01_segment_domain": with_marts(
            "SELECT customer_id, customer_segment, 'outside' AS problem FROM customer_stats "
            "WHERE customer_segment = 'Regular'"
        ),
        "c02_key_check_lines": keys(
            "lineitem", "l_orderkey, l_linenumber", "(l_orderkey IS NULL OR l_linenumber IS NULL)"
        ),
        "c02_key_check_turns": keys(
            "conversations", "conv_id, turn", "(conv_id IS NULL OR turn IS NULL)"
        ),
        "c03_not_null": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
            "count(*) AS row_count FROM documents LEFT JOIN labels USING (doc_id)"
            for c in ("doc_id", "lang", "n_chars", "quality", "toxic")
        ),
        "c04_possible_values": " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM orders"
            for c in ("o_orderstatus", "o_orderpriority", "o_custkey")
        ),
        "c05_data_range": with_marts(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, "
                f"CAST(max({c}) AS VARCHAR) AS max_value, count({c}) AS value_count "
                "FROM sales_summary"
                for c in ("sale_date", "total_amount", "order_count")
            )
        ),
        "c06_synonym_tags": "SELECT doc_id, terms FROM ("
        + _synonyms("documents", "text", DOCUMENT_SYNONYMS)
        + ")",
        "c06_many_tags": """
SELECT doc_id, coalesce(string_agg(DISTINCT term, '|' ORDER BY term), '') AS terms
FROM documents LEFT JOIN (
  SELECT CAST(item_id AS VARCHAR) AS term, lower(array_to_string(string_split(text, ' ')[:2], ' '))
    AS phrase FROM benchmark) ON contains(lower(documents.text), phrase)
GROUP BY doc_id""",
        "c06_question_tags": "SELECT terms, count(*) AS questions FROM ("
        + _synonyms(f"({query_log_sql()})", "question", SYNONYMS)
        + ") GROUP BY terms",
    }


def _chart_queries() -> dict[str, str]:
    profiles = _result_profiles()
    tables = "\nUNION ALL ".join(
        _profile(name, name, columns) for name, columns in TABLE_COLUMNS.items()
    )
    shares = [("l_returnflag", "string", None), ("l_linestatus", "string", None)]
    shares.append(("line_count", "bigint", "numeric"))
    segments = RESULT_COLUMNS["q20_segment_distribution"]
    bodies = {question.key: question.sql for question in QUESTIONS}
    distribution = (
        "shares AS (SELECT l_returnflag, l_linestatus, count(*) AS line_count FROM lineitem "
        "GROUP BY l_returnflag, l_linestatus)",
        f"segments AS ({bodies['q20_segment_distribution']})",
        "profiles AS (" + _profile("shares", "shares", shares) + "\nUNION ALL "
        + _profile("segments", "segments", segments) + ")",
        FLAGS.strip(),
    )
    return {
        "v01_column_profile": with_marts("SELECT * FROM profiles", *profiles),
        "v01_kept_profile": f"SELECT * FROM ({tables})",
        "v02_column_class": f"SELECT * EXCLUDE (label_length) FROM ({tables})",
        "v03_date_share": """
SELECT count(TRY_CAST(all_dates AS TIMESTAMP))::DOUBLE / count(all_dates) AS all_dates,
  count(TRY_CAST(mostly AS TIMESTAMP))::DOUBLE / count(mostly) AS mostly,
  count(TRY_CAST(o_orderpriority AS TIMESTAMP))::DOUBLE / count(o_orderpriority) AS none
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS all_dates,
  CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
    AS mostly FROM orders)""",
        "v04_result_flags": with_marts("SELECT * FROM flags", *profiles, FLAGS.strip()),
        "v05_chart_choice": with_marts(_chart_sql(_chart_log()), *profiles, FLAGS.strip()),
        "v06_label_length": with_marts(
            "SELECT result_id, first_category, first_text, label_length FROM flags",
            *profiles,
            FLAGS.strip(),
        ),
        "v07_distribution": with_marts(
            _chart_sql(
                "('shares', 'Доля строк по статусам', ''), ('segments', 'распределение', '')"
            ),
            *distribution,
        ),
        "v08_line_frame": with_marts(
            "SELECT CAST(sale_date AS TIMESTAMP) AS sale_date, total_amount FROM sales_summary"
        ),
        "v09_bar_frame": with_marts(RANKED_PRODUCTS),
        "v10_horizontal_bar_frame": with_marts(RANKED_PRODUCTS + " ORDER BY place DESC"),
        "v11_pie_frame": with_marts(
            "SELECT row_number() OVER (ORDER BY revenue DESC, category) AS place, category, "
            "revenue, 100.0::DOUBLE * CAST(revenue AS DOUBLE) "
            "/ CAST(sum(revenue) OVER () AS DOUBLE) AS pct FROM "
            "(SELECT category, sum(total_revenue) AS revenue FROM product_performance "
            "GROUP BY category ORDER BY revenue DESC, category LIMIT 10)"
        ),
        "v12_scatter_frame": with_marts(
            "SELECT order_count AS x, total_amount AS y, total_amount AS colour FROM sales_summary"
        ),
    }


def _repair(message: str) -> str:
    return (
        "'SQL Query Error:' || chr(10) || chr(10) || 'Query:' || chr(10) || role || chr(10) "
        f"|| chr(10) || 'Error:' || chr(10) || {message} || chr(10) || chr(10) "
        "|| 'Please fix the SQL query to resolve this error.'"
    )


def _turns(select: str) -> str:
    return (
        f"SELECT conv_id, turn, {select} FROM "
        "(SELECT * REPLACE (coalesce(text, '') AS text) FROM conversations)"
    )


def _log_sql() -> dict[str, str]:
    words = TURN_WORDS
    fence, tag = "chr(10)", words["tag"][0]
    parts = f"string_split({_strip('text')}, {fence})"
    tagged = f"list_filter({parts}, lambda p: starts_with(lower({_strip('p')}), '{tag}'))"
    hinted = f"string_split(text, '{words['hint'][0]}')[1]"
    kinds = " ".join(
        f"WHEN starts_with(text, '{p}') THEN '{k}'" for k, p in TURN_PREFIXES.items()
    )
    return {
        "l01_aggregated_sql": _turns(f"{_any('text', words['aggregated'])} AS is_aggregated"),
        "l02_top_n": _turns(
            f"({_any('text', words['ranking'])} OR {_any('text', words['limit'])}) "
            f"AND {_any('text', words['order'])} AS is_top_n"
        ),
        "l03_distribution": _turns(f"{_any('text', words['distribution'])} AS is_distribution"),
        "l04_fenced_sql": _turns(
            f"CASE WHEN contains({_strip('text')}, {fence}) THEN CASE WHEN len({tagged}) > 0 "
            f"THEN {_strip(f'substring({tagged}[1], {len(tag) + 1})')} "
            f"ELSE {_strip(f'{parts}[2]')} END ELSE {_strip('text')} END AS sql"
        ),
        "l05_last_query": "SELECT user_id, arg_max(sql, event_id) AS sql FROM ("
        "SELECT user_id, event_id, CASE WHEN starts_with(tool_input, '{') "
        "THEN coalesce(json_extract_string(tool_input, '$.query'), '') ELSE tool_input END AS sql "
        f"FROM ({query_log_sql()}) WHERE tool = 'sql_db_query') WHERE sql <> '' GROUP BY user_id",
        "l05_last_answer": "SELECT conv_id, arg_max(text, turn) AS sql FROM conversations "
        "WHERE role = 'assistant' AND text <> '' GROUP BY conv_id",
        "l06_before_hint": _turns(
            f"{hinted} AS message, {_strip(_repair(hinted))} AS request"
        ),
        "l07_error_kind": _turns(
            f"CASE WHEN {_any('text', words['rate'])} THEN 'rate_limit' {kinds} "
            "ELSE 'general' END AS kind, "
            "'Unexpected error during query execution: ' || text AS reported"
        ),
        "l08_matches_expected": f"""
SELECT conv_id, turn, expected, coalesce(contains(lower(text), lower(expected)), false)
  AS matches_expected
FROM conversations, (SELECT unnest({words["expected"]}) AS expected) WHERE role = 'assistant'""",
        "l09_title": _turns(
            "CASE WHEN length(text) = 0 THEN role WHEN length(text) < 80 "
            "THEN upper(substring(text, 1, 1)) || lower(substring(text, 2)) "
            "ELSE substring(text, 1, 77) || '...' END AS title"
        ),
        "t01_suite_statistics": f"SELECT {STATISTICS} FROM ({query_log_sql()})",
        "t02_difficulty_statistics": _difficulty(),
        "t03_session_counters": _session_sql(),
        "t03_followed_sessions": _session_sql(),
    }


def _session_sql() -> str:
    return (
        "SELECT user_id, count(*) AS total_queries, "
        "count(*) FILTER (success) AS successful_queries, "
        "count(*) FILTER (NOT success) AS failed_queries, "
        "CAST(sum(CAST(execution_time AS DECIMAL(18,6))) AS DOUBLE) AS total_time, "
        "CAST(sum(CAST(execution_time AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS avg_time "
        f"FROM ({query_log_sql()}) GROUP BY user_id"
    )


def _scalar_sql() -> dict[str, str]:
    return {
        "n01_lattice_count": """
SELECT count(*) FILTER (x * x + y * y < 1.0::DOUBLE) AS inside, count(*) AS n,
  4.0::DOUBLE * count(*) FILTER (x * x + y * y < 1.0::DOUBLE) / count(*) AS estimate
FROM (SELECT ((o_orderkey + 1) % 317) / 100.0::DOUBLE AS x,
             ((o_orderkey + 1) % 271) / 100.0::DOUBLE AS y FROM orders)""",
        "f01_casts": "SELECT l_orderkey, l_linenumber, l_partkey, "
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity, "
        "CAST(l_shipdate AS DATE) AS ship_date FROM lineitem",
        "f02_concat": "SELECT c_custkey, 'customer' || c_custkey || '@example.com' AS email, "
        "c_mktsegment || ' ' || c_custkey AS label FROM customer",
        "f03_case": "SELECT CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' "
        "ELSE 'large' END AS band, count(*) AS part_count FROM part GROUP BY 1",
        "f04_date_arithmetic": "SELECT o_orderkey, "
        "CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS due_date, "
        "CAST(CAST(o_orderdate AS DATE) - INTERVAL 7 DAY AS DATE) AS week_before, "
        "CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before, "
        "CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
        "f05_date_range": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders "
        "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-02-01' AND DATE '1999-02-28'",
        "f06_arithmetic": "SELECT o_orderkey, x, x * x AS x_square, x * x < 1.0::DOUBLE AS inside "
        "FROM (SELECT o_orderkey, (o_orderkey % 317) / 100.0::DOUBLE AS x FROM orders)",
        "f07_text": "SELECT doc_id, lower(substring(text, 1, 20)) AS start, "
        "contains(lower(text), 'license') AS has_license, starts_with(text, 'E') AS starts_with_e, "
        "len(string_split(text, chr(10))) AS line_count, "
        f"length({_strip('text')}) AS char_count FROM documents",
        "f08_parsed_times": "SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'O' "
        "THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE o_orderpriority END AS TIMESTAMP) "
        "AS parsed FROM orders",
        "f09_half_up_average": "SELECT o_orderpriority, o_orderstatus, "
        "CAST(CAST((CAST(total * 100 AS HUGEINT) * 2 + n) // (2 * n) AS DECIMAL(20,0)) * 0.01 "
        "AS DECIMAL(20,2)) AS average FROM (SELECT o_orderpriority, o_orderstatus, "
        "sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total, count(*) AS n FROM orders "
        "GROUP BY o_orderpriority, o_orderstatus)",
    }


def all_sql() -> dict[str, str]:
    sql = {
        "a01_sales_summary": with_marts("SELECT * FROM sales_summary"),
        "a02_customer_stats": with_marts("SELECT * FROM customer_stats"),
        "a03_product_performance": with_marts("SELECT * FROM product_performance"),
        "a04_as_of": with_marts("SELECT as_of FROM anchor"),
        "a01_kept_sales": with_marts("SELECT * FROM sales_summary"),
        "a02_kept_customers": with_marts("SELECT * FROM customer_stats"),
        "a03_kept_products": with_marts("SELECT * FROM product_performance"),
    }
    for part in (
        question_sql(),
        _source_sql(),
        _check_sql(),
        _chart_queries(),
        _log_sql(),
        _scalar_sql(),
    ):
        sql.update(part)
    return sql
