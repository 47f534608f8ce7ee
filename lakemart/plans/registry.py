"""Every registered query: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.functions import text
from lakemart.functions.calendar import day, month_start
from lakemart.functions.money import exact_sum, half_up_average, price, units
from lakemart.operators import charts, checks, stats
from lakemart.operators.lattice import lattice_count
from lakemart.operators.phrases import with_terms
from lakemart.operators.profile import (
    date_share,
    keep_profile,
    kept_profile,
    profiles,
    result_flags,
)
from lakemart.operators.steps import SQL_TOOL, last_query
from lakemart.operators.upsert import absent_rows, insert_absent
from lakemart.plans.corpus import QUESTIONS, Question
from lakemart.plans.kept_marts import KeptMarts
from lakemart.plans.marts import Marts
from lakemart.plans.querylog import query_log
from lakemart.session import move_files, new_dir
from lakemart.sources import bronze, series
from lakemart.sources.federated import query_sources
from lakemart.sources.results import save_results, write_counted
from lakemart.sources.tables import read_table, row_counts, run_sql, sample_rows
from lakemart.sources.versioned import VersionedTable
from lakemart.streaming.bronze_stream import follow_changes, load_changes
from lakemart.streaming.session_stream import follow_sessions, followed_counters

Query = Callable[[SparkSession, str], DataFrame]

TESTED = {question.key: question.on_test_tables() for question in QUESTIONS}

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

# Results whose profile and chart are registered: one per branch the data can reach.
PROFILED = [
    "q01_sales_rows",
    "q08_low_stock",
    "q12_top_products",
    "q13_top_days",
    "q16_segment_value",
    "q17_products_per_category",
    "q20_segment_distribution",
    "q32_compare_months",
    "q44_all_sales",
]

# Base tables whose profile is registered, and their keys.
PROFILED_TABLES = {
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "documents": "doc_id",
    "events": "event_id",
    "part": "p_partkey",
}

# Synonyms registered on the test documents, which are not in the language of the shipped ones.
DOCUMENT_SYNONYMS = {
    "license": ["license", "copyright"],
    "contact": ["@", "http"],
    "article": ["the ", "der ", "los "],
}

# Word lists registered on the given conversations, which hold no questions about data: they
# stand for the published lists and cover the languages of the turns.
TURN_WORDS = {
    "aggregated": ["tion on", " que la", "ch der", "ción de"],
    "ranking": ["the th", "der ", "los "],
    "limit": [" et "],
    "order": [" of ", " une", "ung"],
    "distribution": ["tion tion", "sch die", " las", "eau"],
    "tag": ["the"],
    "hint": [". "],
    "rate": ["tion tion", "leau"],
    "expected": ["the", "que", "der"],
}
TURN_FENCE = "\n"
TURN_PREFIXES = {"syntax": "The", "operational": "Th", "database": "La", "unexpected": "E"}

EVENT_DIFFICULTY = {
    "click": "easy",
    "view": "easy",
    "purchase": "medium",
    "signup": "medium",
    "error": "hard",
}


def _question(question: Question) -> Query:
    return lambda spark, sf_dir: question.run(Marts(spark, sf_dir))


# marts kept up by loads


def _kept(spark: SparkSession, sf_dir: str) -> KeptMarts:
    """Facts in three loads, lines with their order, before or after it; one load comes twice."""
    marts = KeptMarts(spark, new_dir(spark, "kept-marts"), sf_dir)
    orders, lines = (read_table(spark, sf_dir, name) for name in ("orders", "lineitem"))
    for number in (0, 1, 2, 0):
        own = orders.where(F.col("o_orderkey") % 3 == number)
        sold = lines.where((F.col("l_orderkey") + F.col("l_linenumber") % 2) % 3 == number)
        marts.add(own, sold, f"load-{number}")
    return marts


# bronze load


def _raw_copy(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A data folder whose ``raw`` part holds one table as CSV files."""
    data_dir = new_dir(spark, f"data-{table}")
    read_table(spark, sf_dir, table).write.option("header", True).csv(f"{data_dir}/raw")
    return data_dir


def _ingest(
    spark: SparkSession, sf_dir: str, table: str, target: str, data_dir: str
) -> DataFrame:
    schema = read_table(spark, sf_dir, table).schema
    return bronze.ingest_csv(
        spark, data_dir, target, {table: ("*.csv", schema)}, {"dataset": table}
    )


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "bronze")
    _ingest(spark, sf_dir, "orders", target, _raw_copy(spark, sf_dir, "orders"))
    return bronze.read_bronze(spark, target, "orders").drop(
        "original_filename", "file_size_bytes", "upload_timestamp"
    )


def file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text, one file per nation in order of their key."""
    folder = new_dir(spark, "hashed")
    customers = read_table(spark, sf_dir, "customer").select(
        "c_nationkey", "c_custkey", F.concat_ws("|", "c_custkey", "c_name").alias("value")
    )
    ordered = customers.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.drop("c_custkey").write.partitionBy("c_nationkey").text(folder)
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int")
    return bronze.content_hashes(spark, f"{folder}/*", "*.txt").select(
        nation.alias("c_nationkey"), "size_bytes", "md5hash"
    )


def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load takes every row, a second one of the same files none."""
    target = new_dir(spark, "bronze")
    data_dir = _raw_copy(spark, sf_dir, "customer")
    first = _ingest(spark, sf_dir, "customer", target, data_dir)
    second = _ingest(spark, sf_dir, "customer", target, data_dir)
    rows = bronze.read_bronze(spark, target, "customer").groupBy("original_filename").count()

    def loaded(batch: DataFrame, number: int) -> DataFrame:
        taken = batch.where("status <> 'skip'").join(rows, "original_filename")
        return taken.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("row_count")).select(
            F.lit(number).alias("load_number"), "row_count"
        )

    return loaded(first, 1).unionByName(loaded(second, 2))


def _land(spark: SparkSession, rows: DataFrame, data_dir: str, prefix: str) -> None:
    """Rows as CSV files of stated names, in place of those that had the names before."""
    written = new_dir(spark, "landing")
    rows.write.option("header", True).csv(written)
    move_files(spark, written, f"{data_dir}/raw", prefix, ".csv")


def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers followed as files: those of odd keys change, and a batch is repeated."""
    data_dir, target = new_dir(spark, "data-followed"), new_dir(spark, "bronze")
    checkpoint = new_dir(spark, "followed")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    datasets = {"customer": ("*.csv", customers.schema)}
    odd = customers.where("c_custkey % 2 = 1")
    _land(spark, customers.where("c_custkey % 2 = 0"), data_dir, "even")
    _land(spark, odd, data_dir, "odd")
    follow_changes(spark, data_dir, target, checkpoint, datasets).awaitTermination()
    _land(spark, odd.withColumn("c_acctbal", F.col("c_acctbal") + 1), data_dir, "odd")
    query = follow_changes(spark, data_dir, target, checkpoint, datasets)
    query.awaitTermination()
    load_changes(spark, data_dir, target, query.id, 1, datasets)
    return bronze.read_bronze(spark, target, "customer").select("c_custkey", "c_acctbal")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "bronze")
    _ingest(spark, sf_dir, "customer", target, _raw_copy(spark, sf_dir, "customer"))
    files = bronze.loaded_files(spark, target)
    rows = bronze.read_bronze(spark, target, "customer").join(files, "original_filename")
    tags = [F.col("metadata")[key].alias(key) for key in ("dataset", "layer", "format", "source")]
    same_size = F.col("file_size_bytes") == F.col("size_bytes")
    return (
        rows.select(same_size.alias("same_size"), *tags)
        .groupBy("dataset", "layer", "format", "source")
        .agg(F.count("*").alias("row_count"), F.count_if("same_size").alias("traced_rows"))
    )


def _ingested_keys(spark: SparkSession, sf_dir: str) -> str:
    """Customer keys, loaded from CSV files: a header line, then a line of digits per row."""
    target, data_dir = new_dir(spark, "bronze"), new_dir(spark, "data-keys")
    keys = read_table(spark, sf_dir, "customer").select("c_custkey")
    keys.write.option("header", True).csv(f"{data_dir}/raw")
    schema = {"keys": ("*.csv", "c_custkey bigint")}
    bronze.ingest_csv(spark, data_dir, target, schema, {"dataset": "keys"})
    return target


HEADER_BYTES = len("c_custkey\n")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of the files listed, without their headers, and files with rows but no entry."""
    target = _ingested_keys(spark, sf_dir)
    bronze.save_manifest(spark, target)
    files = spark.read.json(f"{target}/manifest/files")
    listed = files.agg(
        F.count("*").alias("file_count"),
        F.sum(F.col("size_bytes") - HEADER_BYTES).alias("row_bytes"),
    )
    rows = bronze.read_bronze(spark, target, "keys").select("original_filename").distinct()
    name = F.concat(F.lit("raw/"), "original_filename")
    unlisted = rows.join(files, name == F.col("object_name"), "left_anti")
    header = spark.read.json(f"{target}/manifest/header")
    return header.join(listed, "file_count").select(
        "status",
        "bronze_bucket",
        "row_bytes",
        unlisted.agg(F.count("*")).scalar().alias("unlisted_files"),
    )


def load_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Megabytes of the rows of the files that the check counted."""
    checked = bronze.verify_load(spark, _ingested_keys(spark, sf_dir))
    headers = F.col("file_count") * HEADER_BYTES
    return checked.select(
        (F.col("file_count") > 0).alias("verified"),
        F.round(F.col("size_mb") * 1048576 - headers).cast("bigint").alias("row_bytes"),
    )


# versioned table


def _sales_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Two appends: the regular events, then the error events that came late."""
    table = VersionedTable.create_if_absent(
        spark,
        new_dir(spark, "sales"),
        "id bigint, product string, amount double, date date",
        "date",
    )
    events = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("product"),
        F.col("value").alias("amount"),
        day("ts").alias("date"),
    )
    table.append(events.where("product <> 'error'"))
    table.append(events.where("product = 'error'"))
    return table


def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition value of the created table."""
    return _sales_table(spark, sf_dir).current().groupBy("date").agg(
        F.count("*").alias("row_count")
    )


def rows_per_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_table(spark, sf_dir).row_counts().select("place", "row_count")


def current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_table(spark, sf_dir).current()


def snapshot_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.orderBy("committed_at", "snapshot_id")
    return _sales_table(spark, sf_dir).snapshots().select(
        F.row_number().over(order).alias("place"), "operation"
    )


def first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _sales_table(spark, sf_dir)
    return table.as_of(table.snapshots().first().snapshot_id)


def _visits_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    schema = "user_id bigint, amount double, date date"
    table = VersionedTable.create_if_absent(spark, new_dir(spark, "visits"), schema, "date")
    events = read_table(spark, sf_dir, "events")
    table.append(
        events.select(
            F.col("user_id").cast("bigint").alias("user_id"),
            F.col("value").alias("amount"),
            day("ts").alias("date"),
        )
    )
    return table


def cross_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of lake rows by the user's market segment, which comes from landed CSV files."""
    target = new_dir(spark, "bronze")
    _ingest(spark, sf_dir, "customer", target, _raw_copy(spark, sf_dir, "customer"))
    return query_sources(
        spark,
        """SELECT c_mktsegment AS segment, count(*) AS row_count,
                  sum(CAST(amount AS DECIMAL(12,2))) AS amount
           FROM {lake_visits} JOIN {landed_customer} ON user_id = c_custkey
           GROUP BY c_mktsegment""",
        {
            "lake": {"visits": _visits_table(spark, sf_dir).current()},
            "landed": {"customer": bronze.read_bronze(spark, target, "customer")},
        },
    )


# rows, series, inserts and sinks


def date_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = read_table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
    )
    return series.date_series(bounds, "first", "last")


def integer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.integer_series(spark, 1, read_table(spark, sf_dir, "customer").count())


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days between the first and the last order; those without one are filled with zeros."""
    daily = read_table(spark, sf_dir, "orders").groupBy(day("o_orderdate").alias("sale_date")).agg(
        exact_sum(units("o_totalprice"), 2).alias("total_amount"),
        F.count("*").alias("order_count"),
    )
    return series.daily_spine(daily, "sale_date", ["total_amount", "order_count"])


def inserted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship days without an order day join the daily mart; existing days stay as they are.

    The highest price of a day is a plain maximum, so the lines are summed up, not sorted.
    """
    target = Marts(spark, sf_dir).sales.select("sale_date", "total_amount")
    incoming = read_table(spark, sf_dir, "lineitem").groupBy(
        day("l_shipdate").alias("sale_date")
    ).agg(F.max(price("l_extendedprice")).alias("total_amount"))
    return insert_absent(target, incoming, ["sale_date"], [F.desc("total_amount")])


def inserted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third line for each urgent order without one; few keys of all lines are shuffled."""
    target = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    urgent = read_table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    incoming = urgent.select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(3).cast("int").alias("l_linenumber")
    )
    keys = ["l_orderkey", "l_linenumber"]
    incoming = incoming.select(*[F.col(k).cast(dict(target.dtypes)[k]).alias(k) for k in keys])
    return absent_rows(target, incoming, keys, keys, prefilter=True)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({name: read_table(spark, sf_dir, name) for name in TABLES})


def bound_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark,
        "SELECT o_orderstatus, count(*) AS order_count FROM {orders} "
        "WHERE o_totalprice > :limit GROUP BY o_orderstatus",
        {"limit": 200_000},
        orders=read_table(spark, sf_dir, "orders"),
    )


def bound_sql_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status "
        "ORDER BY o_totalprice DESC, o_orderkey",
        {"status": "F"},
        fetch_all=False,
        orders=read_table(spark, sf_dir, "orders"),
    )


def affected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "written")
    rows = write_counted(read_table(spark, sf_dir, "events"), lambda df: df.write.parquet(target))
    return spark.range(1).select(F.lit(rows).cast("bigint").alias("rowcount"))


def saved_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "results")
    log = query_log(spark, sf_dir)
    save_results(log.select("question", "sql", "execution_time", "success"), target)
    records = spark.read.schema("success boolean").json(f"{target}/results")
    saved = records.agg(F.count("*").alias("saved")).scalar()
    return spark.read.json(f"{target}/statistics").select(
        "total_queries", "successful", "failed", saved.alias("saved")
    )


# checks


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = read_table(spark, sf_dir, "labels")
    return checks.null_counts(documents.join(labels, "doc_id", "left"))


def keys_of(table: str, keys: list[str]) -> Query:
    return lambda s, d: checks.key_violations(read_table(s, d, table), keys)


def few_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    return checks.possible_values(read_table(spark, sf_dir, "orders"), columns)


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.synonym_tags(F.col("text"), DOCUMENT_SYNONYMS)
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(found, "|").alias("terms")
    )


def many_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the openings of all benchmark items, two words each, as tags."""
    opening = F.lower(F.substring_index("text", " ", 2))
    phrases = read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("term"), opening.alias("phrase")
    )
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_terms(documents, "doc_id", "text", phrases).select(
        "doc_id", F.array_join("terms", "|").alias("terms")
    )


def question_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.array_join(text.synonym_tags(F.col("question")), "|")
    return query_log(spark, sf_dir).groupBy(found.alias("terms")).agg(
        F.count("*").alias("questions")
    )


# profiles and charts


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of nine results over one set of marts, in one aggregate."""
    marts = Marts(spark, sf_dir)
    return profiles({key: TESTED[key].run(marts) for key in PROFILED})


def _chart_log(spark: SparkSession) -> DataFrame:
    """Question and SQL of the profiled results: a catalogue, one row each."""
    rows = [(key, TESTED[key].text, TESTED[key].sql) for key in PROFILED]
    return spark.createDataFrame(rows, "result_id string, question string, sql string")


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same profile on whole base tables."""
    tables = {name: read_table(spark, sf_dir, name) for name in PROFILED_TABLES}
    return profiles(tables).drop("label_length")


def profile_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base tables whose parts were kept in two loads each, one of which came twice."""
    target = new_dir(spark, "profiles")
    for name, key in PROFILED_TABLES.items():
        rows = read_table(spark, sf_dir, name)
        odd = F.pmod(F.xxhash64(key), F.lit(2)) == 1
        for load, part in (("odd", odd), ("even", ~odd)):
            keep_profile(rows.where(part), name, target, load)
    keep_profile(rows.where(odd), name, target, "odd")
    return kept_profile(spark, target)


def date_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = day("o_orderdate").cast("string")
    values = read_table(spark, sf_dir, "orders").select(
        written.alias("all_dates"),
        F.when(F.col("o_orderstatus") == "P", F.lit("open")).otherwise(written).alias("mostly"),
        F.col("o_orderpriority").alias("none"),
    )
    return values.agg(*[date_share(name).alias(name) for name in values.columns])


def chart_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = result_flags(_profiles(spark, sf_dir))
    return charts.recommend_charts(flags, _chart_log(spark))


def distribution_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A distribution question over repeated labels, and one over distinct labels."""
    lines = read_table(spark, sf_dir, "lineitem")
    shares = lines.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("line_count"))
    segments = TESTED["q20_segment_distribution"].run(Marts(spark, sf_dir))
    flags = result_flags(profiles({"shares": shares, "segments": segments}))
    asked = [("shares", "Доля строк по статусам", ""), ("segments", "распределение", "")]
    log = spark.createDataFrame(asked, "result_id string, question string, sql string")
    return charts.recommend_charts(flags, log)


def label_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_flags(_profiles(spark, sf_dir)).select(
        "result_id", "first_category", "first_text", "label_length"
    )


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = Marts(spark, sf_dir).sales
    written = sales.select(F.col("sale_date").cast("string").alias("sale_date"), "total_amount")
    return charts.line_frame(written, "sale_date", "total_amount")


def _ranked_products(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, str, list]:
    products = Marts(spark, sf_dir).products.select("product_id", "product_name", "total_revenue")
    return products, "product_name", "total_revenue", [F.desc("total_revenue"), "product_id"]


def pie_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = TESTED["q39_category_revenue"].run(Marts(spark, sf_dir))
    return charts.pie_frame(categories, "category", "revenue", [F.desc("revenue"), "category"])


def scatter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.scatter_frame(Marts(spark, sf_dir).sales, "order_count", "total_amount")


# query log


def last_turn_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last non-empty assistant turn of each conversation."""
    turns = read_table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", F.lit(SQL_TOOL)).alias("tool"),
        F.col("text").alias("tool_input"),
    )
    return last_query(turns, "conv_id", "turn")


def _turns(**columns: Callable[[Column], Column]) -> Query:
    """Expressions over every given turn, a missing text counting as empty."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        said = F.coalesce("text", F.lit(""))
        made = [build(said).alias(name) for name, build in columns.items()]
        return read_table(spark, sf_dir, "conversations").select("conv_id", "turn", *made)

    return run


def expected_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does an assistant's turn hold each of the stated keywords?"""
    words = F.explode(F.array(*[F.lit(word) for word in TURN_WORDS["expected"]]))
    turns = read_table(spark, sf_dir, "conversations").where("role = 'assistant'")
    matches = text.matches_expected(F.col("text"), F.col("expected"))
    return turns.withColumn("expected", words).select(
        "conv_id", "turn", "expected", matches.alias("matches_expected")
    )


# sessions as a stream


def followed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of users after their events came in two parts, by time, and one batch again."""
    folder, target = new_dir(spark, "events"), new_dir(spark, "sessions")
    checkpoint = new_dir(spark, "sessions-state")
    events = read_table(spark, sf_dir, "events").select(
        "ts",
        "user_id",
        (F.col("event_type") != "error").alias("success"),
        F.col("value").alias("execution_time"),
    )
    middle = events.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    for part in (F.col("ts") <= middle, F.col("ts") > middle):
        events.where(part).write.mode("append").parquet(folder)
        query = follow_sessions(
            spark.readStream.schema(events.schema).parquet(folder),
            "user_id",
            target,
            checkpoint,
        )
        query.awaitTermination()
    return followed_counters(spark, target, "user_id")


# scalar expressions


def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        price("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        day("l_shipdate").alias("ship_date"),
    )


def concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("customer"), key, F.lit("@example.com")).alias("email"),
        F.concat("c_mktsegment", F.lit(" "), key).alias("label"),
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    band = (
        F.when(size <= 10, F.lit("small"))
        .when(size <= 30, F.lit("medium"))
        .otherwise(F.lit("large"))
    )
    return read_table(spark, sf_dir, "part").groupBy(band.alias("band")).agg(
        F.count("*").alias("part_count")
    )


def date_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = day("o_orderdate")
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_add(ordered, 30).alias("due_date"),
        F.date_sub(ordered, 7).alias("week_before"),
        F.add_months(ordered, -1).alias("month_before"),
        month_start("o_orderdate").alias("month"),
    )


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both bounds are included; they reach the scan as bounds on the raw column."""
    orders = read_table(spark, sf_dir, "orders")
    wanted = day("o_orderdate").between(
        F.lit("1999-02-01").cast("date"), F.lit("1999-02-28").cast("date")
    )
    return orders.where(wanted).select("o_orderkey", day("o_orderdate").alias("order_date"))


def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    x = (key % 317) / F.lit(100.0)
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey", x.alias("x"), (x * x).alias("x_square"), (x * x < F.lit(1.0)).alias("inside")
    )


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return read_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.lower(F.substring(body, 1, 20)).alias("start"),
        F.contains(F.lower(body), F.lit("license")).alias("has_license"),
        F.startswith(body, F.lit("E")).alias("starts_with_e"),
        F.size(F.split(body, "\n", -1)).alias("line_count"),
        F.length(text.strip(body)).alias("char_count"),
    )


def parsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is not a time becomes null."""
    orders = read_table(spark, sf_dir, "orders")
    written = F.when(
        F.col("o_orderstatus") == "O", day("o_orderdate").cast("string")
    ).otherwise(F.col("o_orderpriority"))
    return orders.select("o_orderkey", written.try_cast("timestamp_ntz").alias("parsed"))


def averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-up averages per clerk-free group of priority and status."""
    grouped = (
        read_table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", "o_orderstatus")
        .agg(exact_sum(units("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))
    )
    return grouped.select(
        "o_orderpriority", "o_orderstatus", half_up_average("total", "n").alias("average")
    )


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "a01_sales_summary": lambda s, d: Marts(s, d).sales,
        "a02_customer_stats": lambda s, d: Marts(s, d).customers,
        "a03_product_performance": lambda s, d: Marts(s, d).products,
        "a04_as_of": lambda s, d: Marts(s, d).as_of,
        "a01_kept_sales": lambda s, d: _kept(s, d).sales,
        "a02_kept_customers": lambda s, d: _kept(s, d).customers,
        "a03_kept_products": lambda s, d: _kept(s, d).products,
    }
    queries.update({key: _question(question) for key, question in TESTED.items()})
    queries.update(
        {
            "s01_csv_ingest": csv_ingest,
            "s02_file_hashes": file_hashes,
            "s03_change_detection": change_detection,
            "s03_stream_changes": stream_changes,
            "s04_lineage": lineage,
            "s05_manifest": manifest,
            "s06_load_check": load_check,
            "s07_partitioned_table": table_columns,
            "s08_rows_per_snapshot": rows_per_snapshot,
            "s09_current_rows": current_rows,
            "s10_snapshot_list": snapshot_list,
            "s11_first_snapshot": first_snapshot,
            "s13_cross_source": cross_source,
            "s14_date_series": date_rows,
            "s14_integer_series": integer_rows,
            "s15_daily_spine": spine,
            "s16_insert_if_absent": inserted_days,
            "s16_prefiltered_insert": inserted_lines,
            "s17_row_counts": table_counts,
            "s18_sample": lambda s, d: sample_rows(read_table(s, d, "customer"), ["c_custkey"]),
            "s19_bound_sql": bound_sql,
            "s19_bound_sql_first": bound_sql_first,
            "s20_affected_rows": affected_rows,
            "s21_saved_results": saved_results,
            "c01_domain_check": lambda s, d: checks.outside_domain(
                read_table(s, d, "events").select("event_id", "event_type"),
                "event_type",
                ["click", "view", "purchase", "signup"],
            ),
            "c01_segment_domain": lambda s, d: checks.outside_domain(
                Marts(s, d).customers.select("customer_id", "customer_segment"),
                "customer_segment",
                ["VIP", "New"],
            ),
            "c02_key_check_lines": keys_of("lineitem", ["l_orderkey", "l_linenumber"]),
            "c02_key_check_turns": keys_of("conversations", ["conv_id", "turn"]),
            "c03_not_null": not_null,
            "c04_possible_values": few_values,
            "c05_data_range": lambda s, d: checks.data_range(
                Marts(s, d).sales, ["sale_date", "total_amount", "order_count"]
            ),
            "c06_synonym_tags": tags,
            "c06_many_tags": many_tags,
            "c06_question_tags": question_tags,
            "v01_column_profile": _profiles,
            "v01_kept_profile": profile_of_loads,
            "v02_column_class": table_profile,
            "v03_date_share": date_shares,
            "v04_result_flags": lambda s, d: result_flags(_profiles(s, d)),
            "v05_chart_choice": chart_choice,
            "v06_label_length": label_lengths,
            "v07_distribution": distribution_choice,
            "v08_line_frame": line_rows,
            "v09_bar_frame": lambda s, d: charts.bar_frame(*_ranked_products(s, d)),
            "v10_horizontal_bar_frame": lambda s, d: charts.horizontal_bar_frame(
                *_ranked_products(s, d)
            ),
            "v11_pie_frame": pie_rows,
            "v12_scatter_frame": scatter_rows,
            "l01_aggregated_sql": _turns(
                is_aggregated=lambda said: text.is_aggregated(said, TURN_WORDS["aggregated"])
            ),
            "l02_top_n": _turns(
                is_top_n=lambda said: text.is_top_n(
                    said,
                    said,
                    TURN_WORDS["ranking"],
                    TURN_WORDS["limit"],
                    TURN_WORDS["order"],
                )
            ),
            "l03_distribution": _turns(
                is_distribution=lambda said: text.is_distribution(said, TURN_WORDS["distribution"])
            ),
            "l04_fenced_sql": _turns(
                sql=lambda said: text.fenced_sql(said, TURN_FENCE, TURN_WORDS["tag"][0])
            ),
            "l05_last_query": lambda s, d: last_query(query_log(s, d), "user_id", "event_id"),
            "l05_last_answer": last_turn_query,
            "l06_before_hint": _turns(
                message=lambda said: text.before_hint(said, TURN_WORDS["hint"][0]),
                request=lambda said: text.repair_request(
                    F.col("role"), said, TURN_WORDS["hint"][0]
                ),
            ),
            "l07_error_kind": _turns(
                kind=lambda said: text.error_kind(said, TURN_WORDS["rate"], TURN_PREFIXES),
                reported=lambda said: text.query_error(F.col("role"), said),
            ),
            "l08_matches_expected": expected_answers,
            "l09_title": _turns(title=lambda said: text.title(said, F.col("role"))),
            "t01_suite_statistics": lambda s, d: stats.suite_statistics(query_log(s, d)),
            "t02_difficulty_statistics": lambda s, d: stats.difficulty_statistics(
                query_log(s, d), "event_type", EVENT_DIFFICULTY
            ),
            "t03_session_counters": lambda s, d: stats.session_counters(
                query_log(s, d), "user_id"
            ),
            "t03_followed_sessions": followed_sessions,
            "n01_lattice_count": lambda s, d: lattice_count(
                read_table(s, d, "orders").select((F.col("o_orderkey") + 1).alias("id"))
            ),
            "f01_casts": casts,
            "f02_concat": concatenated,
            "f03_case": cases,
            "f04_date_arithmetic": date_arithmetic,
            "f05_date_range": date_range,
            "f06_arithmetic": arithmetic,
            "f07_text": text_functions,
            "f08_parsed_times": parsed_times,
            "f09_half_up_average": averages,
        }
    )
    return queries
