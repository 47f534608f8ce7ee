"""Column profile of any result: what each column is good for in a chart.

One aggregate pass with bounded state per column, whatever the size of the result. Its parts,
counts and sketches by column, add up: over the tasks of a pass, over several results at once,
and over loads whose parts were kept, so that a profile of all of them reads no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.checks import SKETCH_BITS, VALUE_LIMIT, distinct_sketch, spread

NUMERIC = "numeric"
DATETIME = "datetime"
CATEGORICAL = "categorical"
TEXT = "text"

DATE_SHARE = 0.8
CATEGORY_SHARE = 0.5


def date_share(column: str) -> Column:
    """Share of the non-null values that parse as a date or time (null without values).

    All values are tested: the first hundred of a distributed frame are not defined.
    """
    return F.count(F.col(column).try_cast("timestamp_ntz")) / F.nullif(F.count(column), F.lit(0))


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _is_string(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def _declared_class(kind: T.DataType) -> str:
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return NUMERIC
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATETIME
    return TEXT


STRING = "string"
PART_KEY = ["result_id", "position", "column_name", "dtype", "declared", "num_cols"]


def _parts_of(df: DataFrame, result: str) -> DataFrame:
    strings = [i for i, field in enumerate(df.schema) if _is_string(field.dataType)]
    facts = [F.expr("count(*) AS num_rows")]
    for i in strings:
        name = "`" + df.columns[i].replace("`", "``") + "`"
        facts += [
            distinct_sketch(name).alias(f"sketch{i}"),
            F.expr(f"count(try_cast({name} AS timestamp_ntz)) AS dates{i}"),
            F.expr(f"count({name}) AS values{i}"),
            F.expr(f"max(length({name})) AS longest{i}"),
        ]
    # without text columns there are no sketches to merge
    measured = (df.groupBy(spread()) if strings else df).agg(*facts)

    def entries(num_rows: str, measured_too: bool) -> str:
        made = []
        for i, field in enumerate(df.schema):
            own = i in strings and measured_too
            kind = STRING if i in strings else _declared_class(field.dataType)
            made.append(
                f"struct({_literal(result)} AS result_id, {i} AS position, "
                f"{_literal(field.name)} AS column_name, "
                f"{_literal(field.dataType.simpleString())} AS dtype, "
                f"'{kind}' AS declared, {len(df.columns)} AS num_cols, "
                f"{num_rows} AS num_rows, "
                f"CAST({f'dates{i}' if own else 'NULL'} AS bigint) AS num_dates, "
                f"CAST({f'values{i}' if own else 'NULL'} AS bigint) AS num_values, "
                f"CAST({f'longest{i}' if own else 'NULL'} AS int) AS longest, "
                f"CAST({f'sketch{i}' if own else 'NULL'} AS binary) AS sketch)"
            )
        return f"inline(array({', '.join(made)}))"

    parts = measured.selectExpr(entries("num_rows", True))
    # a result without rows has columns, too
    return parts.unionAll(df.sparkSession.sql(f"SELECT {entries('0L', False)}"))


def _merged(parts: DataFrame, sketch: str) -> DataFrame:
    return parts.groupBy(*PART_KEY).agg(
        *(F.sum(c).alias(c) for c in ("num_rows", "num_dates", "num_values")),
        F.max("longest").alias("longest"),
        F.expr(sketch),
    )


def profile_parts(df: DataFrame, result: str = "result") -> DataFrame:
    """What adds up to the profile of ``df``: one row per column, with a sketch of its values.

    The rows are written as SQL text: a result may have hundreds of columns, and one
    expression each would be slow to build.
    """
    return _merged(_parts_of(df, result), f"theta_union_agg(sketch, {SKETCH_BITS}) AS sketch")


def profile_of(parts: DataFrame) -> DataFrame:
    """One row per result and column from the parts of some results or loads.

    ``result_id, position, column_name, dtype, column_class, num_rows, num_cols,
    label_length``. A string column is a date if most values parse, a category if it has
    fewer than 50 values and fewer than half as many as rows, else text. An empty result
    has no classes and no columns to offer.
    """
    union = f"theta_sketch_estimate(theta_union_agg(sketch, {SKETCH_BITS})) AS different"
    kind = (
        f"CASE WHEN declared <> '{STRING}' THEN declared "
        f"WHEN num_dates / nullif(num_values, 0) > {DATE_SHARE} THEN '{DATETIME}' "
        f"WHEN different < num_rows * {CATEGORY_SHARE} AND different < {VALUE_LIMIT} "
        f"THEN '{CATEGORICAL}' ELSE '{TEXT}' END"
    )
    return _merged(parts, union).selectExpr(
        "result_id",
        "position",
        "column_name",
        "dtype",
        f"IF(num_rows > 0, {kind}, NULL) AS column_class",
        "num_rows",
        "IF(num_rows > 0, num_cols, 0) AS num_cols",
        "longest AS label_length",
    )


def profile(df: DataFrame, result: str = "result") -> DataFrame:
    """The profile of one result; see :func:`profile_of`."""
    return profiles({result: df})


def profiles(results: dict[str, DataFrame]) -> DataFrame:
    """The profiles of several results, merged in one aggregate."""
    return profile_of(reduce(DataFrame.unionAll, (_parts_of(df, r) for r, df in results.items())))


def keep_profile(df: DataFrame, result: str, target: str, load: str) -> None:
    """Keep the parts of a load of rows; a load of the same name is replaced."""
    parts = profile_parts(df, result)
    parts.drop("result_id").write.mode("overwrite").parquet(
        f"{target}/result_id={result}/load={load}"
    )


def kept_profile(spark: SparkSession, target: str) -> DataFrame:
    """The profile of all kept loads, from their parts alone."""
    parts = spark.read.option("basePath", target).parquet(f"{target}/result_id=*/load=*")
    return profile_of(parts.withColumn("result_id", F.col("result_id").cast("string")))


def result_flags(profiles: DataFrame) -> DataFrame:
    """One row per result: sizes, flags, and the first columns of each class."""
    kind = F.col("column_class")

    def first(wanted: str, fact: str = "column_name") -> Column:
        """A fact of the first column of a class."""
        is_wanted = kind == wanted
        return F.min_by(F.when(is_wanted, F.col(fact)), F.when(is_wanted, F.col("position")))

    numeric = F.array_sort(
        F.collect_list(F.when(kind == NUMERIC, F.struct("position", "column_name")))
    )
    grouped = profiles.groupBy("result_id").agg(
        F.max("num_rows").alias("num_rows"),
        F.max("num_cols").alias("num_cols"),
        F.count_if(kind == NUMERIC).alias("numeric_columns"),
        F.count_if(kind == DATETIME).alias("datetime_columns"),
        F.count_if(kind == CATEGORICAL).alias("categorical_columns"),
        F.count_if(kind == TEXT).alias("text_columns"),
        numeric.alias("numeric"),
        first(DATETIME).alias("first_datetime"),
        first(CATEGORICAL).alias("first_category"),
        first(TEXT).alias("first_text"),
        first(CATEGORICAL, "label_length").alias("category_length"),
        first(TEXT, "label_length").alias("text_length"),
    )
    return grouped.select(
        "result_id",
        "num_rows",
        "num_cols",
        (F.col("num_rows") == 0).alias("is_empty"),
        ((F.col("num_rows") == 1) & (F.col("numeric_columns") == 1)).alias("is_single_value"),
        (F.col("datetime_columns") > 0).alias("has_timeseries"),
        (F.col("categorical_columns") > 0).alias("has_categories"),
        "numeric_columns",
        "datetime_columns",
        "categorical_columns",
        "text_columns",
        F.get("numeric", F.lit(0))["column_name"].alias("first_numeric"),
        F.get("numeric", F.lit(1))["column_name"].alias("second_numeric"),
        "first_datetime",
        "first_category",
        "first_text",
        F.when(F.col("first_category").isNotNull(), F.col("category_length"))
        .otherwise(F.col("text_length"))
        .alias("label_length"),
    )
