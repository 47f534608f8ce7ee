import pytest
from pyspark.sql import functions as F

from lakemart.operators import checks, stats
from lakemart.operators.lattice import lattice_count
from lakemart.plans.corpus import GROUP_DIFFICULTY


def test_outside_domain(spark):
    df = spark.createDataFrame([(1, "VIP"), (2, "vip"), (3, None), (4, "New")], "id int, s string")
    found = {r.id: r.problem for r in checks.outside_domain(df, "s", ["VIP", "New"]).collect()}
    assert found == {2: "outside", 3: "null"}


def test_keys(spark):
    rows = [(1, 1), (1, 2), (1, 2), (None, 1), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    rows = checks.key_violations(df, ["a", "b"]).collect()
    assert {(r.a, r.b): (r.row_count, r.problem) for r in rows} == {
        (1, 2): (2, "duplicate"),
        (None, 1): (1, "null key"),
        (2, None): (2, "null key"),
    }


def test_nulls_and_ranges(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string")
    nulls = {r.column_name: (r.null_count, r.row_count) for r in checks.null_counts(df).collect()}
    assert nulls == {"a": (1, 3), "b": (2, 3)}
    ranges = {r.column_name: tuple(r)[1:] for r in checks.data_range(df, ["a", "b"]).collect()}
    assert ranges == {"a": ("1", "2", 2), "b": ("x", "x", 1)}


def test_possible_values_of_all_columns(spark):
    df = spark.range(1000).select(
        (F.col("id") % 49).cast("string").alias("few"),
        (F.col("id") % 50).alias("many"),
        F.lit(None).cast("string").alias("none"),
    )
    rows = checks.possible_values(df, df.columns).collect()
    found = {c: {r.value for r in rows if r.column_name == c} for c in df.columns}
    assert len(rows) == 49 + 50 + 1
    assert found["few"] == {str(i) for i in range(49)}
    assert found["many"] == {str(i) for i in range(50)} and found["none"] == {None}
    assert checks.possible_values(df.limit(0), ["many"]).count() == 0


RESULTS = "grp string, session string, success boolean, execution_time double"


@pytest.fixture(scope="module")
def results(spark):
    rows = [
        ("simple", "s1", True, 1.0),
        ("filter", "s1", True, 2.0),
        ("ranking", "s2", True, 4.0),
        ("complex", "s2", False, None),
        ("unknown", "s2", True, 0.5),
    ]
    return spark.createDataFrame(rows, RESULTS)


def test_suite_statistics(spark, results):
    row = stats.suite_statistics(results).first()
    assert (row.total_queries, row.successful, row.failed, row.success_rate) == (5, 4, 1, 80.0)
    assert row.avg_execution_time == 1.875
    assert (row.min_execution_time, row.max_execution_time) == (0.5, 4.0)
    assert stats.suite_statistics(spark.createDataFrame([], RESULTS)).count() == 0
    failed = stats.suite_statistics(results.where("NOT success")).first()
    assert (failed.avg_execution_time, failed.max_execution_time) == (0.0, 0.0)


def test_difficulty(results):
    rows = stats.difficulty_statistics(results, "grp", GROUP_DIFFICULTY).collect()
    found = {r.difficulty: (r.total_queries, r.successful) for r in rows}
    assert found == {"easy": (2, 2), "medium": (1, 1), "hard": (1, 0), "all": (5, 4)}


def test_sessions(results):
    rows = {r.session: r for r in stats.session_counters(results, "session").collect()}
    assert (rows["s1"].total_queries, rows["s1"].avg_time) == (2, 1.5)
    assert (rows["s2"].failed_queries, rows["s2"].total_time) == (1, 4.5)
    assert rows["s2"].avg_time == 1.5


def test_lattice(spark):
    row = lattice_count(spark.range(1, 500_001)).first()
    assert (row.inside, row.n, row.estimate) == (46268, 500_000, 0.370144)
