"""The bounded key filter, and session counters kept up by a stream."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakemart.operators.keyfilter import key_filter, may_hold
from lakemart.operators.stats import session_counters
from lakemart.operators.upsert import absent_rows
from lakemart.streaming.session_stream import follow_sessions, followed_counters


def test_filter_misses_no_key_and_is_bounded(spark):
    known = spark.range(0, 30_000, 3).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    known = known.unionAll(spark.createDataFrame([(None, "a"), (5, None)], "k bigint, s string"))
    made = key_filter(known, ["k", "s"])
    rows = spark.range(30_000).select(F.col("id").alias("k"), F.lit("a").alias("s"), F.lit(1).alias("x"))
    kept = may_hold(rows, ["k", "s"], made)
    assert kept.columns == rows.columns
    found = {r.k for r in kept.collect()}
    assert set(range(0, 30_000, 3)) <= found and len(found) < 10_200
    few = key_filter(known, ["k", "s"], 1 << 10)
    assert few.count() <= 16  # 64-bit masks, whatever the keys
    assert set(range(0, 30_000, 3)) <= {r.k for r in may_hold(rows, ["k", "s"], few, 1 << 10).collect()}
    assert may_hold(rows, ["k", "s"], key_filter(known.limit(0), ["k", "s"])).isEmpty()


@pytest.mark.parametrize("target_rows", [0, 40_000])
def test_prefiltered_insert_is_the_same(spark, target_rows):
    target = spark.range(target_rows).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    target = target.unionAll(spark.createDataFrame([(None, 0)], "k bigint, v int"))
    incoming = spark.range(0, 60_000, 7).select((F.col("id") % 50_000).alias("k"), F.col("id").cast("int").alias("v"))
    incoming = incoming.unionAll(spark.createDataFrame([(None, 1), (None, 2)], "k bigint, v int"))
    plain = absent_rows(target, incoming, ["k"], ["v"])
    quick = absent_rows(target, incoming, ["k"], ["v"], prefilter=True)
    assert sorted(map(repr, quick.collect())) == sorted(map(repr, plain.collect()))
    held = may_hold(target.select("k"), ["k"], key_filter(incoming, ["k"]))
    assert held.count() <= target_rows // 5  # what the anti-join shuffles of the target


ROW = "ts timestamp_ntz, user bigint, success boolean, execution_time double"


def events(spark, days, seed):
    start = datetime(2024, 1, 1)
    rows = []
    for day in days:
        for n in range(60):
            at = start + timedelta(days=day, minutes=17 * n)
            time = None if n % 11 == 0 else (n * seed % 13) / 8
            rows.append((at, n % 7, n % 5 > 0, time))
    return spark.createDataFrame(rows, ROW)


def test_followed_sessions_equal_a_batch(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("rows", "days", "state"))
    everything = None

    def run():
        stream = spark.readStream.schema(ROW).parquet(folder)
        follow_sessions(stream, "user", target, state, partitions=2).awaitTermination()
        got = followed_counters(spark, target, "user")
        wanted = session_counters(everything, "user")
        assert got.columns == wanted.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))

    for number, days in enumerate(([0, 1, 2], [2, 3], [9, 10, 11], [10, 11])):
        part = events(spark, days, number + 2)
        part.write.mode("append").parquet(folder)
        everything = part if everything is None else everything.unionAll(part)
        run()
    run()  # nothing came
    assert spark.read.parquet(target).select("batch").distinct().count() >= 4


def test_a_repeated_batch_counts_once(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("rows", "days", "state"))
    events(spark, [0, 1], 3).write.parquet(folder)
    stream = spark.readStream.schema(ROW).parquet(folder)
    follow_sessions(stream, "user", target, state, partitions=2).awaitTermination()
    before = sorted(map(repr, followed_counters(spark, target, "user").collect()))
    # the commit of the batch is lost: the restart runs it again
    for file in (tmp_path / "state" / "commits").iterdir():
        file.unlink()
    stream = spark.readStream.schema(ROW).parquet(folder)
    follow_sessions(stream, "user", target, state, partitions=2).awaitTermination()
    assert sorted(map(repr, followed_counters(spark, target, "user").collect())) == before
