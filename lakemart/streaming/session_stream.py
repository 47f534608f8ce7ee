"""Session counters kept up by a stream.

The state holds one row for each session and day, and drops a day once the watermark has passed
it. Each batch writes the rows it changed, under its number; a batch that is repeated after a
failure writes the same folder again. The counters of a session are the sums of its days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.functions.money import exact_sum, units

TIME = "decimal(28,6)"
STATE_PARTITIONS = 16


def changed_days(rows: DataFrame, session: str, delay: str) -> DataFrame:
    """Counters by session and day of ``ts``; rows later than ``delay`` may be left out."""
    timed = exact_sum(units("execution_time", 6), 6, TIME)
    return (
        rows.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .groupBy(session, F.window("ts", "1 day").alias("day"))
        .agg(
            F.count("*").alias("total_queries"),
            F.count_if("success").alias("successful_queries"),
            F.coalesce(timed, F.lit(0).cast(TIME)).alias("total_time"),
        )
    )


def follow_sessions(
    rows: DataFrame,
    session: str,
    target: str,
    checkpoint: str,
    delay: str = "2 days",
    every: str | None = None,
    partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """Keep the counters of ``ts, session, success, execution_time`` up, a stream of rows.

    Takes what there is and stops, or goes on at an interval. ``partitions`` is the number of
    parts of the state, which the first run fixes. One checkpoint goes with one target.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        return (
            changed_days(rows, session, delay)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**({"availableNow": True} if every is None else {"processingTime": every}))
            .start()
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def followed_counters(spark: SparkSession, target: str, session: str) -> DataFrame:
    """Counters of each session from the latest row of each of its days."""
    rows = spark.read.parquet(target)
    facts = F.struct("total_queries", "successful_queries", "total_time")
    latest = rows.groupBy(session, "day").agg(F.max_by(facts, "batch").alias("latest"))
    total = F.sum("latest.total_time").cast("double")
    number, good = F.sum("latest.total_queries"), F.sum("latest.successful_queries")
    return latest.groupBy(session).agg(
        number.alias("total_queries"),
        good.alias("successful_queries"),
        (number - good).alias("failed_queries"),
        total.alias("total_time"),
        (total / number).alias("avg_time"),
    )
