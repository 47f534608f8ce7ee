"""Bronze load of arriving CSV files as a stream.

``load_new_files`` appends files of new names: its checkpoint remembers which were read.
``follow_changes`` also takes files that changed under a known name. A file source cannot see
these, so its stream is a clock: each batch compares the folder with what is loaded, as the
fingerprint-checked load does, and the number of the batch names the load. A batch that is
repeated after a failure is the same load and adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakemart.sources.bronze import IngestError, ingest_csv, plain_name

QUERY_ID = "sql.streaming.queryId"


def read_new_files(spark: SparkSession, raw: str, schema: StructType | str) -> DataFrame:
    rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.csv")
        .csv(raw)
    )
    return rows.select(
        *rows.columns,
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.current_timestamp().alias("upload_timestamp"),
        plain_name().alias("original_filename"),
    )


def load_new_files(
    spark: SparkSession, raw: str, schema: StructType | str, target: str, checkpoint: str
) -> StreamingQuery:
    """Append the rows of all files that are new since the last run, then stop."""
    return (
        read_new_files(spark, raw, schema)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_changes(
    spark: SparkSession,
    data_dir: str,
    bronze: str,
    stream: str,
    batch_id: int,
    datasets: Mapping[str, tuple[str, StructType | str]] | None = None,
    **options,
) -> None:
    """Load the files that are new or changed, once for each batch of a stream.

    Only files whose size or time changed are read. A folder that is missing or empty is left
    for a later batch.
    """
    load = f"stream-{stream}-{batch_id}"
    try:
        ingest_csv(
            spark,
            data_dir,
            bronze,
            datasets,
            hash_all=False,
            load=load,
            record_skipped=False,
            **options,
        )
    except IngestError:
        return


def follow_changes(
    spark: SparkSession,
    data_dir: str,
    bronze: str,
    checkpoint: str,
    datasets: Mapping[str, tuple[str, StructType | str]] | None = None,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Keep a bronze layer up with ``raw/*.csv`` of ``data_dir``, also with changed files.

    Compares once and stops, or again ``every`` interval. The stream's id, which its
    checkpoint keeps, and the batch name a load; so one checkpoint is one stream.
    ``datasets`` and ``options`` as for ``ingest_csv``.
    """

    def compare(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty(QUERY_ID)
        load_changes(session, data_dir, bronze, stream, batch_id, datasets, **options)

    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        clock.writeStream.foreachBatch(compare)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
