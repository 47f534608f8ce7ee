"""A partitioned table with snapshots and time travel on plain Parquet.

Layout: ``data/snapshot_id=<n>/<partition>=<value>/``, ``log/`` with one row per
committed snapshot, ``meta/`` with the schema. An append writes its data first and its
log row last, and readers see only snapshots in the log, so an unfinished append stays
invisible. Snapshot ids are random and their order is that of commitment, so writers that
append at the same time don't meet. A commit is dated after the newest one that its writer can
see, so a slow clock does not put it into the past.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakemart.sources.tables import path_missing

LOG_SCHEMA = "snapshot_id bigint, committed_at timestamp, operation string"
META_SCHEMA = "schema string, partition_column string"


def _read_meta(spark: SparkSession, path: str) -> Row | None:
    """Schema and partition column of a table; None if it is absent or half created."""
    try:
        return spark.read.schema(META_SCHEMA).parquet(f"{path}/meta").first()
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        meta = _read_meta(spark, self.path)
        if meta is None:
            raise FileNotFoundError(f"no table in {self.path}")
        self.partition_column = meta.partition_column
        self.schema = StructType.fromDDL(meta.schema)

    @classmethod
    def create_if_absent(
        cls, spark: SparkSession, path: str, schema: str, partition_column: str
    ) -> "VersionedTable":
        """Open the table, creating it first if it is not there."""
        path = path.rstrip("/")
        if _read_meta(spark, path) is None:
            spark.createDataFrame([], LOG_SCHEMA).write.mode("append").parquet(f"{path}/log")
            meta = spark.range(1).select(
                F.lit(schema).alias("schema"), F.lit(partition_column).alias("partition_column")
            )
            meta.write.mode("overwrite").parquet(f"{path}/meta")
        return cls(spark, path)

    def _log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")

    def append(self, rows: DataFrame) -> int:
        """Append rows as one snapshot and return its id.

        ``rebalance`` gathers the rows of a partition value into few files and still
        splits a value that holds a large share of the rows.
        """
        snapshot = uuid.uuid4().int >> 65  # 63 bits
        rows.to(self.schema).hint("rebalance", self.partition_column).write.partitionBy(
            self.partition_column
        ).parquet(f"{self.path}/data/snapshot_id={snapshot}")
        # after the newest commit, even if this writer's clock is behind
        newest = self._log().agg(F.max("committed_at")).scalar()
        after = newest + F.expr("INTERVAL 0.000001 SECOND")
        committed = self.spark.range(1).select(
            F.lit(snapshot).cast("bigint").alias("snapshot_id"),
            F.greatest(F.current_timestamp(), after).alias("committed_at"),
            F.lit("append").alias("operation"),
        )
        committed.write.mode("append").parquet(f"{self.path}/log")
        return snapshot

    def snapshots(self) -> DataFrame:
        return self._log().orderBy("committed_at", "snapshot_id")

    def current(self) -> DataFrame:
        return self._rows(self._log())

    def as_of(self, snapshot_id: int) -> DataFrame:
        """The table as it was after the given snapshot."""
        found = self._log().where(F.col("snapshot_id") == snapshot_id).first()
        if found is None:
            raise ValueError(f"no snapshot {snapshot_id} in {self.path}")
        place = F.struct("committed_at", "snapshot_id")
        last = F.struct(F.lit(found.committed_at), F.lit(found.snapshot_id).cast("bigint"))
        return self._rows(self._log().where(place <= last))

    def row_counts(self) -> DataFrame:
        """``snapshot_id, place, row_count``: rows of the table after each snapshot, in order.

        One pass counts the rows of each snapshot; the running sum is over the log's rows.
        """
        order = Window.orderBy("committed_at", "snapshot_id")
        counts = self._data(self._log()).groupBy("snapshot_id").agg(F.count("*").alias("n"))
        return (
            self._log()
            .join(counts, "snapshot_id", "left")
            .select(
                "snapshot_id",
                F.row_number().over(order).alias("place"),
                F.sum(F.coalesce("n", F.lit(0))).over(order).alias("row_count"),
            )
        )

    def _rows(self, committed: DataFrame) -> DataFrame:
        return self._data(committed).select(*[field.name for field in self.schema])

    def _data(self, committed: DataFrame) -> DataFrame:
        """Rows of the given snapshots with their id; only the folders of these are listed."""
        ids = [row.snapshot_id for row in committed.select("snapshot_id").collect()]
        stored = StructType([*self.schema.fields, StructField("snapshot_id", LongType())])
        if not ids:
            return self.spark.createDataFrame([], stored)
        root = f"{self.path}/data"
        folders = [f"{root}/snapshot_id={i}" for i in ids]
        return self.spark.read.schema(stored).option("basePath", root).parquet(*folders)
