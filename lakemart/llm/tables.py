"""The given tables, and folders for what is written between two jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import new_dir, remove_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: a lost executor repeats the tasks after this point only, and nothing
    before it runs twice.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written between the jobs of one run, in a folder of their own.

    ``close`` removes those that nothing returned still reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self._paths: list[str] = []

    def staged(self, df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
        """As :func:`staged`."""
        path = new_dir(self.spark, f"{self.label}-{label}")
        df.write.option("compression", compression).parquet(path)
        self._paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def kept(self, df: DataFrame, label: str) -> DataFrame:
        """As ``staged``, for a table that the result of the run reads."""
        out = self.staged(df, label)
        self.keep_last()
        return out

    def keep_last(self) -> None:
        """The result reads the table that was staged last."""
        self._paths.pop()

    def drop_earlier(self) -> None:
        """Remove all but the table that was staged last, which is read on."""
        *earlier, last = self._paths
        for path in earlier:
            remove_dir(self.spark, path)
        self._paths = [last]

    def close(self) -> None:
        for path in self._paths:
            remove_dir(self.spark, path)
        self._paths = []


def computed_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` behind a generator of one row per row.

    A filter on a column is otherwise moved below the projection that computes it and repeats
    its expression, inside lambdas once per element. It is not moved below a generator.
    """
    fields = F.array(F.struct(*columns))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(fields))
