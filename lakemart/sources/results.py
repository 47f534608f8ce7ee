"""Sinks for results: counted writes and the JSON report of a suite."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakemart.operators.stats import suite_statistics


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write a frame and return the number of rows written, without a second pass.

    The observation sits directly below the write, in the stage that commits its
    output, where each task reports once.
    """
    observed = Observation()
    write(df.observe(observed, F.count(F.lit(1)).alias("rowcount")))
    return int(observed.get["rowcount"])


def save_results(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write suite results and their statistics as JSON below ``path``.

    Times in the report are rounded to hundredths of a second.
    """
    times = ["avg_execution_time", "min_execution_time", "max_execution_time"]
    report = suite_statistics(results).withColumns(
        {**{name: F.round(name, 2) for name in times}, "timestamp": F.current_timestamp()}
    )
    results.write.mode(mode).json(f"{path}/results")
    report.write.mode(mode).json(f"{path}/statistics")
