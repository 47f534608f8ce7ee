"""Queries with Python workers, from another folder and without a path to the package."""

import os
import subprocess
import sys
from pathlib import Path

from tests.conftest import SMALL

ROOT = Path(__file__).resolve().parents[2]

PROGRAM = f"""
import sys
sys.path.append({str(ROOT)!r})
import __spark_entry__ as contract
sys.path.remove({str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("op2_byte_bpe", "op9_knn"):
    print("rows", contract.queries()[name](spark, {SMALL!r}).count())
"""


def test_workers_find_the_package(tmp_path):
    clean = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tmp_path, env=clean, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr[-3000:]
    rows = [int(x.split()[1]) for x in done.stdout.splitlines() if x.startswith("rows")]
    assert len(rows) == 2 and min(rows) > 0
