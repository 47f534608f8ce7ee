import re
from datetime import date

import pytest
from tests.conftest import SMALL

from lakemart import jobs
from lakemart.session import new_dir

SALES = "id bigint, product string, amount double, date date"


def test_ingest(spark, tmp_path, capsys):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("x\n1\n")
    target = new_dir(spark, "bronze")
    jobs.main(["ingest", str(tmp_path), target])
    jobs.main(["ingest", str(tmp_path), target])
    shown = capsys.readouterr().out
    assert "new" in shown and "skip" in shown


def test_sales(spark, tmp_path, capsys):
    rows = str(tmp_path / "rows")
    spark.createDataFrame([(1, "Laptop", 1200.0, date(2024, 1, 15))], SALES).write.parquet(rows)
    jobs.main(["sales", new_dir(spark, "sales"), rows])
    assert "Laptop" in capsys.readouterr().out


def test_marts_and_questions(spark, capsys, tmp_path):
    target = new_dir(spark, "marts")
    jobs.main(["marts", SMALL, target])
    jobs.main(["ask", "--marts", target, "Топ-10 дней с максимальной выручкой"])
    assert "'chart_type': 'line'" in capsys.readouterr().out
    jobs.main(["suite", "--marts", target, str(tmp_path / "out"), "--difficulty", "easy"])
    assert re.search(r"total_queries +\| 10\b", capsys.readouterr().out)


def test_lattice(spark, capsys):
    jobs.main(["lattice"])
    assert "46268" in capsys.readouterr().out


def test_a_job_needs_a_name():
    with pytest.raises(SystemExit):
        jobs.main([])
