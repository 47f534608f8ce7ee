"""Jobs for spark-submit: ``spark-submit lakemart/jobs.py <job> ...``.

ingest   load new and changed CSV files into the bronze layer, write the manifest, verify
sales    create the versioned sales table, append rows, list snapshots, read the first one
marts    compute the three marts once and store them
ask      answer a published question and show the rows of its chart
suite    run the question suite (or one difficulty) and save its results as JSON
lattice  count the numbers 1..n inside the unit circle of the lattice
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from lakemart.operators.lattice import lattice_count  # noqa: E402
from lakemart.operators.stats import suite_statistics  # noqa: E402
from lakemart.plans.ask import ask, run_suite  # noqa: E402
from lakemart.plans.corpus import questions_by_difficulty  # noqa: E402
from lakemart.plans.marts import Marts, StoredMarts  # noqa: E402
from lakemart.session import get_spark  # noqa: E402
from lakemart.sources import bronze  # noqa: E402
from lakemart.sources.results import save_results  # noqa: E402
from lakemart.sources.series import integer_series  # noqa: E402
from lakemart.sources.versioned import VersionedTable  # noqa: E402


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    batch = bronze.ingest_csv(spark, args.data, args.bronze, metadata={"dataset": args.dataset})
    batch.groupBy("status").count().show()
    batch.where("status = 'failed'").select("object_name").show(truncate=False)
    bronze.save_manifest(spark, args.bronze)
    bronze.verify_load(spark, args.bronze).show()


def sales(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = spark.read.parquet(args.rows)
    schema = "id bigint, product string, amount double, date date"
    table = VersionedTable.create_if_absent(spark, args.table, schema, "date")
    table.append(rows)
    table.current().show()
    table.snapshots().show(truncate=False)
    table.as_of(table.snapshots().first().snapshot_id).show()


def marts(spark: SparkSession, args: argparse.Namespace) -> None:
    Marts(spark, args.facts).save(args.target)


def _marts(spark: SparkSession, args: argparse.Namespace) -> Marts:
    return StoredMarts(spark, args.marts) if args.marts else Marts(spark, args.facts)


def ask_question(spark: SparkSession, args: argparse.Namespace) -> None:
    answer = ask(_marts(spark, args), args.question)
    answer.rows.show(20, truncate=False)
    print(answer.chart)
    if answer.chart_rows is not None:
        answer.chart_rows.show(20, truncate=False)


def suite(spark: SparkSession, args: argparse.Namespace) -> None:
    results = run_suite(_marts(spark, args), questions_by_difficulty(args.difficulty))
    suite_statistics(results).show(vertical=True)
    save_results(results, args.output)


def lattice(spark: SparkSession, args: argparse.Namespace) -> None:
    lattice_count(integer_series(spark, 1, args.n)).show()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(
        description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    top.add_argument("--shuffle-gb", type=int, help="size of the largest shuffle to expect")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest")
    job.add_argument("data", help="folder with a raw/ part")
    job.add_argument("bronze")
    default = bronze.METADATA["dataset"]
    job.add_argument("--dataset", default=default, help="tag of the files loaded")
    job.set_defaults(run=ingest)

    job = jobs.add_parser("sales")
    job.add_argument("table")
    job.add_argument("rows", help="Parquet rows with id, product, amount, date")
    job.set_defaults(run=sales)

    job = jobs.add_parser("marts")
    job.add_argument("facts")
    job.add_argument("target")
    job.set_defaults(run=marts)

    for name, run in (("ask", ask_question), ("suite", suite)):
        job = jobs.add_parser(name)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--facts", help="folder of fact tables")
        source.add_argument("--marts", help="folder of stored marts")
        job.set_defaults(run=run)
        if name == "ask":
            job.add_argument("question")
        else:
            job.add_argument("output")
            job.add_argument("--difficulty", default="all")

    job = jobs.add_parser("lattice")
    job.add_argument("--n", type=int, default=500_000)
    job.set_defaults(run=lattice)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    size = None if args.shuffle_gb is None else args.shuffle_gb << 30
    args.run(get_spark(f"lakemart {args.job}", shuffle_bytes=size), args)


if __name__ == "__main__":
    main()
