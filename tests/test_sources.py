import json
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.operators.upsert import absent_rows, insert_absent
from lakemart.session import initial_partitions, new_dir, shared_dir
from lakemart.sources import bronze, series
from lakemart.sources.federated import query_sources
from lakemart.sources.jdbc import jdbc_options
from lakemart.sources.results import save_results, write_counted
from lakemart.sources.tables import row_counts, run_sql, sample_rows
from lakemart.sources.versioned import VersionedTable
from lakemart.streaming.bronze_stream import follow_changes, load_changes, load_new_files

ITEMS = "id bigint, name string, price double"


@pytest.fixture
def data_dir(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "items_a.csv").write_text("id,name,price\n1,bolt,1.5\n2,nut,2.5\n")
    (raw / "items_b.csv").write_text('id,name,price\n3,"a, b",3.5\n')
    (raw / "notes.csv").write_text("who,what\nann,hello\n")
    (raw / "readme.txt").write_text("not a table")
    (raw / "deeper").mkdir()
    (raw / "deeper" / "items_c.csv").write_text("id,name,price\n9,no,9\n")
    return tmp_path


DATASETS = {"items": ("items_*.csv", ITEMS)}


def statuses(batch):
    return {r.original_filename: r.status for r in batch.collect()}


def test_load_reload_change(spark, data_dir):
    target = new_dir(spark, "bronze")
    first = bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    assert statuses(first) == {"items_a.csv": "new", "items_b.csv": "new", "notes.csv": "new"}
    rows = {r.id: r.name for r in bronze.read_bronze(spark, target, "items").collect()}
    assert rows == {1: "bolt", 2: "nut", 3: "a, b"}
    assert bronze.read_bronze(spark, target, "notes").first().what == "hello"

    again = bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    assert set(statuses(again).values()) == {"skip"}
    assert bronze.read_bronze(spark, target, "items").count() == 3

    (data_dir / "raw" / "items_a.csv").write_text("id,name,price\n1,Bolt,1.5\n")
    changed = bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    assert statuses(changed) == {
        "items_a.csv": "changed",
        "items_b.csv": "skip",
        "notes.csv": "skip",
    }
    rows = {r.id: r.name for r in bronze.read_bronze(spark, target, "items").collect()}
    assert rows == {1: "Bolt", 3: "a, b"}
    assert bronze.loaded_files(spark, target).count() == 3


def test_lineage_and_manifest(spark, data_dir):
    target = new_dir(spark, "bronze")
    bronze.ingest_csv(spark, str(data_dir), target, DATASETS, {"source": "test", "owner": "me"})
    files = {r.original_filename: r for r in bronze.loaded_files(spark, target).collect()}
    path = data_dir / "raw" / "items_a.csv"
    entry = files["items_a.csv"]
    assert entry.size_bytes == path.stat().st_size
    assert entry.object_name == "raw/items_a.csv"
    assert entry.metadata["md5hash"] == entry.md5hash
    assert entry.metadata["file_size_bytes"] == str(entry.size_bytes)
    assert (entry.metadata["layer"], entry.metadata["source"]) == ("bronze", "test")
    assert entry.metadata["owner"] == "me"

    def documents(**options):
        bronze.save_manifest(spark, target, **options)
        found = Path(target, "manifest", "document").glob("part-*.json")
        return [json.loads(line) for p in found for line in p.read_text().splitlines()]

    (whole,) = documents()
    assert whole["status"] == "completed" and whole["bronze_bucket"] == "lakehouse-bronze"
    names = ["raw/items_a.csv", "raw/items_b.csv", "raw/notes.csv"]
    assert sorted(f["object_name"] for f in whole["files"]) == names
    parts = documents(document_files=1)
    assert {p["parts"] for p in parts} == {3}
    assert sorted(f["object_name"] for p in parts for f in p["files"]) == names
    assert spark.read.json(f"{target}/manifest/header").first().file_count == 3
    checked = bronze.verify_load(spark, target).first()
    total = sum(r.size_bytes for r in files.values())
    assert (checked.file_count, checked.size_mb) == (3, total / 1048576)


def fingerprints(spark, raw):
    found = bronze.content_hashes(spark, str(raw)).collect()
    return {r.original_filename: r.md5hash for r in found}


def test_fingerprint_sees_every_change(spark, data_dir):
    raw = data_dir / "raw"
    (raw / "empty.csv").write_text("")
    (raw / "a b+%20.csv").write_text("x\n1\n")
    before = fingerprints(spark, raw)
    names = {"items_a.csv", "items_b.csv", "notes.csv", "empty.csv", "a b+%20.csv"}
    assert set(before) == names and len(set(before.values())) == 5
    assert before == fingerprints(spark, raw)
    for text in (
        "id,name,price\n2,nut,2.5\n1,bolt,1.5\n",  # lines change places
        "id,name,price\n1,bolt,1.5\n2,nut,2.5",  # no last line end
        "id,name,price\n1,bolt,1.5\n2,nut,2.6\n",
    ):
        (raw / "items_a.csv").write_text(text)
        after = fingerprints(spark, raw)
        assert after.pop("items_a.csv") != before["items_a.csv"]
        assert after.items() <= before.items()


def test_fingerprint_does_not_depend_on_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("".join(f"{i},row {i * i}\n" for i in range(20_000)))
    found = set()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("30k", "101k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found.add(fingerprints(spark, tmp_path)["big.csv"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert len(found) == 1


def test_file_that_becomes_header_only_loses_its_rows(spark, data_dir):
    target = new_dir(spark, "bronze")
    bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    (data_dir / "raw" / "items_a.csv").write_text("id,name,price\n")
    changed = bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    assert statuses(changed)["items_a.csv"] == "changed"
    assert [r.id for r in bronze.read_bronze(spark, target, "items").collect()] == [3]


def test_blank_in_a_name_keeps_its_lineage(spark, data_dir):
    target = new_dir(spark, "bronze")
    (data_dir / "raw" / "items_x y+%20.csv").write_text("id,name,price\n5,x,1\n")
    bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    files = bronze.loaded_files(spark, target)
    rows = bronze.read_bronze(spark, target, "items").join(files, "original_filename")
    assert {r.original_filename for r in rows.collect()} == {
        "items_a.csv",
        "items_b.csv",
        "items_x y+%20.csv",
    }


def test_files_of_known_size_and_time_are_not_read_again(spark, data_dir, monkeypatch):
    target = new_dir(spark, "bronze")
    first = bronze.ingest_csv(spark, str(data_dir), target, DATASETS, hash_all=False)
    assert set(statuses(first).values()) == {"new"}
    (data_dir / "raw" / "items_b.csv").write_text("id,name,price\n3,longer name,3.5\n")
    read = []
    whole = bronze.content_hashes

    def noted(session, files, *rest):
        read.append(files)
        return whole(session, files, *rest)

    monkeypatch.setattr(bronze, "content_hashes", noted)
    second = bronze.ingest_csv(spark, str(data_dir), target, DATASETS, hash_all=False)
    assert statuses(second) == {
        "items_a.csv": "skip",
        "items_b.csv": "changed",
        "notes.csv": "skip",
    }
    assert [[Path(f).name for f in files] for files in read] == [["items_b.csv"]]
    third = bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    assert set(statuses(third).values()) == {"skip"}


def test_missing_and_empty_folder(spark, tmp_path):
    with pytest.raises(bronze.IngestError):
        bronze.ingest_csv(spark, str(tmp_path / "none"), new_dir(spark, "bronze"))
    (tmp_path / "raw").mkdir()
    with pytest.raises(bronze.IngestError):
        bronze.ingest_csv(spark, str(tmp_path), new_dir(spark, "bronze"))
    with pytest.raises(bronze.IngestError):
        bronze.verify_load(spark, new_dir(spark, "bronze"))


@pytest.mark.parametrize("text", ["id,name,price\nthree,x,3.5\n", "id,title,price\n3,x,3.5\n"])
def test_bad_file_is_reported_and_tried_again(spark, data_dir, text):
    target = new_dir(spark, "bronze")
    bad = data_dir / "raw" / "items_b.csv"
    bad.write_text(text)
    batch = bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    wanted = {"items_a.csv": "new", "items_b.csv": "failed", "notes.csv": "new"}
    assert statuses(batch) == wanted
    assert bronze.loaded_files(spark, target).count() == 2
    assert sorted(r.id for r in bronze.read_bronze(spark, target, "items").collect()) == [1, 2]
    bad.write_text("id,name,price\n3,x,3.5\n")
    again = bronze.ingest_csv(spark, str(data_dir), target, DATASETS)
    wanted = {"items_a.csv": "skip", "items_b.csv": "new", "notes.csv": "skip"}
    assert statuses(again) == wanted
    assert bronze.read_bronze(spark, target, "items").count() == 3


def test_many_tables_are_few_jobs(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "bronze")
    raw.mkdir()
    headers = ["id,name", "who,what,when", "a"]
    for n in range(90):
        header = headers[n % 3]
        fields = len(header.split(","))
        line = ",".join(f"{n}-{k}" for k in range(fields))
        (raw / f"table {n}.csv").write_text(f"{header}\n{line}\n{line}\n")
    (raw / "table 4.csv").write_text("id,name\n1,2,3\n")  # a line that does not fit
    context = spark.sparkContext
    context.setJobGroup("many tables", "")
    batch = bronze.ingest_csv(spark, str(tmp_path), target)
    jobs = len(context.statusTracker().getJobIdsForGroup("many tables"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 45
    found = statuses(batch)
    assert found.pop("table 4.csv") == "failed" and set(found.values()) == {"new"}
    rows = bronze.read_bronze(spark, target, "table 1").collect()
    assert [(r.who, r.what, r.when) for r in rows] == [("1-0", "1-1", "1-2")] * 2
    assert bronze.read_bronze(spark, target, "table 4").isEmpty()
    (raw / "table 1.csv").write_text("id,name\n5,6\n")  # another header now
    bronze.ingest_csv(spark, str(tmp_path), target)
    (row,) = bronze.read_bronze(spark, target, "table 1").collect()
    assert (row.id, row.name) == ("5", "6")


def test_stream_takes_each_file_once(spark, data_dir, tmp_path):
    raw, target = str(data_dir / "raw"), str(tmp_path / "landed")
    (data_dir / "raw" / "notes.csv").write_text("id,name,price\n7,seven,7\n")

    def run():
        load_new_files(spark, raw, ITEMS, target, str(tmp_path / "state")).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(target).collect())

    assert run() == [1, 2, 3, 7]
    assert run() == [1, 2, 3, 7]
    (data_dir / "raw" / "items_d.csv").write_text("id,name,price\n4,four,4\n")
    assert run() == [1, 2, 3, 4, 7]
    names = {r.original_filename for r in spark.read.parquet(target).collect()}
    assert names == {"items_a.csv", "items_b.csv", "items_d.csv", "notes.csv"}


def test_stream_takes_changed_files(spark, data_dir, tmp_path):
    target, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    first = data_dir / "raw" / "items_a.csv"

    def run():
        query = follow_changes(spark, str(data_dir), target, state, DATASETS)
        query.awaitTermination()
        rows = bronze.read_bronze(spark, target, "items").collect()
        return query.id, sorted((r.id, r.name) for r in rows)

    stream, rows = run()
    assert rows == [(1, "bolt"), (2, "nut"), (3, "a, b")]
    first.write_text("id,name,price\n1,Bolt,1.5\n5,screw,2.5\n")
    assert run() == (stream, [(1, "Bolt"), (3, "a, b"), (5, "screw")])
    (data_dir / "raw" / "items_d.csv").write_text("id,name,price\n4,four,4\n")
    changed = run()
    assert changed == (stream, [(1, "Bolt"), (3, "a, b"), (4, "four"), (5, "screw")])
    assert run() == changed  # nothing new
    entries = spark.read.parquet(f"{target}/files")
    loads = {(r.original_filename, r.load.rsplit("-", 1)[1]) for r in entries.collect()}
    names = ["items_a.csv", "items_b.csv", "notes.csv"]
    wanted = {(name, "0") for name in names} | {("items_a.csv", "1"), ("items_d.csv", "2")}
    assert loads == wanted and entries.count() == len(wanted)
    for batch_id in range(4):  # batches that a restart repeats
        load_changes(spark, str(data_dir), target, stream, batch_id, DATASETS)
    assert spark.read.parquet(f"{target}/files").count() == len(wanted)
    assert bronze.read_bronze(spark, target, "items").count() == 4


def test_repeated_batch_ends_what_a_dead_one_began(spark, data_dir, tmp_path, monkeypatch):
    target = str(tmp_path / "bronze")

    def load(batch_id):
        load_changes(spark, str(data_dir), target, "s", batch_id, DATASETS)

    with monkeypatch.context() as patch:
        patch.setattr(bronze, "_bad_files", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load(0)
    assert bronze.loaded_files(spark, target).isEmpty()
    load(0)
    load(0)
    assert sorted(r.id for r in bronze.read_bronze(spark, target, "items").collect()) == [1, 2, 3]
    assert spark.read.parquet(f"{target}/files").count() == 3
    # entries of which only some were recorded
    (data_dir / "raw" / "items_e.csv").write_text("id,name,price\n8,eight,8\n")
    (data_dir / "raw" / "items_f.csv").write_text("id,name,price\n9,nine,9\n")
    load(1)
    entries = spark.read.parquet(f"{target}/files").where("original_filename <> 'items_f.csv'")
    kept = entries.collect()
    partial = spark.createDataFrame(kept, entries.schema).coalesce(1)
    partial.write.mode("overwrite").parquet(f"{target}/files")
    load(1)
    assert sorted(r.id for r in bronze.read_bronze(spark, target, "items").collect()) == [1, 2, 3, 8, 9]


def test_stream_waits_for_a_folder(spark, tmp_path):
    target = str(tmp_path / "bronze")
    load_changes(spark, str(tmp_path), target, "s", 0)
    (tmp_path / "raw").mkdir()
    load_changes(spark, str(tmp_path), target, "s", 1)
    assert bronze.loaded_files(spark, target).isEmpty()


SALES = "id bigint, product string, amount double, date date"
# The published rows of the sales table.
KNOWN = [
    (1, "Laptop", 1200.0, date(2024, 1, 15)),
    (2, "Mouse", 25.0, date(2024, 1, 16)),
    (3, "Keyboard", 75.0, date(2024, 1, 16)),
]


def test_a_slow_clock_does_not_change_the_past(spark):
    path = new_dir(spark, "sales")
    table = VersionedTable.create_if_absent(spark, path, SALES, "date")
    first = table.append(spark.createDataFrame(KNOWN[:1], SALES))
    # another writer, whose clock is a day ahead
    ahead = spark.range(1).select(
        F.lit(7).cast("bigint").alias("snapshot_id"),
        (F.current_timestamp() + F.expr("INTERVAL 1 DAY")).alias("committed_at"),
        F.lit("append").alias("operation"),
    )
    spark.createDataFrame(KNOWN[1:2], SALES).write.partitionBy("date").parquet(
        f"{path}/data/snapshot_id=7"
    )
    ahead.write.mode("append").parquet(f"{path}/log")
    last = table.append(spark.createDataFrame(KNOWN[2:], SALES))
    assert [r.snapshot_id for r in table.snapshots().collect()] == [first, 7, last]
    assert table.as_of(7).count() == 2 and table.as_of(last).count() == 3


def test_snapshots(spark):
    path = new_dir(spark, "sales")
    table = VersionedTable.create_if_absent(spark, path, SALES, "date")
    assert table.current().count() == 0 and table.snapshots().count() == 0
    known = spark.createDataFrame(KNOWN, SALES)
    ids = [table.append(known), table.append(known)]
    again = VersionedTable.create_if_absent(spark, path, SALES, "date")
    assert again.current().count() == 6
    assert [r.snapshot_id for r in again.snapshots().collect()] == ids
    rows = again.as_of(ids[0]).collect()
    assert sorted(tuple(r) for r in rows) == KNOWN
    assert [(r.place, r.row_count) for r in again.row_counts().orderBy("place").collect()] == [
        (1, 3),
        (2, 6),
    ]
    with pytest.raises(ValueError):
        again.as_of(3)


def test_two_writers_keep_all_rows(spark):
    path = new_dir(spark, "sales")
    VersionedTable.create_if_absent(spark, path, SALES, "date")
    writers = [VersionedTable(spark, path), VersionedTable(spark, path)]
    known = spark.createDataFrame(KNOWN, SALES)
    more = spark.createDataFrame([(10 + i, "x", 1.0, date(2024, 1, 1)) for i in range(5)], SALES)
    with ThreadPoolExecutor(2) as pool:
        ids = list(pool.map(lambda w, rows: w.append(rows), writers, [known, more]))
    assert len(set(ids)) == 2
    assert writers[0].current().count() == 8


def test_unfinished_creation_is_repeated(spark, tmp_path):
    path = str(tmp_path / "sales")
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, path)
    (tmp_path / "sales" / "meta" / "_temporary").mkdir(parents=True)
    table = VersionedTable.create_if_absent(spark, path, SALES, "date")
    table.append(spark.createDataFrame(KNOWN, SALES))
    assert table.current().count() == 3


def test_unfinished_append_is_invisible(spark):
    path = new_dir(spark, "sales")
    table = VersionedTable.create_if_absent(spark, path, SALES, "date")
    known = spark.createDataFrame(KNOWN, SALES)
    table.append(known)
    known.drop("date").write.parquet(f"{path}/data/snapshot_id=2/date=2024-02-02")
    assert table.current().count() == 3
    table.append(known.limit(1))
    assert table.current().count() == 4


def test_time_travel_prunes_snapshots_and_days(spark):
    table = VersionedTable.create_if_absent(spark, new_dir(spark, "sales"), SALES, "date")
    known = spark.createDataFrame(KNOWN, SALES)
    first = table.append(known)
    table.append(known)
    day = table.as_of(first).where("date = DATE'2024-01-15'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"product#.*?PartitionFilters: \[(.*?), Pushed", plan).group(1)
    assert "= 2024-01-15" in filters
    assert all(f"snapshot_id={first}/" in file for file in day.inputFiles())
    assert day.count() == 1


def test_insert_if_absent(spark):
    schema = "product_id bigint, total_quantity_sold bigint, total_revenue double"
    target = spark.createDataFrame([(1, 10, 100.0)], schema)
    known = spark.createDataFrame([(999, 850, 1200000.0)], schema)
    once = insert_absent(target, known, ["product_id"], ["total_revenue"])
    twice = insert_absent(once, known, ["product_id"], ["total_revenue"])
    assert once.count() == twice.count() == 2
    changed = spark.createDataFrame([(1, 0, 0.0), (2, 5, 7.0), (2, 4, 6.0)], schema)
    result = insert_absent(target, changed, ["product_id"], ["total_revenue"])
    rows = sorted(tuple(r) for r in result.collect())
    assert rows == [(1, 10, 100.0), (2, 4, 6.0)]


def test_frequent_key_is_cut_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    rows = spark.range(9000).select(key.alias("k"), "id")
    target = spark.createDataFrame([(1, 1)], "k bigint, id bigint")
    absent = absent_rows(target, rows, ["k"], ["id"])
    plan = absent._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert absent.count() == 6001 - 1


def test_series_and_spine(spark):
    bounds = spark.sql("SELECT DATE'2024-02-27' AS a, DATE'2024-03-02' AS b")
    days = [r.day for r in series.date_series(bounds, "a", "b").collect()]
    assert days[0] == date(2024, 2, 27) and days[-1] == date(2024, 3, 2) and len(days) == 5
    assert series.date_series(bounds, "a", "b", "2 days").count() == 3
    assert [r.id for r in series.integer_series(spark, 3, 6).collect()] == [3, 4, 5, 6]
    daily = spark.createDataFrame(
        [(date(2024, 1, 1), Decimal("1.50"), 2), (date(2024, 1, 4), Decimal("2.50"), 1)],
        "day date, amount decimal(22,2), n bigint",
    )
    spine = series.daily_spine(daily, "day", ["amount", "n"])
    filled = [tuple(r) for r in spine.orderBy("day").collect()]
    assert [r[2] for r in filled] == [2, 0, 0, 1]
    assert filled[1] == (date(2024, 1, 2), Decimal("0.00"), 0)


def test_tables_and_sql(spark):
    df = spark.range(10)
    assert [r.id for r in sample_rows(df, ["id"]).collect()] == [0, 1, 2, 3, 4]
    counts = {r.table_name: r.row_count for r in row_counts({"a": df, "b": df.limit(3)}).collect()}
    assert counts == {"a": 10, "b": 3}
    query = "SELECT id FROM {t} WHERE id >= :low ORDER BY id"
    assert [r.id for r in run_sql(spark, query, {"low": 8}, t=df).collect()] == [8, 9]
    assert [r.id for r in run_sql(spark, query, {"low": 8}, False, t=df).collect()] == [8]
    text = "SELECT :v AS v"
    assert run_sql(spark, text, {"v": "'; DROP TABLE x"}).first().v == "'; DROP TABLE x"


def test_counted_write_and_saved_results(spark, tmp_path):
    target = str(tmp_path / "out")
    assert write_counted(spark.range(1234), lambda df: df.write.parquet(target)) == 1234
    results = spark.createDataFrame(
        [("a", 1.0, True), ("b", 3.009, True), ("c", None, False)],
        "question string, execution_time double, success boolean",
    )
    save_results(results, str(tmp_path / "suite"))
    stats = spark.read.json(str(tmp_path / "suite" / "statistics")).first()
    assert (stats.total_queries, stats.failed, stats.avg_execution_time) == (3, 1, 2.0)
    assert stats.max_execution_time == 3.01
    assert spark.read.json(str(tmp_path / "suite" / "results")).count() == 3


def test_two_sources_in_one_query(spark):
    lake = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, amount double")
    shop = spark.createDataFrame([(1, "north"), (2, "south")], "id int, region string")
    rows = query_sources(
        spark,
        "SELECT region, amount FROM {lake_sales} JOIN {shop_customer} USING (id)",
        {"lake": {"sales": lake}, "shop": {"customer": shop}},
    ).collect()
    assert sorted(tuple(r) for r in rows) == [("north", 10.0), ("south", 20.0)]


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "t", schema="public")
    assert plain["dbtable"] == "public.t" and "numPartitions" not in plain
    split = jdbc_options("jdbc:x", "t", "id", (0, 100), 4)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert new_dir(spark, "x") != new_dir(spark, "x")


def test_initial_partitions_follow_the_shuffle():
    assert initial_partitions(10 * 2**20) == 200
    assert initial_partitions(1000 * 2**30) == 4000
    assert initial_partitions(100 * 2**40) == 409_600
    assert initial_partitions(100 * 2**40, most=50_000) == 50_000


def test_dates_written_as_csv_come_back(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "t.csv").write_text("at\n2024-01-01T10:00:00\n")
    target = new_dir(spark, "bronze")
    bronze.ingest_csv(spark, str(tmp_path), target, {"t": ("t.csv", "at timestamp_ntz")})
    assert bronze.read_bronze(spark, target, "t").first()["at"] == datetime(2024, 1, 1, 10)
