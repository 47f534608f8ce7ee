"""Idempotent, fingerprint-checked load of CSV files into a bronze layer.

Layout below the bronze folder::

    raw/load=<id>/group=<n>/table_key=<md5 of the name>/original_filename=<file>/
                                                      the parsed rows of one load
    files/                                            one row per loaded file and load
    loads/load=<id>/                                  every file that load found, with its status
    manifest/                                         JSON: header, file entries, documents

Rows are written first and the file entry last, and readers take the rows of a file's latest
entry only. So rows of a load that died, or that a later version of the file replaced, are
never seen, and the next run loads an unfinished file again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from fnmatch import translate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemart.session import path_exists
from lakemart.sources.tables import path_missing

DOCUMENT_FILES = 10_000
# Two primes below 2^31: products of a line hash and a line number stay below 2^62.
PRIMES = (2_147_483_647, 2_147_483_629)
BAD_LINE = "_bad_line"
DATASET, HEADER = "dataset:", "header:"

# Descriptive metadata every file entry carries unless the caller overrides it.
METADATA = {
    "dataset": "hft_trading_data",
    "layer": "bronze",
    "format": "csv",
    "source": "local_upload",
}

# Fixed value: the bucket named in the manifest.
BUCKET = "lakehouse-bronze"

FILES_SCHEMA = (
    "object_name string, original_filename string, table_name string, size_bytes bigint, "
    "last_modified timestamp, md5hash string, status string, upload_timestamp timestamp, "
    "metadata map<string,string>, load string"
)


class IngestError(RuntimeError):
    """The raw folder is missing or empty, or nothing is loaded."""


def plain_name(encoded: str = "_metadata.file_name") -> Column:
    """A file's name as it was written; file metadata hold it URL-encoded, but for plus signs."""
    return F.regexp_extract(_decoded(encoded), "([^/]*)$", 1)


def _file_path(path: str = "_metadata.file_path") -> Column:
    """A path with one slash after its scheme, as the listing and the scan write it unlike."""
    return F.regexp_replace(path, "^([^:/]+):/+", "$1:/").alias("file_path")


def _decoded(encoded: str) -> Column:
    return F.url_decode(F.replace(F.col(encoded), F.lit("+"), F.lit("%2B")))


def _listed(spark: SparkSession, folder: str | list[str], pattern: str) -> DataFrame:
    """Every file directly in the folder, without its bytes.

    A scan gives no row for a file without bytes; the list of files, which the driver holds for
    any scan, adds it.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    facts = files.select(
        _file_path(),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
    )
    every = spark.createDataFrame([(path,) for path in files.inputFiles()], "path string")
    return every.select(_file_path("path")).join(facts, "file_path", "left").select(
        plain_name("file_path").alias("original_filename"),
        "file_path",
        _decoded("file_path").alias("path"),
        F.coalesce("size_bytes", F.lit(0).cast("bigint")).alias("size_bytes"),
        "last_modified",
    )


def line_hashes(line: Column) -> list[Column]:
    """Two hashes of a line below 2^28, from its MD5."""
    digest = F.md5(F.encode(line, "UTF-8"))
    return [F.conv(F.substring(digest, at, 7), 16, 10).cast("bigint") for at in (1, 8)]


def content_hashes(
    spark: SparkSession, folder: str | list[str], pattern: str = "*.csv"
) -> DataFrame:
    """``original_filename, path, size_bytes, last_modified, md5hash, header`` of each file.

    The fingerprint is the MD5 of the file's size, its number of lines and, for each of two
    primes, the sums of its line hashes and of line hash times line number. It is one for files
    of any size and however they are split, and sees lines that change places. Every split
    sums up its lines; sums over the splits of a file turn row ids into line numbers. A file
    without bytes has no lines and stays. ``header`` is the first line.
    """
    files = _listed(spark, folder, pattern)
    lines = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(folder)
    rows = lines.select(
        _file_path(),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
        *(h.alias(f"h{i}") for i, h in enumerate(line_hashes(F.col("value")))),
    )
    sums = [F.count("*").alias("n"), F.min("id").alias("first_id")]
    sums.append(F.min_by("value", "id").alias("first_line"))
    for i, prime in enumerate(PRIMES):
        h, number = F.col(f"h{i}"), F.col("id") % prime
        sums.append(F.sum(h).alias(f"s{i}"))
        sums.append(F.sum(h * number % prime).alias(f"w{i}"))
    blocks = rows.groupBy("file_path", "block").agg(*sums)
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # line number = row id + lines of earlier blocks - first row id of the block
    placed = blocks.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)))
    facts = [F.sum("n").alias("n"), F.min_by("first_line", "block").alias("header")]
    for i, prime in enumerate(PRIMES):
        shift = F.pmod(F.col("shift") - F.col("first_id"), F.lit(prime))
        moved = (F.col(f"w{i}") + F.pmod(F.col(f"s{i}"), F.lit(prime)) * shift % prime) % prime
        facts += [F.sum(f"s{i}").alias(f"s{i}"), (F.sum(moved) % prime).alias(f"w{i}")]
    merged = placed.groupBy("file_path").agg(*facts)
    found = files.join(merged, "file_path", "left")
    parts = ["size_bytes", "n", *(f"{x}{i}" for i in range(len(PRIMES)) for x in "sw")]
    written = [F.coalesce(F.col(p), F.lit(0)).cast("string") for p in parts]
    return found.select(
        "original_filename",
        "path",
        "size_bytes",
        "last_modified",
        F.md5(F.concat_ws(":", *written)).alias("md5hash"),
        "header",
    )


def hashes_since(
    spark: SparkSession, folder: str, loaded: DataFrame, pattern: str = "*.csv"
) -> DataFrame:
    """The same listing, reading only files whose size or time differs from the loaded entry.

    For folders too large to read again on every load. A file changed without a change
    of either is not noticed. The driver gets the paths of the files to read, as it does for
    any scan.
    """
    listing = _listed(spark, folder, pattern)
    stat = ["original_filename", "size_bytes", "last_modified"]
    known = loaded.select(*stat, "md5hash")
    touched = [row.path for row in listing.join(known, stat, "left_anti").select("path").collect()]
    same = listing.join(known, stat).select(
        *stat, "path", "md5hash", F.lit(None).cast("string").alias("header")
    )
    return same.unionByName(content_hashes(spark, touched, pattern)) if touched else same


def loaded_files(spark: SparkSession, bronze: str, load: str | None = None) -> DataFrame:
    """The current entry of each loaded file (the latest one of its name), or those of a load."""
    try:
        entries = spark.read.schema(FILES_SCHEMA).parquet(f"{bronze}/files")
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], FILES_SCHEMA)
    columns = entries.columns
    if load is not None:
        entries = entries.where(F.col("load") == load)
    return (
        entries.groupBy("original_filename")
        .agg(F.max_by(F.struct(*columns), "upload_timestamp").alias("entry"))
        .select("entry.*")
    )


def compare_files(listing: DataFrame, loaded: DataFrame) -> DataFrame:
    """The listing with a ``status``: ``skip`` (same hash), ``changed`` or ``new``."""
    known = loaded.select("original_filename", F.col("md5hash").alias("loaded_hash"))
    status = (
        F.when(F.col("loaded_hash") == F.col("md5hash"), F.lit("skip"))
        .when(F.col("loaded_hash").isNotNull(), F.lit("changed"))
        .otherwise(F.lit("new"))
    )
    return (
        listing.join(known, "original_filename", "left")
        .withColumn("status", status)
        .drop("loaded_hash")
    )


def _table_name(datasets: Mapping[str, tuple[str, StructType | str]]) -> Column:
    """The table a file belongs to: the first matching pattern, else the file's own stem."""
    name = F.col("original_filename")
    table = F.regexp_replace(name, r"\.[^.]*$", "")
    for dataset, (pattern, _) in reversed(datasets.items()):
        table = F.when(name.rlike(translate(pattern)), F.lit(dataset)).otherwise(table)
    return table


def _header_fits(schema: StructType) -> Column:
    """Is the first line the list of the schema's columns? A file without lines fits."""
    names = ",".join(field.name for field in schema).lower()
    written = F.lower(F.regexp_replace("header", "[\"\\s\ufeff]", ""))
    return F.coalesce(written == F.regexp_replace(F.lit(names), "\\s", ""), F.lit(True))


def _with_status(batch: DataFrame, failed: DataFrame) -> DataFrame:
    bad = failed.select("original_filename", F.lit(True).alias("bad"))
    status = F.when(F.col("bad"), F.lit("failed")).otherwise(F.col("status"))
    return batch.join(bad, "original_filename", "left").withColumn("status", status).drop("bad")


def ingest_csv(
    spark: SparkSession,
    data_dir: str,
    bronze: str,
    datasets: Mapping[str, tuple[str, StructType | str]] | None = None,
    metadata: Mapping[str, str] | None = None,
    csv_options: Mapping[str, str] | None = None,
    hash_all: bool = True,
    load: str | None = None,
    record_skipped: bool = True,
) -> DataFrame:
    """Load the new and changed ``raw/*.csv`` files of ``data_dir``; returns the batch.

    ``datasets`` maps a table name to a file pattern and a schema and is read in one job; a
    file no pattern matches becomes a table of its own with string columns named by its
    header, and files of one header are read in one job, whatever their tables. The batch has
    one row per file found, with its status: ``new``, ``changed``, ``skip``, or ``failed`` for
    a file with a line or a header that doesn't fit its schema. Failed files are not recorded and tried again by the next load; the others are loaded.
    Loaded files are readable with :func:`read_bronze`. Without ``hash_all`` files are read only
    if their size or time changed since they were loaded.

    ``load`` names the load, else it gets a random name. A named load that is repeated goes on
    where it ended: its comparison stands as it was first written, rows of an attempt that died
    are written again, and what is recorded already is not recorded twice. Without
    ``record_skipped`` unchanged files are left out of the batch, which may then be empty.
    """
    datasets = datasets or {}
    raw = f"{data_dir.rstrip('/')}/raw"
    load = load or f"load-{uuid.uuid4().hex}"
    loaded = loaded_files(spark, bronze)
    # The files may change while they load: the comparison is settled in a written table, which
    # stays as the record of the load.
    settled = f"{bronze}/loads/load={load}"
    if not path_exists(spark, f"{settled}/_SUCCESS"):
        entries = _compared(spark, raw, load, loaded, datasets, metadata, hash_all)
        entries = entries if record_skipped else entries.where("status <> 'skip'")
        entries.drop("load").write.mode("overwrite").parquet(settled)
    batch = spark.read.parquet(settled).withColumn("load", F.lit(load))
    if record_skipped and batch.isEmpty():
        raise IngestError(f"no CSV files in {raw}")

    schemas = {name: _schema(schema) for name, (_, schema) in datasets.items()}
    first_load = loaded.isEmpty()
    to_load = batch.where("status IN ('new', 'changed')")
    filled = to_load.where("size_bytes > 0").withColumn("form", _form(datasets))
    forms = sorted(row.form for row in filled.select("form").distinct().collect())
    folders = [f"{bronze}/raw/load={load}/group={n}" for n in range(len(forms))]
    # entries follow the rows of all files: with one of them there, no row is missing
    recorded = loaded_files(spark, bronze, load).select("original_filename")
    if recorded.isEmpty():
        for form, folder in zip(forms, folders):
            own = filled.where(F.col("form") == form)
            dataset = form.removeprefix(DATASET) if form.startswith(DATASET) else None
            if first_load and dataset:  # the pattern names the files
                glob, source = datasets[dataset][0], raw
            else:
                glob, source = "*", [row.path for row in own.select("path").collect()]
            reader = spark.read.option("header", True).option("pathGlobFilter", glob)
            reader = reader.options(**(csv_options or {}))
            schema = schemas[dataset] if dataset else reader.csv(source).schema
            _write_rows(reader, source, schema, own, folder)
    for folder in folders:
        batch = _with_status(batch, _bad_files(spark, folder))
    done = batch.where("status IN ('new', 'changed')").drop("path", "header")
    done = done.join(recorded, "original_filename", "left_anti")
    if not done.isEmpty():
        done.write.mode("append").parquet(f"{bronze}/files")
    return batch.drop("path", "header", "load")


def _form(datasets: Mapping[str, tuple[str, StructType | str]]) -> Column:
    """What one job can read together: the files of a dataset, or all files of one header."""
    name = F.col("table_name")
    known = name.isin(list(datasets)) if datasets else F.lit(False)
    header = F.concat(F.lit(HEADER), F.coalesce("header", F.lit("")))
    return F.when(known, F.concat(F.lit(DATASET), name)).otherwise(header)


def _write_rows(
    reader: DataFrameReader, source: str | list[str], schema: StructType, own: DataFrame, folder: str
) -> None:
    """Parse the files of ``own``, of any number of tables with one schema, in one job."""
    parsed = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    rows = reader.schema(parsed).csv(source)
    traced = rows.select(
        *rows.columns,
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.current_timestamp().alias("upload_timestamp"),
        plain_name().alias("original_filename"),
    )
    wanted = own.select("original_filename", F.md5("table_name").alias("table_key"))
    traced.join(wanted, "original_filename").write.mode("overwrite").partitionBy(
        "table_key", "original_filename"
    ).parquet(folder)


def _compared(
    spark: SparkSession,
    raw: str,
    load: str,
    loaded: DataFrame,
    datasets: Mapping[str, tuple[str, StructType | str]],
    metadata: Mapping[str, str] | None,
    hash_all: bool,
) -> DataFrame:
    """Entries of every file of the raw folder, with their status against what is loaded."""
    try:
        whole = hash_all or loaded.isEmpty()
        listing = content_hashes(spark, raw) if whole else hashes_since(spark, raw, loaded)
    except AnalysisException as error:
        if path_missing(error):
            raise IngestError(f"no folder {raw}") from error
        raise

    facts = {
        "md5hash": F.col("md5hash"),
        "upload_timestamp": F.current_timestamp().cast("string"),
        "original_filename": F.col("original_filename"),
        "file_size_bytes": F.col("size_bytes").cast("string"),
    }
    given = {key: F.lit(value) for key, value in {**METADATA, **(metadata or {})}.items()}
    described: list[Column] = []
    for key, value in {**facts, **given}.items():
        described += [F.lit(key), value]
    schemas = {name: _schema(schema) for name, (_, schema) in datasets.items()}
    fits = F.lit(True)
    for name, schema in schemas.items():
        fits = F.when(F.col("table_name") == name, _header_fits(schema)).otherwise(fits)
    return (
        compare_files(listing, loaded)
        .withColumn("table_name", _table_name(datasets))
        .withColumn("fits", fits | (F.col("status") == "skip"))
        .select(
            F.concat(F.lit("raw/"), "original_filename").alias("object_name"),
            "original_filename",
            "table_name",
            "size_bytes",
            "last_modified",
            "md5hash",
            F.when(F.col("fits"), F.col("status")).otherwise(F.lit("failed")).alias("status"),
            F.current_timestamp().alias("upload_timestamp"),
            F.create_map(*described).alias("metadata"),
            F.lit(load).alias("load"),
            "path",
            "header",
        )
    )


def _schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _bad_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a load with a line that its schema could not take."""
    try:
        rows = spark.read.parquet(folder)
    except AnalysisException:  # no file had a row
        return spark.createDataFrame([], "original_filename string")
    name = F.col("original_filename").cast("string").alias("original_filename")
    return rows.where(F.col(BAD_LINE).isNotNull()).select(name).distinct()


def read_bronze(spark: SparkSession, bronze: str, table: str) -> DataFrame:
    """Rows of the current version of each loaded file of a table."""
    key = hashlib.md5(table.encode()).hexdigest()
    rows = spark.read.option("mergeSchema", True).option("basePath", f"{bronze}/raw")
    rows = rows.parquet(f"{bronze}/raw/load=*/group=*/table_key={key}")
    rows = rows.withColumn("original_filename", F.col("original_filename").cast("string"))
    current = loaded_files(spark, bronze).where(F.col("table_name") == table)
    current = current.select("original_filename", "load")
    columns = [c for c in rows.columns if c not in (BAD_LINE, "load", "group", "table_key")]
    return rows.join(current, ["original_filename", "load"], "left_semi").select(*columns)


def save_manifest(
    spark: SparkSession, bronze: str, bucket: str = BUCKET, document_files: int = DOCUMENT_FILES
) -> None:
    """Write the manifest as JSON: a one-row header, one row per file, and nested documents.

    A document is a single row, so the files are split by a hash of their name into as many
    documents of about ``document_files`` as it takes; each says which part it is.
    """
    files = loaded_files(spark, bronze).select(
        "object_name", "size_bytes", "last_modified", "md5hash", "upload_timestamp"
    )
    header = files.agg(F.count("*").alias("file_count")).select(
        F.current_timestamp().alias("upload_timestamp"),
        F.lit("completed").alias("status"),
        F.lit(bucket).alias("bronze_bucket"),
        "file_count",
    )
    header.write.mode("overwrite").json(f"{bronze}/manifest/header")
    files.write.mode("overwrite").json(f"{bronze}/manifest/files")
    count = spark.read.schema("file_count bigint").json(f"{bronze}/manifest/header").first()[0]
    parts = max(1, -(-count // document_files))
    part = F.pmod(F.xxhash64("object_name"), F.lit(parts)).alias("part")
    documents = files.groupBy(part).agg(
        F.array_sort(F.collect_list(F.struct(*files.columns))).alias("files")
    )
    documents.select(
        F.current_timestamp().alias("upload_timestamp"),
        F.lit("completed").alias("status"),
        F.lit(bucket).alias("bronze_bucket"),
        "part",
        F.lit(parts).alias("parts"),
        "files",
    ).write.mode("overwrite").json(f"{bronze}/manifest/document")


def verify_load(spark: SparkSession, bronze: str) -> DataFrame:
    """``file_count, size_mb`` of what is loaded; fails if nothing is."""
    checked = loaded_files(spark, bronze).agg(
        F.count("*").alias("file_count"),
        (F.sum("size_bytes") / F.lit(1024 * 1024)).alias("size_mb"),
    )
    if checked.first().file_count == 0:
        raise IngestError(f"no files in {bronze}")
    return checked
