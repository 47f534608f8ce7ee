"""Session set-up and the shared working folder."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PARTITION_BYTES = 256 * 1024 * 1024

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def initial_partitions(shuffle_bytes: int, most: int | None = None) -> int:
    """Partitions for a shuffle of the given size, so that each fits a task without spilling.

    ``most`` bounds them where the bookkeeping of the shuffle costs more than larger partitions
    do; those still sort and aggregate by spilling to disk.
    """
    wanted = max(200, -(-shuffle_bytes // PARTITION_BYTES))
    return wanted if most is None else min(most, wanted)


def get_spark(
    app_name: str = "lakemart",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    most_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators are planned for.

    Adaptive execution merges small shuffle partitions and splits skewed ones, but never
    starts with more than the initial number. ``shuffle_bytes``, the size of the largest
    shuffle to expect, raises it for large data: about a third of the fact columns read.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    if shuffle_bytes is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(initial_partitions(shuffle_bytes, most_partitions)),
        )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root folder for tables written between two jobs.

    It is the folder the cluster names in ``spark.checkpoint.dir``: visible to every
    executor and still there when one is lost. Only a local session without the
    setting, as in tests, gets a temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="lakemart-")
    return _LOCAL_DIRS[app]


def new_dir(spark: SparkSession, label: str) -> str:
    """A folder of its own for one run below :func:`shared_dir` (not created yet)."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started.

    A zip of the package goes to the shared folder once per application, and from there to
    every executor, also to one that joins later.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.writestr(str(file.relative_to(package.parent)), file.read_bytes())
    data = held.getvalue()
    name = f"{package.name}-{hashlib.sha256(data).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}.zip"
    path = os.path.join(shared_dir(spark), name)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(data)
    out.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def move_files(spark: SparkSession, source: str, target: str, prefix: str, suffix: str) -> None:
    """Rename what one write left in ``source`` to ``<target>/<prefix>-<number><suffix>``.

    Files of these names are replaced.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target))
    names = [f.getPath().getName() for f in system.listStatus(path(source))]
    for number, name in enumerate(sorted(n for n in names if n.endswith(suffix))):
        place = path(f"{target}/{prefix}-{number}{suffix}")
        system.delete(place, False)
        system.rename(path(f"{source}/{name}"), place)
    system.delete(path(source), True)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that this job wrote, on whatever file system it is."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
