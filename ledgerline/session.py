"""Session construction and the shared working folder.

Cluster sessions come with their own settings: :func:`build_session` only
fills in what is missing, so a ``spark-submit --conf`` wins, except for the
few settings that the results depend on (:data:`FORCED`).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

T = TypeVar("T")

# Settings the jobs rely on.  AQE re-plans joins at run time (broadcast when a
# side is measured small, split skewed partitions), coalesces small shuffle
# partitions, and the session time zone is pinned so dates never shift.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Overflow must raise, and dates must not shift, whatever was submitted.
FORCED = ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")


def build_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with :data:`DEFAULT_CONF` applied where unset.

    ``extra`` and :data:`FORCED` apply in any case.  ``shuffle_partitions``
    should follow the data: about one partition per 128 MB of shuffled data
    on a cluster (AQE coalesces the excess); the number of local cores in
    tests.
    """
    SparkContext._ensure_initialized()   # so that SparkConf sees submitted settings
    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {k: v for k, v in DEFAULT_CONF.items() if k in FORCED or not submitted.contains(k)}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Path under the cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster this setting names storage every executor can reach, so
    written tables and checkpoints survive the loss of an executor.  Only
    when it is unset on a ``local`` master (local runs, tests) is a private
    folder created and registered as the checkpoint dir; a cluster session
    without it is an error, since a machine-local folder would not survive
    the loss of the machine (nor be visible to the other executors).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can "
                "reach (a distributed file system or object store)")
        root = tempfile.mkdtemp(prefix="ledgerline-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, *parts) if parts else root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under :func:`shared_dir`, among this application's."""
    return shared_dir(spark, "runs", spark.sparkContext.applicationId,
                      f"{label}-{uuid.uuid4().hex[:12]}")


def end_runs(spark: SparkSession) -> None:
    """Delete what this application wrote under :func:`fresh_dir`.

    For the end of an application: tables that were read from there are gone.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(
        shared_dir(spark, "runs", spark.sparkContext.applicationId))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total bytes stored under ``paths`` (one summary call per path)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def input_stamp(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(files, bytes, newest change) under ``path``: differs once the input does."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, size, newest = 0, 0, 0
    found = fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        files, size = files + 1, size + f.getLen()
        newest = max(newest, f.getModificationTime())
    return files, size, newest


def size_shuffle_partitions(spark: SparkSession, stored_bytes: int,
                            bytes_per_partition: int = 64 * 1024 * 1024) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the size of the input.

    About one partition per ``bytes_per_partition`` of stored (compressed)
    input, and never fewer than twice the cores.  AQE then coalesces partitions that turn out small and splits skewed ones,
    so the number only has to be large enough that no partition spills.
    """
    floor = 2 * spark.sparkContext.defaultParallelism
    n = max(floor, -(-stored_bytes // bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def run_concurrently(tasks: Mapping[str, Callable[[], T]],
                     max_workers: int = 4) -> dict[str, T | BaseException]:
    """Run independent Spark actions from a few driver threads at once.

    Each task is an action writing to its own target (one report, one table
    version).  Submitted together, their stages share the executors: one
    job's short final stage no longer leaves the cluster idle while the
    next job waits to start.  Returns each task's result, or the exception
    it raised, by name; the caller decides what a failure means.
    """
    out: dict[str, T | BaseException] = {}
    if not tasks:
        return out
    with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(tasks)))) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        for name, fut in futures.items():
            try:
                out[name] = fut.result()
            except Exception as exc:  # noqa: BLE001 - returned to the caller
                out[name] = exc
    return out
