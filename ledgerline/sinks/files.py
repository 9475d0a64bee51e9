"""File sinks: idempotent Parquet (K1, K2, K4, K5) and CSV writes.

``mode("overwrite")`` replaces the target on every run, so re-running a job
gives the same files.  Spark's commit protocol publishes task output only on
job commit; a retried task (lost executor) never leaves duplicate rows.  An
empty DataFrame still writes a readable file carrying its schema.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, compression: str = "snappy",
                  partition_by: list[str] | None = None) -> int:
    """Write ``df`` as Parquet, replacing ``path``; returns the rows written.

    The row count is observed during the write itself (no second pass).
    """
    obs = Observation(f"write_{uuid.uuid4().hex}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    # The whole target, whatever the session says of partitions.
    writer = writer.option("partitionOverwriteMode", "static").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get.get("rows", 0))


def write_csv(df: DataFrame, path: str, header: bool = True) -> int:
    """Write ``df`` as CSV with a header row, replacing ``path``."""
    obs = Observation(f"csv_{uuid.uuid4().hex}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite").option("header", str(header).lower()).csv(path))
    return int(obs.get.get("rows", 0))


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in folder ``path``; none where there is no such folder."""
    p, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written by the driver: no job for a few hundred bytes."""
    p, fs = _file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small text file."""
    p, fs = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is below it, if it is there."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Move ``new`` to ``path``.

    What was there is moved aside first and back if the move fails.  A driver
    lost between the two moves leaves nothing at ``path`` and the old file
    under ``<path>.old``, which the next call, or :func:`restore_path`, moves
    back before anything else.
    """
    restore_path(spark, path)
    source, fs = _file_system(spark, new)
    target, _ = _file_system(spark, path)
    old, _ = _file_system(spark, f"{path}.old")
    fs.mkdirs(target.getParent())
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(old, True)


def restore_path(spark: SparkSession, path: str) -> bool:
    """Put back what an interrupted :func:`replace_path` left aside; whether it did.

    Where ``path`` is there, the replacement was complete but for the removal
    of the old file, which is made up for.
    """
    target, fs = _file_system(spark, path)
    old, _ = _file_system(spark, f"{path}.old")
    if not fs.exists(old):
        return False
    if fs.exists(target):
        fs.delete(old, True)
        return False
    if not fs.rename(old, target):
        raise OSError(f"cannot move {path}.old back")
    return True
