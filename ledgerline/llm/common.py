"""What several text operators share: words, row hashes, written cuts."""

from __future__ import annotations

import sys
import time
import types
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import fresh_dir

#: A word, everywhere in this subpackage: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The same white space, character by character.
WHITE = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def boxed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one, ``row``: their names clash with none."""
    return F.struct(*(docs[c] for c in docs.columns)).alias("row")


#: Makes Spark delete an execution's shuffle files at its end, not when the driver
#: happens to collect the plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The folder of each table that :func:`cut` wrote and :func:`discard` did not delete.
_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: what follows rereads files that survive a lost
    executor, and nothing above runs twice.  The shuffle files of what is
    above go with that.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    with shuffles_deleted(spark):
        df.write.option("compression", codec).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables from :func:`cut` that nothing reads any more."""
    for table in tables:
        path = _written.pop(table, None)
        if path is not None:
            spark = table.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def any_row(df: DataFrame) -> bool:
    """Whether ``df`` has a row."""
    with shuffles_deleted(df.sparkSession):
        return bool(df.take(1))


def rekeyed(*columns: str | Column) -> Column:
    """A 64-bit join key over ``columns``, null-safe.

    Joining two frames on this key makes Spark exchange both sides even when
    one is already partitioned by the columns (an aggregate's result), and
    adaptive execution can split a hot key only between two exchanges.  Join
    on the columns as well: the key alone may collide.
    """
    return F.xxhash64(*columns)


def is_remainder(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id: false."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


#: After so many seconds without use a worker's object goes when another stage runs.
IDLE_S = 10.0


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """One object per Python worker process, made at its first use there.

    Tasks that follow one another in a worker share it: for caches and tables
    that depend on nothing but ``name``.  Workers outlive a query's stages, so
    what only earlier stages used is dropped, or the tables of all steps of a
    pipeline would add up in each worker.
    """
    state = sys.modules.setdefault("_per_worker", types.ModuleType("_per_worker"))
    held = state.__dict__.setdefault("held", {})   # name: (object, stage, time of its last use)
    task, now = TaskContext.get(), time.monotonic()
    stage = task.stageId() if task else None
    idle = [n for n, (_, last, at) in held.items()
            if n != name and last != stage and now - at > IDLE_S]
    for n in idle:
        del held[n]
    if idle:
        pa.default_memory_pool().release_unused()
    held[name] = (held[name][0] if name in held else make(), stage, now)
    return held[name][0]
