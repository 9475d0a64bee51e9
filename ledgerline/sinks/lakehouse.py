"""Published tables: ordinary Parquet tables, partitioned by version (K6-K9, M1-M4).

Publishing adds a table's rows as the next ``snapshot_id`` and the time, two
partition columns; earlier versions stay.  Spark writes them aside, they are
counted again, and one move of the folder makes them a partition of the table.
What is known of versions - which there are, their rows, their times, the
newest before a moment - are listings of partitions and aggregates over the
table.

The tables are in the session catalogue, in a database of their own; where the
catalogue lives as long as a session, the next one registers them from their
folders.  One writer for each table at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import run_concurrently
from ledgerline.sinks.files import child_names, remove_path, replace_path, write_parquet

VERSION, TIME = "snapshot_id", "published_ms"
HISTORY = ("table_name string, snapshot_id bigint, parent_id bigint, committed_at timestamp, "
           "operation string, added_records bigint, total_records bigint")
TABLES = ("namespace string, table_name string, snapshot_id bigint, total_records bigint, "
          "column_count int")


def _millis(t: dt.datetime) -> int:
    """Epoch milliseconds of ``t`` (naive values are taken as UTC)."""
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp() * 1000)


class PublishMismatch(RuntimeError):
    """The re-read row count differs from the rows written."""


class PublishedTables:
    """K7: a namespace of versioned tables under ``root``, created if absent."""

    def __init__(self, spark: SparkSession, root: str, namespace: str = "default",
                 database: str | None = None):
        self.spark, self.root, self.namespace = spark, root, namespace
        self.database = database or f"{namespace}_published"
        # A folder of its own, since dropping a database deletes its folder.
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
                  f"LOCATION '{os.path.join(root, namespace, '_database')}'")

    def name(self, table: str) -> str:
        """The table's name in SQL; it holds every version."""
        return f"`{self.database}`.`{table}`"

    def path(self, table: str) -> str:
        return os.path.join(self.root, self.namespace, table)

    # -- registration --------------------------------------------------------------
    def _location(self, table: str) -> str | None:
        if not self.spark.catalog.tableExists(self.name(table)):
            return None
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}")
        return about.where("col_name = 'Location'").first()["data_type"]

    def registered(self, table: str) -> bool:
        """Whether the table is there; it is registered from its folder if need be."""
        plain = self.path(table).removeprefix("file:").lstrip("/")
        where = self._location(table)
        if where is not None:
            if where.removeprefix("file:").lstrip("/") == plain:
                return True
            self.spark.sql(f"DROP TABLE {self.name(table)}")   # another root's; its files stay
        if not any(n.startswith(f"{VERSION}=") for n in child_names(self.spark, self.path(table))):
            return False
        found = self.spark.read.parquet(self.path(table))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema
                            if f.name not in (VERSION, TIME))
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}, {VERSION} BIGINT, "
                       f"{TIME} BIGINT) USING parquet PARTITIONED BY ({VERSION}, {TIME}) "
                       f"LOCATION '{self.path(table)}'")
        self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
        return True

    def table_names(self) -> list[str]:
        """Tables of the namespace, from its folders."""
        folder = os.path.join(self.root, self.namespace)
        return sorted(n for n in child_names(self.spark, folder)
                      if not n.startswith((".", "_")) and self.registered(n))

    def versions(self, table: str) -> list[tuple[int, int]]:
        """(version, time) of every version, oldest first: the table's partitions."""
        if not self.registered(table):
            return []
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        return sorted(tuple(int(p.split("=")[1]) for p in r[0].split("/")) for r in rows)

    # -- write (K6-K9) ----------------------------------------------------------------
    def _write(self, table: str, df: DataFrame) -> dict:
        """Write the next version, verify it and move it in; returns what was done."""
        clash = {VERSION, TIME} & {c.lower() for c in df.columns}
        if clash:
            raise ValueError(f"{table}: columns named as the versions': {sorted(clash)}")
        before = self.versions(table)
        version, now = (before[-1][0] if before else 0) + 1, int(time.time() * 1000)
        if before:
            known = [d for d in self.spark.table(self.name(table)).dtypes
                     if d[0] not in (VERSION, TIME)]
            if known != df.dtypes:
                raise ValueError(f"{table}: columns {df.dtypes} differ from the versions "
                                 f"before, {known}")
        aside = os.path.join(self.root, self.namespace, "_incoming", uuid.uuid4().hex)
        written = write_parquet(df, aside)
        verified = self.spark.read.schema(df.schema).parquet(aside).count()
        if verified != written:
            remove_path(self.spark, aside)
            raise PublishMismatch(f"{table}: wrote {written} rows, read back {verified}")
        # One move makes the whole version visible.
        place = f"{VERSION}={version}/{TIME}={now}"
        replace_path(self.spark, aside, os.path.join(self.path(table), place))
        if before:
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS "
                           f"PARTITION ({place.replace('/', ', ')})")
        else:
            self.registered(table)
        return {"table_name": table, VERSION: version, "written_rows": written,
                "verified_rows": verified,
                "committed_at": dt.datetime.fromtimestamp(now / 1000, dt.timezone.utc)}

    def _rows(self, table: str, version: int) -> DataFrame:
        return self.spark.table(self.name(table)).where(F.col(VERSION) == version)

    def publish(self, table: str, df: DataFrame) -> dict:
        """K6 + K8: ``df`` as the next version of ``table``, counted again.

        A version replaces the content as a whole (operation ``overwrite``);
        earlier ones stay readable.  Raises :class:`PublishMismatch` if the
        re-read count differs; nothing has changed then.
        """
        return self._write(table, df)

    def publish_all(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """K9: publish several tables; one report row per table.

        The writes go to different folders and are submitted together.  A table
        that fails is reported with status ``failed`` and the others still run;
        :func:`raise_on_failure` turns the report into an error.
        """
        results = run_concurrently({name: (lambda name=name, df=df: self.publish(name, df))
                                    for name, df in tables.items()})
        rows = [(name, None, None, None, f"failed: {type(done).__name__}")
                if isinstance(done, BaseException) else
                (name, done[VERSION], done["written_rows"], done["verified_rows"], "ok")
                for name, done in results.items()]
        return self.spark.createDataFrame(
            rows, "table_name string, snapshot_id bigint, written_rows bigint, "
                  "verified_rows bigint, status string")

    # -- read (S11, M4) -----------------------------------------------------------------
    def resolve(self, table: str, snapshot_id: int | None = None,
                as_of: dt.datetime | None = None) -> int:
        """The version to read: a given one, the newest at ``as_of``, or the newest."""
        found = [v for v, at in self.versions(table)
                 if (snapshot_id is None or v == snapshot_id)
                 and (as_of is None or at <= _millis(as_of))]
        if not found:
            raise LookupError(f"no snapshot of {self.namespace}.{table} matches")
        return max(found)

    def read(self, table: str, snapshot_id: int | None = None,
             as_of: dt.datetime | None = None) -> DataFrame:
        """S11 + M4: one version of ``table`` (default: the newest); the others'
        folders are skipped."""
        version = self.resolve(table, snapshot_id, as_of)
        return self._rows(table, version).drop(VERSION, TIME)

    # -- metadata (M1-M3, Q10) -------------------------------------------------------------
    def _counts(self, table: str) -> DataFrame:
        """Rows of every version; versions without any count 0."""
        versions = self.spark.createDataFrame(self.versions(table), "v bigint, at bigint")
        counted = self.spark.table(self.name(table)).groupBy(VERSION).agg(
            F.count(F.lit(1)).alias("n"))
        return versions.join(counted, F.col("v") == F.col(VERSION), "left").select(
            F.lit(table).alias("table_name"), F.col("v").alias(VERSION), F.col("at").alias(TIME),
            F.coalesce("n", F.lit(0).cast("bigint")).alias("total_records"))

    def _union(self, parts: list[DataFrame], schema: str) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts) if parts else empty

    def tables(self) -> DataFrame:
        """M1: every table with its newest version, its rows and columns."""
        return self._union([
            self._counts(t).where(F.col(VERSION) == self.resolve(t)).select(
                F.lit(self.namespace).alias("namespace"), "table_name", VERSION, "total_records",
                F.lit(len(self.spark.table(self.name(t)).columns) - 2).alias("column_count"))
            for t in self.table_names()], TABLES)

    def exists(self, table: str) -> bool:
        """Q10: whether ``table`` has a version."""
        return bool(self.versions(table))

    def history(self, table: str | None = None) -> DataFrame:
        """M3: the versions of one table (or all), oldest first, with their rows."""
        names = self.table_names() if table is None else [table] if self.exists(table) else []
        return self._union([self._counts(t).select(
            "table_name", VERSION,
            F.when(F.col(VERSION) > 1, F.col(VERSION) - 1).alias("parent_id"),
            F.timestamp_millis(TIME).alias("committed_at"),
            F.lit("overwrite").alias("operation"),
            F.col("total_records").alias("added_records"), "total_records")
            for t in names], HISTORY).orderBy("table_name", VERSION)

    def schema(self, table: str, snapshot_id: int | None = None) -> DataFrame:
        """M2: (position, name, type, nullable) of a version's columns, with the
        number of rows that have no value there, counted in one pass."""
        rows = self.read(table, snapshot_id)
        counts = rows.agg(*(F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{i}")
                            for i, f in enumerate(rows.schema)))
        return counts.select(F.inline(F.array(*(F.struct(
            F.lit(table).alias("table_name"), F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"), F.col(f"n{i}").alias("null_rows"))
            for i, f in enumerate(rows.schema)))))


def raise_on_failure(report: DataFrame) -> None:
    """Raise when a publish report has a failed table (non-zero exit)."""
    bad = report.where(F.col("status") != "ok").select("table_name", "status").collect()
    if bad:
        raise RuntimeError("publish failed: " + ", ".join(f"{r[0]} ({r[1]})" for r in bad))
