"""Built tables and views by name in Spark's session catalogue.

A table is written as a new external table, ``<name>__<time>``, and the view
``<name>`` is then replaced to select from it.  Readers ask for ``<name>``:
they see the old table or the new one, never a part of either, and a build
that fails leaves the view as it was.  The table before the current one stays
for those that still read it; older ones are dropped with their files.

Where the catalogue lives as long as a session (Spark's default), another
session finds the tables again with :meth:`Catalogue.attach`: each carries its
own definition, as Spark prints it, beside its files.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.sinks.files import child_names, read_text, remove_path, write_text

KEPT = 2   # tables of a name that stay: the current one and the one before


@dataclass(frozen=True)
class Layout:
    """How a table's files are arranged.

    ``buckets`` > 0 clusters the rows by hash of ``cluster_by``, one file for
    each bucket (and partition), so that aggregates and joins on these keys
    need no exchange.  ``partition_by`` columns become folders that filters
    skip; ``sort_by`` orders the rows of a file, which narrows the value
    ranges of its row groups.
    """

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    buckets: int = 0
    sort_by: tuple[str, ...] = ()


PLAIN = Layout()


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


class Catalogue:
    """The tables and views of one database, their files under ``root``."""

    def __init__(self, spark: SparkSession, root: str, database: str = "default"):
        self.spark, self.root, self.database = spark, root, database
        # A folder of its own, since dropping a database deletes its folder.
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} "
                  f"LOCATION '{self._folder('_database')}'")

    def _folder(self, *parts: str) -> str:
        return os.path.join(self.root, self.database, *parts)

    def name(self, table: str) -> str:
        """The table's name in SQL."""
        return _quoted(self.database, table)

    def table(self, name: str) -> DataFrame:
        """A built table or view by its name."""
        return self.spark.table(self.name(name))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.name(name))

    def tables(self) -> list[str]:
        """The names that readers ask for, without the tables behind them."""
        found = self.spark.catalog.listTables(self.database)
        return sorted(t.name for t in found if not t.isTemporary and "__" not in t.name)

    def _builds(self, name: str) -> list[str]:
        """The tables behind ``name``, oldest first."""
        found = self.spark.catalog.listTables(self.database)
        return sorted(t.name for t in found if re.fullmatch(
            re.escape(name.lower()) + r"__\d{13}_[0-9a-f]{6}", t.name.lower()))

    def save(self, name: str, df: DataFrame, layout: Layout = PLAIN,
             metrics: Mapping[str, Column] | None = None,
             placed: bool = False) -> dict[str, int]:
        """K4: write ``df`` as the new content of ``name``.

        ``placed``: the partitions of ``df`` are the layout's buckets already.

        ``metrics``: aggregates taken from the rows while they are written;
        returned with ``rows``, their number.
        """
        # Table names are compared as they sort: milliseconds, then chance.
        build = f"{name}__{int(time.time() * 1000):013d}_{uuid.uuid4().hex[:6]}"
        path = self._folder(name, build)
        # The exchange that the reports then do without.
        rows = (df.repartition(layout.buckets, *layout.cluster_by)
                if layout.buckets and not placed else df)
        # Observed beneath the write itself: a task that is run again counts once.
        obs = Observation(f"save_{uuid.uuid4().hex}")
        rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"),
                            *(c.alias(k) for k, c in (metrics or {}).items()))
        writer = rows.write.format("parquet").mode("overwrite").option("path", path)
        if layout.partition_by:
            writer = writer.partitionBy(*layout.partition_by)
        if layout.buckets:
            writer = writer.bucketBy(layout.buckets, *layout.cluster_by)
            if layout.sort_by:
                writer = writer.sortBy(*layout.sort_by)
        elif layout.sort_by:
            raise ValueError("sort_by needs buckets")
        writer.saveAsTable(self.name(build))
        counted = {k: int(v or 0) for k, v in {"rows": 0, **obs.get}.items()}
        definition = self.spark.sql(f"SHOW CREATE TABLE {self.name(build)}").first()[0]
        write_text(self.spark, self._folder(name, "_definitions", build),
                   json.dumps(df.columns) + "\n" + definition)
        self._point(name, build, df.columns)
        for old in self._builds(name)[:-KEPT]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(old)}")
            remove_path(self.spark, self._folder(name, old))
            remove_path(self.spark, self._folder(name, "_definitions", old))
        return counted

    def _point(self, name: str, build: str, columns: list[str]) -> None:
        """Make ``name`` the table ``build``, its columns in the given order."""
        chosen = ", ".join(map(_quoted, columns))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(name)} AS "
                       f"SELECT {chosen} FROM {self.name(build)}")

    def save_view(self, name: str, sql: str) -> DataFrame:
        """K3: a view that stays in the catalogue, planned where it is read."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(name)} AS {sql}")
        return self.table(name)

    def attach(self, name: str) -> DataFrame:
        """The table ``name``; registered from its files where it is not known."""
        if not self.exists(name):
            definitions = self._folder(name, "_definitions")
            written = sorted(child_names(self.spark, definitions))
            if not written:
                raise LookupError(f"no table {self.database}.{name} under {self.root}")
            build = written[-1]
            text = read_text(self.spark, os.path.join(definitions, build))
            columns, sql = text.split("\n", 1)
            if not self.exists(build):
                # Registered under this catalogue's database, whatever it was called.
                sql = re.sub(r"^CREATE TABLE \S+", f"CREATE TABLE {self.name(build)}", sql)
                self.spark.sql(sql)
                if "PARTITIONED BY" in sql:
                    self.spark.sql(f"ALTER TABLE {self.name(build)} RECOVER PARTITIONS")
            self._point(name, build, json.loads(columns))
        return self.table(name)
