"""File sources: Parquet (S8, S12), CSV (S9), file profiles.

Reads take an explicit schema where one is known, so no inference pass runs
and types never drift (CSV inference would, for instance, read a decimal
price as a double).
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; ``columns`` prunes the read to those columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True) -> DataFrame:
    """CSV scan with a declared schema (the documented fallback source)."""
    return (
        spark.read.schema(schema)
        .option("header", str(header).lower())
        .option("mode", "FAILFAST")
        .csv(path)
    )


def file_profile(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Row count and column list of each named Parquet file.

    Row counts come from Parquet footers (a metadata-only aggregate); the
    column list (sorted by name) is read from the file schema.
    """
    parts = []
    for name, path in paths.items():
        df = spark.read.parquet(path)
        cols = df.columns
        parts.append(df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(cols)).alias("column_count"),
            F.lit(", ".join(sorted(cols))).alias("columns"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raw_tables(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The three raw tables from ``<folder>/<name>.<fmt>`` with declared schemas.

    Parquet is the primary format; CSV (with a header row) is the fallback.
    """
    from ledgerline.sources.schemas import RAW_SCHEMAS

    out = {}
    for name, schema in RAW_SCHEMAS.items():
        path = os.path.join(folder, f"{name}.{fmt}")
        if fmt == "parquet":
            out[name] = read_parquet(spark, path, schema)
        elif fmt == "csv":
            out[name] = read_csv(spark, path, schema)
        else:
            raise ValueError(f"unsupported raw format {fmt!r}")
    return out


class ParquetDirSource:
    """A folder of ``<table>.parquet`` files seen as one database schema.

    Implements the same ``list_tables`` / ``read`` interface as
    :class:`ledgerline.sources.jdbc.JdbcSource`, so extraction can be run
    and tested against files.
    """

    def __init__(self, spark: SparkSession, root: str, schema_name: str = "dbo"):
        self.spark = spark
        self.root = root
        self.schema_name = schema_name

    def list_tables(self) -> list[tuple[str, str]]:
        """Every ``*.parquet`` entry of the folder, on any Hadoop file system."""
        sc = self.spark.sparkContext
        pattern = sc._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, "*.parquet"))
        fs = pattern.getFileSystem(sc._jsc.hadoopConfiguration())
        found = fs.globStatus(pattern) or []
        names = sorted(st.getPath().getName()[: -len(".parquet")] for st in found)
        return [(self.schema_name, n) for n in names]

    def read(self, schema: str, table: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.root, f"{table}.parquet"))
