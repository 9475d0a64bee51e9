"""Relational sources over JDBC.

Spark's JDBC reader runs on the executors: one query per partition, each
fetching ``fetchsize`` rows per round trip.  A table with a key of any type,
of one column or several, is split into key ranges of about equally many rows:
the split points are quantiles of the keys that the database itself samples in
key order, and a range is a comparison of whole keys, so each task seeks to its
part of the key's index and reads it once.  Only a table without a key is read
by a single task.  Names of schemas, tables and columns are quoted wherever
they enter SQL.

Discovery and column-type SQL depend on the database, so they are
parameters keyed by dialect.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Catalogue queries listing user base tables, ordered.
DISCOVERY_SQL: dict[str, str] = {
    "sqlserver": (
        "SELECT TABLE_SCHEMA, TABLE_NAME FROM INFORMATION_SCHEMA.TABLES "
        "WHERE TABLE_TYPE = 'BASE TABLE' "
        "AND TABLE_SCHEMA NOT IN ('sys', 'INFORMATION_SCHEMA')"
    ),
    "derby": (
        "SELECT s.SCHEMANAME AS TABLE_SCHEMA, t.TABLENAME AS TABLE_NAME "
        "FROM SYS.SYSTABLES t JOIN SYS.SYSSCHEMAS s ON t.SCHEMAID = s.SCHEMAID "
        "WHERE t.TABLETYPE = 'T'"
    ),
}

# Column types of one table, in column order.
COLUMNS_SQL: dict[str, str] = {
    "sqlserver": (
        "SELECT COLUMN_NAME, DATA_TYPE, NUMERIC_PRECISION, NUMERIC_SCALE "
        "FROM INFORMATION_SCHEMA.COLUMNS "
        "WHERE TABLE_SCHEMA = '{schema}' AND TABLE_NAME = '{table}'"
    ),
}

# Primary key columns of one table, with their types, in key order.
PRIMARY_KEY_SQL: dict[str, str] = {
    "sqlserver": (
        "SELECT k.COLUMN_NAME, c.DATA_TYPE "
        "FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS t "
        "JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE k "
        "  ON t.CONSTRAINT_NAME = k.CONSTRAINT_NAME AND t.TABLE_SCHEMA = k.TABLE_SCHEMA "
        "JOIN INFORMATION_SCHEMA.COLUMNS c "
        "  ON c.TABLE_SCHEMA = k.TABLE_SCHEMA AND c.TABLE_NAME = k.TABLE_NAME "
        "  AND c.COLUMN_NAME = k.COLUMN_NAME "
        "WHERE t.CONSTRAINT_TYPE = 'PRIMARY KEY' "
        "AND t.TABLE_SCHEMA = '{schema}' AND t.TABLE_NAME = '{table}' "
    ),
}
# Rows of one table.
COUNT_SQL: dict[str, str] = {"sqlserver": "SELECT COUNT_BIG(*) AS n FROM {name}"}
# A sample of whole pages, appended to a table's name; {percent} of them.
SAMPLE_SQL: dict[str, str] = {"sqlserver": "TABLESAMPLE SYSTEM ({percent} PERCENT)"}
QUOTES: dict[str, tuple[str, str]] = {"sqlserver": ("[", "]")}
# Rows that the sample should have for each part: the larger, the evener.
SAMPLED_PER_PART = 1000

# Source column type -> Spark type.  Exact decimals stay decimal
# (money keeps four places); time-of-day becomes a string because Parquet
# time columns are not readable by Spark by default.
SQLSERVER_TYPES: dict[str, str] = {
    "bigint": "bigint",
    "int": "int",
    "integer": "int",
    "smallint": "smallint",
    "tinyint": "smallint",
    "bit": "boolean",
    "numeric": "decimal",
    "decimal": "decimal",
    "money": "decimal(19,4)",
    "smallmoney": "decimal(10,4)",
    "float": "double",
    "real": "float",
    "date": "date",
    "time": "string",
    "datetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz",
    "smalldatetime": "timestamp_ntz",
    "datetimeoffset": "timestamp",
    "binary": "binary",
    "varbinary": "binary",
    "image": "binary",
    "char": "string",
    "nchar": "string",
    "varchar": "string",
    "nvarchar": "string",
    "text": "string",
    "ntext": "string",
    "xml": "string",
    "uniqueidentifier": "string",
    "sql_variant": "string",
}
FALLBACK_TYPE = "string"


def spark_type(source_type: str, precision: int | None = None, scale: int | None = None) -> str:
    """Spark type for a source column type (unknown types -> string)."""
    t = SQLSERVER_TYPES.get(source_type.strip().lower(), FALLBACK_TYPE)
    if t == "decimal":
        p = precision if precision else 38
        s = scale if scale is not None else 0
        return f"decimal({p},{s})"
    return t


def connection_from_env(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """JDBC options for SQL Server from ``MSSQL_*`` variables.

    Database, user and password are required; server, port and the
    certificate-trust flag have defaults.
    """
    env = os.environ if env is None else env
    missing = [v for v in ("MSSQL_DATABASE", "MSSQL_USER", "MSSQL_PASSWORD") if not env.get(v)]
    if missing:
        raise KeyError("missing environment variables: " + ", ".join(missing))
    server = env.get("MSSQL_SERVER", "localhost")
    port = env.get("MSSQL_PORT", "1433")
    trust = "true" if env.get("MSSQL_TRUST_CERT", "1") == "1" else "false"
    return {
        "url": (f"jdbc:sqlserver://{server}:{port};databaseName={env['MSSQL_DATABASE']};"
                f"encrypt=true;trustServerCertificate={trust}"),
        "user": env["MSSQL_USER"],
        "password": env["MSSQL_PASSWORD"],
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    }


def resolve_tables(available: Sequence[tuple[str, str]], specs: Sequence[str],
                   default_schema: str = "dbo") -> list[tuple[str, str]]:
    """``schema.table`` or bare names -> (schema, table) pairs.

    A bare name takes the schema it was discovered in (the last one in
    catalogue order if several), else ``default_schema``.
    """
    by_name: dict[str, str] = {}
    for schema, name in available:
        by_name[name] = schema
    out = []
    for spec in specs:
        if "." in spec:
            schema, name = spec.split(".", 1)
        else:
            schema, name = by_name.get(spec, default_schema), spec
        out.append((schema, name))
    return out


def literal(value) -> str:
    """``value`` as an SQL literal (dates and times as ISO text, bytes in hex)."""
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (bytes, bytearray)):
        return "0x" + bytes(value).hex()
    text = value.isoformat(sep="T") if isinstance(value, dt.datetime) else str(value)
    return ("N" if not text.isascii() else "") + "'" + text.replace("'", "''") + "'"


def _equal(column: str, value) -> str:
    return f"{column} IS NULL" if value is None else f"{column} = {literal(value)}"


def _above(column: str, value) -> str:
    """``column`` after ``value``, where NULL comes before every value."""
    return f"{column} IS NOT NULL" if value is None else f"{column} > {literal(value)}"


def _below(column: str, value) -> str | None:
    """``column`` before ``value``; nothing comes before NULL."""
    return None if value is None else f"({column} < {literal(value)} OR {column} IS NULL)"


def key_after(columns: Sequence[str], split: Sequence) -> str:
    """Keys after ``split``, compared column by column as an index orders them."""
    ways = [" AND ".join([*(_equal(c, v) for c, v in zip(columns[:i], split[:i], strict=True)),
                          _above(columns[i], split[i])]) for i in range(len(columns))]
    rest = "(" + " OR ".join(f"({w})" for w in ways) + ")"
    if len(columns) > 1 and split[0] is not None:   # lets the database seek to the start
        return f"({columns[0]} >= {literal(split[0])} AND {rest})"
    return rest


def key_up_to(columns: Sequence[str], split: Sequence) -> str:
    """Keys up to and including ``split``: exactly those not after it, NULLs too.

    Spelled out, because NOT of a comparison with NULL is not true.
    """
    ways = []
    for i, column in enumerate(columns):
        below = _below(column, split[i])
        if below:
            ways.append(" AND ".join(
                [*(_equal(c, v) for c, v in zip(columns[:i], split[:i], strict=True)), below]))
    ways.append(" AND ".join(_equal(c, v) for c, v in zip(columns, split, strict=True)))
    return "(" + " OR ".join(f"({w})" for w in ways) + ")"


def range_predicates(columns: Sequence[str], splits: Sequence[Sequence]) -> list[str]:
    """One condition for each range between ``splits`` (rising, distinct): every
    key, NULL in any of its columns included, meets exactly one."""
    if not splits:
        return ["1 = 1"]
    return [key_up_to(columns, splits[0]),
            *(f"{key_after(columns, lo)} AND {key_up_to(columns, hi)}"
              for lo, hi in zip(splits, splits[1:], strict=False)),
            key_after(columns, splits[-1])]


@dataclass
class JdbcSource:
    """One database reached through Spark's JDBC data source."""

    spark: SparkSession
    options: dict[str, str]
    dialect: str = "sqlserver"
    fetchsize: int = 100_000
    rows_per_partition: int = 1_000_000
    max_connections: int | None = None
    partition_columns: dict[str, str | Sequence[str]] = field(default_factory=dict)

    def quoted(self, name: str) -> str:
        """``name`` as an identifier of the dialect, whatever it contains."""
        left, right = QUOTES.get(self.dialect, ('"', '"'))
        return left + name.replace(right, right * 2) + right

    def _about(self, sql: str, schema: str, table: str) -> str:
        """A catalogue query for one table, its name as string literals."""
        literal = lambda s: s.replace("'", "''")
        return sql.format(schema=literal(schema), table=literal(table))

    def _reader(self):
        r = self.spark.read.format("jdbc")
        for k, v in self.options.items():
            r = r.option(k, v)
        return r.option("fetchsize", str(self.fetchsize))

    def query(self, sql: str) -> DataFrame:
        """A pushed-down query (runs in the database)."""
        return self._reader().option("query", sql).load()

    def catalogue(self) -> DataFrame:
        """S3: user base tables as a DataFrame, ordered by schema and name."""
        return self.query(DISCOVERY_SQL[self.dialect]).orderBy("TABLE_SCHEMA", "TABLE_NAME")

    def list_tables(self) -> list[tuple[str, str]]:
        """S3 collected: the catalogue is metadata (one row per table)."""
        return [(r[0], r[1]) for r in self.catalogue().collect()]

    def column_types(self, schema: str, table: str) -> dict[str, str]:
        """Spark type of every column, from the database's catalogue."""
        sql = COLUMNS_SQL.get(self.dialect)
        if sql is None:
            return {}
        rows = self.query(self._about(sql, schema, table)).collect()
        return {r[0]: spark_type(r[1], r[2], r[3]) for r in rows}

    def key_columns(self, schema: str, table: str) -> list[str]:
        """Columns of the key to split reads on: configured (a column or several),
        else the primary key; empty if there is none."""
        key = self.partition_columns.get(f"{schema}.{table}") or self.partition_columns.get(table)
        if key:
            return [key] if isinstance(key, str) else list(key)
        if self.dialect not in PRIMARY_KEY_SQL:
            return []
        rows = self.query(self._about(PRIMARY_KEY_SQL[self.dialect], schema, table)).collect()
        return [r[0] for r in rows]

    def parts_for(self, rows: int) -> int:
        """Number of ranges: about ``rows_per_partition`` rows each.

        How many are read at a time is another matter (``max_connections``).
        """
        return max(1, -(-int(rows) // self.rows_per_partition))

    def split_query(self, name: str, columns: Sequence[str], rows: int, parts: int) -> str:
        """SQL for the ``parts`` - 1 keys that cut the table into equal parts.

        The database numbers a sample's keys in key order and returns every
        so-many-th; a table with few rows for each part is numbered whole, which
        reads its key's index once, in order.
        """
        keys = ", ".join(columns)
        wanted = parts * SAMPLED_PER_PART
        percent = 100 * wanted / max(rows, 1)
        source = name
        if percent < 50 and self.dialect in SAMPLE_SQL:
            source = f"{name} {SAMPLE_SQL[self.dialect].format(percent=f'{percent:.6f}')}"
        numbered = (f"SELECT {keys}, ROW_NUMBER() OVER (ORDER BY {keys}) AS place_, "
                    f"COUNT(*) OVER () AS rows_ FROM {source}")
        # A row is a quantile where the part that it lies in changes after it.
        return (f"SELECT {keys}, MIN(place_) AS place_ FROM ({numbered}) s WHERE place_ < rows_ "
                f"AND FLOOR(place_ * {parts}.0 / rows_) <> "
                f"FLOOR((place_ - 1) * {parts}.0 / rows_) GROUP BY {keys}")

    def split_points(self, name: str, columns: Sequence[str], rows: int) -> list[tuple]:
        """Quantiles of the key in the database's own order, at most one a part."""
        parts = self.parts_for(rows)
        if parts < 2:
            return []
        found = self.query(self.split_query(name, columns, rows, parts)).orderBy("place_")
        return [tuple(r)[:-1] for r in found.collect()]

    def read(self, schema: str, table: str) -> DataFrame:
        """The whole table, split by ranges of its key.

        A row whose key lies beyond the sampled ones still lands in the first or
        last range, so nothing is lost if the table grows between the two reads.
        """
        name = f"{self.quoted(schema)}.{self.quoted(table)}"
        columns = [self.quoted(k) for k in self.key_columns(schema, table)]
        splits = []
        if columns and self.dialect in COUNT_SQL:
            rows = self.query(COUNT_SQL[self.dialect].format(name=name)).first()[0]
            splits = self.split_points(name, columns, rows)
        if not splits:
            return self._reader().option("dbtable", name).load()
        properties = {k: v for k, v in self.options.items() if k != "url"}
        df = self.spark.read.jdbc(self.options["url"], name,
                                  predicates=range_predicates(columns, splits),
                                  properties={**properties, "fetchsize": str(self.fetchsize)})
        if self.max_connections:
            # Fewer tasks, each reading several parts one after another.
            df = df.coalesce(self.max_connections)
        return df


def unconvertible(df: DataFrame, types: Mapping[str, str]) -> dict[str, Column]:
    """For each column with a mapped type, an aggregate that counts the values
    that do not convert to it."""
    return {name: F.count_if(F.col(f"`{name}`").isNotNull()
                             & F.col(f"`{name}`").try_cast(types[name]).isNull())
            for name in df.columns if name in types}


def conform(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, Column]:
    """Cast columns to their mapped types without failing the scan.

    Returns the cast DataFrame and an aggregate counting values the cast
    turned into NULL (non-NULL before, NULL after); the extraction job
    observes it during the write and fails the table if it is not zero.
    """
    cols, lost = [], []
    for name in df.columns:
        target = types.get(name)
        if target is None:
            cols.append(F.col(name))
            continue
        cast = F.col(name).try_cast(target)
        cols.append(cast.alias(name))
        lost.append(F.when(F.col(name).isNotNull() & cast.isNull(), 1).otherwise(0))
    total = F.lit(0)
    for c in lost:
        total = total + c
    return df.select(*cols, total.alias("_lost")), F.sum("_lost")
