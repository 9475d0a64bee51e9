"""Extraction job (E1/K10) against a file-backed source, and JDBC helpers."""

from __future__ import annotations

import datetime as dt
import itertools
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import WIDE
from ledgerline.plans import jobs
from ledgerline.session import fresh_dir
from ledgerline.sinks.files import write_parquet
from ledgerline.sources.files import ParquetDirSource
from ledgerline.sources.jdbc import (
    JdbcSource,
    conform,
    connection_from_env,
    literal,
    range_predicates,
    resolve_tables,
    spark_type,
)


class FlakySource(ParquetDirSource):
    def read(self, schema, table):
        if table == "products":
            raise OSError("connection reset")
        return super().read(schema, table)


def _source_dir(spark, seed_models):
    _, raw = seed_models
    d = fresh_dir(spark, "src")
    for name, df in raw.items():
        write_parquet(df, os.path.join(d, f"{name}.parquet"))
    return d


def test_extract_all_and_report(spark, seed_models):
    src = _source_dir(spark, seed_models)
    out = fresh_dir(spark, "out")
    rep = jobs.extract(spark, ParquetDirSource(spark, src), out)
    got = {r.table_name: (r.row_count, r.status) for r in rep.collect()}
    assert got == {"customers": (8, "ok"), "orders": (18, "ok"), "products": (8, "ok")}
    assert spark.read.parquet(os.path.join(out, "orders.parquet")).count() == 18
    jobs.raise_on_extract_failure(rep)


def test_one_failure_does_not_stop_the_rest(spark, seed_models):
    src = _source_dir(spark, seed_models)
    rep = jobs.extract(spark, FlakySource(spark, src), fresh_dir(spark, "out"))
    got = {r.table_name: r.row_count for r in rep.collect()}
    assert got == {"customers": 8, "orders": 18, "products": -1}
    with pytest.raises(jobs.ExtractionFailed):
        jobs.raise_on_extract_failure(rep)


def test_parallel_tables_give_the_serial_report(spark, seed_models):
    src = _source_dir(spark, seed_models)

    def report(parallel):
        rep = jobs.extract(spark, FlakySource(spark, src), fresh_dir(spark, "out"),
                           parallel_tables=parallel)
        return [(r.schema_name, r.table_name, r.row_count, r.status[:6]) for r in rep.collect()]

    serial = report(1)
    assert report(3) == serial  # same rows, in discovery order; the failure stays isolated
    assert [r[2] for r in serial] == [8, 18, -1]


def test_requested_tables_only(spark, seed_models):
    src = _source_dir(spark, seed_models)
    rep = jobs.extract(spark, ParquetDirSource(spark, src), fresh_dir(spark, "out"), ["dbo.orders"])
    assert [r.table_name for r in rep.collect()] == ["orders"]


def test_conform_flags_values_that_do_not_fit(spark):
    df = spark.createDataFrame([("1",), ("2",), ("x",), (None,)], "a string")
    cast, lost = conform(df, {"a": "int"})
    assert cast.agg(lost).collect()[0][0] == 1
    assert dict(cast.dtypes)["a"] == "int"


def test_resolve_tables():
    avail = [("dbo", "orders"), ("sales", "orders"), ("dbo", "customers")]
    assert resolve_tables(avail, ["orders", "customers", "x.y", "missing"]) == [
        ("sales", "orders"), ("dbo", "customers"), ("x", "y"), ("dbo", "missing")]


def test_type_map():
    assert spark_type("decimal", 10, 2) == "decimal(10,2)"
    assert spark_type("MONEY") == "decimal(19,4)"
    assert spark_type("tinyint") == "smallint"
    assert spark_type("datetime2") == "timestamp_ntz"
    assert spark_type("geography") == "string"


def test_connection_from_env():
    with pytest.raises(KeyError):
        connection_from_env({})
    opts = connection_from_env({"MSSQL_DATABASE": "db", "MSSQL_USER": "u",
                                "MSSQL_PASSWORD": "p", "MSSQL_TRUST_CERT": "0"})
    assert opts["url"] == ("jdbc:sqlserver://localhost:1433;databaseName=db;"
                           "encrypt=true;trustServerCertificate=false")
    assert opts["user"] == "u"


def test_run_all_end_to_end(spark, seed_models):
    src = _source_dir(spark, seed_models)
    root = fresh_dir(spark, "e2e")
    out = jobs.run_all(spark, ParquetDirSource(spark, src), root)
    assert {r.status for r in out["publish_report"].collect()} == {"ok"}
    assert out["rpt_customer_summary"].count() == 8
    assert spark.read.parquet(os.path.join(root, "output", "orders_enriched.parquet")).count() == 18
    from ledgerline.sinks.lakehouse import PublishedTables

    ds = jobs.analytics_datasets(PublishedTables(spark, os.path.join(root, "warehouse")))
    assert [r.period for r in ds["monthly_trend"].collect()] == ["2024-01", "2024-02", "2024-03"]


def test_run_all_with_sums_beyond_the_contract(spark, seed_models):
    """Quantities times 1,000,000 overflow the contract's widths, wide ones hold."""
    _, raw = seed_models
    src = fresh_dir(spark, "src")
    for name, df in raw.items():
        if name == "orders":
            df = df.withColumn("quantity", F.col("quantity").cast("bigint") * 1_000_000_000)
        write_parquet(df, os.path.join(src, f"{name}.parquet"))
    with pytest.raises(Exception, match="OVERFLOW|out of range|cannot be represented"):
        jobs.run_all(spark, ParquetDirSource(spark, src), fresh_dir(spark, "e2e"))
    out = jobs.run_all(spark, ParquetDirSource(spark, src), fresh_dir(spark, "e2e"), widths=WIDE)
    small = seed_models[0]["rpt_customer_summary"].collect()
    want = {r.customer_id: r.total_spend * 1_000_000_000 for r in small}
    assert {r.customer_id: r.total_spend for r in out["rpt_customer_summary"].collect()} == want
    assert all(r.matched for r in out["store_counts"].collect())


def test_the_store_gate_stops_a_run(spark, seed_models, monkeypatch):
    """Q10 and Q11 after the publish: rows that went missing fail the whole run."""
    from ledgerline.operators.quality import DataQualityError
    from ledgerline.sinks.lakehouse import PublishedTables

    real = PublishedTables.publish
    monkeypatch.setattr(PublishedTables, "publish",
                        lambda self, t, df: real(self, t, df.limit(5)))
    with pytest.raises(DataQualityError, match="store_rows"):
        jobs.run_all(spark, ParquetDirSource(spark, _source_dir(spark, seed_models)),
                     fresh_dir(spark, "e2e"))


def test_a_failed_table_keeps_its_last_good_file(spark):
    class Typed(TwoSchemaSource):
        values = ["1", "2"]

        def list_tables(self):
            return [("dbo", "t")]

        def read(self, schema, table):
            return self.spark.createDataFrame([(v,) for v in self.values], "a string")

        def column_types(self, schema, table):
            return {"a": "int"}

    out, source = fresh_dir(spark, "out"), Typed(spark)
    assert jobs.extract(spark, source, out).first().status == "ok"
    source.values = ["3", "x" * 600]
    failed = jobs.extract(spark, source, out).first()
    assert failed.row_count == -1 and "1 value(s) do not fit" in failed.status
    path = os.path.join(out, "t.parquet")
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 2]
    source.values = ["7"]
    assert jobs.extract(spark, source, out).first().status == "ok"
    assert [r.a for r in spark.read.parquet(path).collect()] == [7]


def test_a_table_named_twice_is_extracted_once(spark, seed_models):
    out = fresh_dir(spark, "out")
    rep = jobs.extract(spark, ParquetDirSource(spark, _source_dir(spark, seed_models)), out,
                       ["orders", "dbo.orders", "orders"])
    assert [r.table_name for r in rep.collect()] == ["orders"]
    assert spark.read.parquet(os.path.join(out, "orders.parquet")).count() == 18


def test_a_clash_is_known_even_if_one_of_the_tables_is_asked_for(spark):
    out = fresh_dir(spark, "out")
    jobs.extract(spark, TwoSchemaSource(spark), out, ["dbo.orders"])
    jobs.extract(spark, TwoSchemaSource(spark), out, ["sales.orders"])
    assert spark.read.parquet(os.path.join(out, "dbo", "orders.parquet")).count() == 2
    assert spark.read.parquet(os.path.join(out, "sales", "orders.parquet")).count() == 3


def test_jdbc_parts_follow_the_rows(spark):
    src = JdbcSource(spark, {}, rows_per_partition=1000,
                     partition_columns={"dbo.orders": "order_id"})
    assert src.key_columns("dbo", "orders") == ["order_id"]
    assert [src.parts_for(n) for n in (0, 1000, 10_001, 10**12)] == [1, 1, 11, 10**9]


def test_jdbc_quotes_names(spark):
    src = JdbcSource(spark, {})
    assert src.quoted("Order") == "[Order]" and src.quoted("a]b c'd") == "[a]]b c'd]"
    assert JdbcSource(spark, {}, dialect="derby").quoted('x"y') == '"x""y"'
    assert src._about("WHERE t = '{table}'", "dbo", "it's") == "WHERE t = 'it''s'"


def _ranges(spark, rows, schema, columns, splits):
    """Rows in each range, by Spark's own evaluation of the predicates' text."""
    df = spark.createDataFrame(rows, schema)
    # The N of national text is the source's, not Spark's.
    hits = [F.expr(p.replace("N'", "'")) for p in range_predicates(columns, splits)]
    found = df.select(*columns, F.array(*(F.coalesce(h.cast("int"), F.lit(0)) for h in hits))
                      .alias("h")).collect()
    assert all(sum(r.h) == 1 for r in found), [r for r in found if sum(r.h) != 1]
    return [sum(r.h[i] for r in found) for i in range(len(hits))]


def test_every_key_meets_one_range(spark):
    """One to three columns, NULLs in any of them, splits with NULLs, quotes, dates."""
    rng = random.Random(3)
    kinds = {"a bigint": [None, -5, 0, 3, 3, 9], "b string": [None, "", "it's", "z", "ä"],
             "c date": [None, dt.date(2024, 1, 2), dt.date(2024, 5, 1)]}
    for schema in itertools.chain.from_iterable(
            itertools.permutations(kinds, n) for n in (1, 2, 3)):
        columns = [c.split()[0] for c in schema]
        rows = list(itertools.product(*(kinds[c] for c in schema)))
        order = sorted(set(rows), key=lambda r: [(v is not None, v) for v in r])
        for _ in range(2):
            splits = sorted(rng.sample(range(len(order)), min(3, len(order) - 1)))
            splits = [order[i] for i in splits]
            sizes = _ranges(spark, rows, ", ".join(schema), columns, splits)
            at = [order.index(s) for s in splits]
            want = [sum(lo < order.index(r) <= hi for r in rows)
                    for lo, hi in zip([-1, *at], [*at, len(order)], strict=True)]
            assert sizes == want
    assert range_predicates(["a"], []) == ["1 = 1"]


def test_literals():
    assert [literal(v) for v in (1, True, Decimal("1.50"), 0.5, b"\x01\xff", "o'x", "ü",
                                 dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5))] == [
        "1", "1", "1.50", "0.5", "0x01ff", "'o''x'", "N'ü'", "'2024-01-02'",
        "'2024-01-02T03:04:05'"]


class SparkBackedSource(JdbcSource):
    """Answers the pushed-down queries from a view, so that their text is run."""

    def query(self, sql):
        return self.spark.sql(sql)


@pytest.mark.parametrize("shape", ["sparse", "skewed lead", "one value", "nulls"])
def test_split_points_give_even_ranges(spark, shape):
    rows = {"sparse": [(i ** 4, 0) for i in range(2000)],
            "skewed lead": [(1 if i % 10 else i, i) for i in range(2000)],
            "one value": [(7, 7)] * 2000,
            "nulls": [(None if i % 4 == 0 else i, i) for i in range(2000)]}[shape]
    schema, columns = "k bigint, line bigint", ["k", "line"]
    spark.createDataFrame(rows, schema).createOrReplaceTempView("keyed")
    src = SparkBackedSource(spark, {}, dialect="spark", rows_per_partition=250)
    splits = src.split_points("keyed", columns, len(rows))
    sizes = _ranges(spark, rows, schema, columns, splits)
    assert sum(sizes) == 2000
    if shape == "one value":
        assert sizes[0] == 2000       # one key cannot be divided
    else:
        assert len(sizes) == 8 and max(sizes) == 250
    assert src.split_points("keyed", columns, 100) == []


def test_a_large_table_is_sampled():
    src = JdbcSource(None, {}, rows_per_partition=1_000_000)
    text = src.split_query("[dbo].[t]", ["[a]", "[b]"], 10**10, 10_000)
    assert "FROM [dbo].[t] TABLESAMPLE SYSTEM (0.100000 PERCENT)" in text
    assert "ORDER BY [a], [b]" in text
    assert "TABLESAMPLE" not in src.split_query("[dbo].[t]", ["[a]"], 5000, 4)


def test_the_report_says_which_columns_lost_values(spark):
    source = TwoSchemaSource(spark)
    source.list_tables = lambda: [("dbo", "typed")]
    source.read = lambda s, t: spark.createDataFrame(
        [("1", "x", "2024-01-02"), ("y", "z", "2024-13-02"), (None, "1.5", None)],
        "a string, b string, c string")
    status = jobs.extract(spark, source, fresh_dir(spark, "out")).first().status
    assert "4 value(s) do not fit" in status
    assert "a (int): 1, b (decimal(10,2)): 2, c (date): 1" in status


class TwoSchemaSource:
    """Two schemas that both hold an ``orders`` table, plus typed columns."""

    def __init__(self, spark):
        self.spark = spark

    def list_tables(self):
        return [("dbo", "orders"), ("sales", "orders"), ("dbo", "typed")]

    def read(self, schema, table):
        if table == "typed":
            return self.spark.createDataFrame(
                [("1", "12.50", "2024-01-02", "2024-01-02 03:04:05", "1", "7")],
                "a string, b string, c string, d string, e string, f string")
        n = 2 if schema == "dbo" else 3
        return self.spark.range(n).withColumnRenamed("id", "order_id")

    def column_types(self, schema, table):
        if table != "typed":
            return {}
        src = {"a": ("int", None, None), "b": ("decimal", 10, 2), "c": ("date", None, None),
               "d": ("datetime2", None, None), "e": ("bit", None, None),
               "f": ("tinyint", None, None)}
        return {k: spark_type(*v) for k, v in src.items()}


def test_same_named_tables_do_not_overwrite(spark):
    out = fresh_dir(spark, "out")
    rep = {(r.schema_name, r.table_name): r.row_count
           for r in jobs.extract(spark, TwoSchemaSource(spark), out).collect()}
    assert rep == {("dbo", "orders"): 2, ("sales", "orders"): 3, ("dbo", "typed"): 1}
    assert spark.read.parquet(os.path.join(out, "dbo", "orders.parquet")).count() == 2
    assert spark.read.parquet(os.path.join(out, "sales", "orders.parquet")).count() == 3
    typed = spark.read.parquet(os.path.join(out, "typed.parquet"))
    assert dict(typed.dtypes) == {"a": "int", "b": "decimal(10,2)", "c": "date",
                                  "d": "timestamp_ntz", "e": "boolean", "f": "smallint"}
