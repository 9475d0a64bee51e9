"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Each query reads the full test tables in ``sf_dir`` (through the raw mapping
of ``sources.testdata``, with wide types) and returns a DataFrame whose columns
match the SQL twin in ``plans.oracle``.  The staging, mart and report queries
are lazy but for the customer table, which is written first.  The analytics
and check queries build the models when first called, the publish queries
also publish them, once per application and input; the others of those then
read the written tables.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import WIDE
from ledgerline.operators import analytics, quality, reports, staging
from ledgerline.plans.jobs import Built, analytics_datasets, build_models, run_all
from ledgerline.plans.models import testdata_graph, testdata_models
from ledgerline.session import fresh_dir, input_stamp
from ledgerline.sinks.files import write_csv, write_parquet
from ledgerline.sinks.lakehouse import PublishedTables
from ledgerline.sources import testdata
from ledgerline.sources.files import ParquetDirSource, read_csv, read_parquet
from ledgerline.sources.files import file_profile as _file_profile

Query = Callable[[SparkSession, str], DataFrame]


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return testdata_models(spark, sf_dir)[name]

    run.__name__ = name
    run.__doc__ = f"The ``{name}`` model over the test tables."
    return run


QUERIES: dict[str, Query] = {
    name: _model(name)
    for name in (
        "stg_customers",
        "stg_orders",
        "stg_products",
        "orders_enriched",
        "rpt_revenue_by_country",
        "rpt_revenue_by_category",
        "rpt_customer_summary",
        "rpt_product_performance",
    )
}


_BUILT: dict[tuple, Built] = {}


def built_models(spark: SparkSession, sf_dir: str) -> Built:
    """E2 once per application and input: every model reading its table by name.

    Like building the models before testing or publishing them, the joins run
    once; the checks and the publish then scan the written orders, mart and
    reports (under the shared folder) instead of recomputing them.
    """
    key = (spark.sparkContext.applicationId, sf_dir, input_stamp(spark, sf_dir))
    if key not in _BUILT:
        raw, _ = testdata_graph(spark, sf_dir)
        root = fresh_dir(spark, "models")
        _BUILT[key] = build_models(spark, raw, root, widths=WIDE, write_orders=True,
                                   database="b_" + root[-12:])
    return _BUILT[key]


# --- analytics datasets (notebook layer, reading the built tables) -------------


def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row profile of the staged orders."""
    return analytics.source_profile(built_models(spark, sf_dir)["stg_orders"])


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled row counts of the three staged source tables."""
    m = testdata_models(spark, sf_dir)
    return analytics.table_counts({
        "customers": m["stg_customers"],
        "products": m["stg_products"],
        "orders": m["stg_orders"],
    })


def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 + P10 over the country report and the sets of its orders."""
    m = built_models(spark, sf_dir)
    return analytics.monthly_trend(m["rpt_revenue_by_country"], m.order_keys)


def country_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 over the country report and the sets of its orders."""
    m = built_models(spark, sf_dir)
    return analytics.country_totals(m["rpt_revenue_by_country"], m.order_keys)


def newest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 for the newest month alone, from the mart's folder of that year."""
    m = built_models(spark, sf_dir)
    report, month = m["rpt_revenue_by_country"], F.col("year") * 100 + F.col("month")
    newest = report.where(month == report.agg(F.max(month)).scalar()).select(
        F.col("year").alias("order_year"), F.col("month").alias("order_month"))
    return reports.rpt_revenue_by_country(reports.for_months(m["orders_enriched"], newest), WIDE)


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 customers by spend."""
    return analytics.top_customers(built_models(spark, sf_dir)["rpt_customer_summary"])


def customer_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 with the reference bins."""
    return analytics.customer_tiers(built_models(spark, sf_dir)["rpt_customer_summary"])


def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17 + W1 with the reference bins."""
    return analytics.tier_counts(built_models(spark, sf_dir)["rpt_customer_summary"])


# A second bin set scaled to this data's spend range, so that several tiers
# are populated (every test customer spends above the reference's top bin).
WIDE_TIER_BOUNDS = (0, 500_000, 1_000_000, 2_000_000, float("inf"))
WIDE_TIER_LABELS = ("< 500k", "500k - 1M", "1M - 2M", "2M+")


def tier_counts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17 + W1 with bins scaled to the test data's spend."""
    return analytics.tier_counts(built_models(spark, sf_dir)["rpt_customer_summary"],
                                 WIDE_TIER_BOUNDS, WIDE_TIER_LABELS)


def category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category share of total revenue."""
    return analytics.category_share(built_models(spark, sf_dir)["rpt_revenue_by_category"])


def product_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by revenue, highest first."""
    return analytics.product_ranking(built_models(spark, sf_dir)["rpt_product_performance"])


def customers_by_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by spend, lowest first (the bar chart's data)."""
    return analytics.customers_by_spend(built_models(spark, sf_dir)["rpt_customer_summary"])


def orders_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 15 fact rows by order id."""
    return analytics.preview(built_models(spark, sf_dir)["orders_enriched"])


# --- data quality (on the built models, as a test step runs after a build) ------


# Raw keys where they are stored: lines and headers apart, before their join.
TEST_RAW_KEYS = (("customers", "customer_id"), ("products", "product_id"),
                 ("order_lines", "order_id"), ("order_headers", "order_id"))
# An order has many lines here, so its key is unique among the headers only.
TEST_UNIQUE = (("order_headers", "order_id"),
               *(k for k in quality.UNIQUE_DECLARED
                 if k not in (("stg_orders", "order_id"), ("orders_enriched", "order_id"))))


def _models_and_raw(spark: SparkSession, sf_dir: str):
    raw, _ = testdata_graph(spark, sf_dir)
    return built_models(spark, sf_dir), {
        **raw, "order_lines": testdata.order_lines(spark, sf_dir),
        "order_headers": testdata.order_headers(spark, sf_dir)}


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 + Q3: the declared not-null tests plus raw primary keys."""
    m, raw = _models_and_raw(spark, sf_dir)
    return quality.declared_not_null(m, raw, TEST_RAW_KEYS, m.observed)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: the declared unique tests, orders by their headers."""
    m, raw = _models_and_raw(spark, sf_dir)
    return quality.declared_unique(m, raw, TEST_UNIQUE)


def dq_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 + Q5: positive prices, line totals, spend and revenue."""
    m, raw = _models_and_raw(spark, sf_dir)
    return quality.declared_positive(m, raw, m.observed)


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 + J5: unknown headers, customers and products, NULL keys in the mart."""
    m, raw = _models_and_raw(spark, sf_dir)
    return quality.referential(m, raw)


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gate, Q1-Q11, with the published tables."""
    from ledgerline.plans.jobs import PUBLISHED_TABLES

    m, raw = _models_and_raw(spark, sf_dir)
    parts = testdata.table(spark, sf_dir, "part").count()
    return quality.suite(m, raw, TEST_RAW_KEYS, TEST_UNIQUE, exact={"stg_products": parts},
                         store=published(spark, sf_dir)[0], published=PUBLISHED_TABLES,
                         observed=m.observed)


def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: model row counts against the declared minimums."""
    m, _ = _models_and_raw(spark, sf_dir)
    return quality.row_counts(m, observed=m.observed)


QUERIES.update({
    f.__name__: f
    for f in (
        source_profile, table_counts, monthly_trend, country_totals, newest_month, top_customers,
        customer_tiers, tier_counts, tier_counts_wide, category_share, product_ranking,
        customers_by_spend, orders_preview, dq_not_null, dq_unique, dq_positive,
        dq_orphans, dq_row_counts, dq_suite,
    )
})


# --- display orders (O1-O3, O7): the keys with their position --------------------


def _in_order(report: str, *keys: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = built_models(spark, sf_dir)[report]
        return reports.with_position(df, reports.order_keys(report)).select(*keys, "position")

    run.__doc__ = f"``{report}`` in its display order."
    return run


def months_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months ascending."""
    trend = monthly_trend(spark, sf_dir)
    return reports.with_position(trend, [F.col("year"), F.col("month")]).select(
        "year", "month", "position")


def countries_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries by revenue, highest first."""
    totals = country_totals(spark, sf_dir)
    return reports.with_position(
        totals, [F.col("total_revenue").desc_nulls_last(), F.col("country").asc_nulls_last()]
    ).select("country", "position")


def mart_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the mart by order; rows of one order by product, quantity and the rest."""
    mart = built_models(spark, sf_dir)["orders_enriched"]
    placed = reports.with_position(mart, reports.order_keys("orders_enriched"))
    return placed.select("order_id", "product_id", "quantity", "position")


QUERIES.update({
    "mart_in_order": mart_in_order,
    "country_in_order": _in_order("rpt_revenue_by_country", "country", "year", "month"),
    "category_in_order": _in_order("rpt_revenue_by_category", "category", "total_revenue"),
    "customers_in_order": _in_order("rpt_customer_summary", "customer_id", "total_spend"),
    "products_in_order": _in_order("rpt_product_performance", "product_id", "total_revenue"),
    "months_in_order": months_in_order,
    "countries_in_order": countries_in_order,
})


# --- sinks, versioned publish, extraction ----------------------------------------


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K5 + S8: the built mart exported as Snappy Parquet and read back."""
    path = fresh_dir(spark, "parquet") + "/orders_enriched.parquet"
    write_parquet(built_models(spark, sf_dir)["orders_enriched"], path)
    return read_parquet(spark, path)


def _csv(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = fresh_dir(spark, "csv") + "/table.csv"
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged products written as CSV, read back with the declared schema."""
    return _csv(spark, built_models(spark, sf_dir)["stg_products"])


def csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for customers."""
    return _csv(spark, built_models(spark, sf_dir)["stg_customers"])


def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for orders."""
    return _csv(spark, built_models(spark, sf_dir)["stg_orders"])


def extract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + K10: extract every table found to Parquet; report without timings."""
    from ledgerline.plans.jobs import extract

    report = extract(spark, ParquetDirSource(spark, sf_dir), fresh_dir(spark, "extract"),
                     parallel_tables=4)
    return report.select("schema_name", "table_name", "row_count", "status")


def file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and (sorted) column list of every source file."""
    found = ParquetDirSource(spark, sf_dir).list_tables()
    return _file_profile(spark, {t: f"{sf_dir}/{t}.parquet" for _, t in found})


# The second versions: part of the first ones' rows, so that versions differ.
SECOND_VERSION = {"rpt_revenue_by_country": "month <= 6",
                  "rpt_revenue_by_category": "num_orders % 2 = 0"}
_STORES: dict[tuple, tuple[PublishedTables, DataFrame, dt.datetime]] = {}


def published(spark: SparkSession, sf_dir: str) -> tuple[PublishedTables, DataFrame, dt.datetime]:
    """(store, publish reports, time between the versions): the five tables
    published, then two of them again with other rows; once per application
    and input."""
    from ledgerline.plans.jobs import PUBLISHED_TABLES

    key = (spark.sparkContext.applicationId, sf_dir, input_stamp(spark, sf_dir))
    if key not in _STORES:
        root = fresh_dir(spark, "warehouse")
        store = PublishedTables(spark, root, database="p_" + root[-12:])
        models = built_models(spark, sf_dir)
        first = store.publish_all({t: models[t] for t in PUBLISHED_TABLES})
        between = dt.datetime.now(dt.timezone.utc)
        time.sleep(0.01)   # commit times are kept in milliseconds
        second = store.publish_all({t: models[t].filter(rows)
                                    for t, rows in SECOND_VERSION.items()})
        _STORES[key] = (store, first.unionByName(second), between)
    return _STORES[key]


def publish_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 + K6-K9: both publishes; per-table verified report."""
    return published(spark, sf_dir)[1]


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + S11: the customer report scanned from its newest version."""
    return published(spark, sf_dir)[0].read("rpt_customer_summary")


def read_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second version of the country report."""
    return published(spark, sf_dir)[0].read("rpt_revenue_by_country")


def read_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: the version of the country report that was current between the two."""
    store, _, between = published(spark, sf_dir)
    return store.read("rpt_revenue_by_country", as_of=between)


def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the namespace's tables with their newest versions."""
    return published(spark, sf_dir)[0].tables()


def store_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: row counts of the built tables against their newest versions."""
    from ledgerline.plans.jobs import PUBLISHED_TABLES

    store, models = published(spark, sf_dir)[0], built_models(spark, sf_dir)
    return quality.counts_match({t: models[t] for t in PUBLISHED_TABLES},
                                {t: store.read(t) for t in PUBLISHED_TABLES})


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: a table's two snapshots, and whether each came after its parent."""
    history = published(spark, sf_dir)[0].history("rpt_revenue_by_category")
    parents = history.select(F.col("snapshot_id").alias("p_id"),
                             F.col("committed_at").alias("p_at"))
    return (history.join(parents, F.col("parent_id") == F.col("p_id"), "left")
            .withColumn("after_parent", F.col("committed_at") > F.col("p_at"))
            .drop("committed_at", "p_id", "p_at"))


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the published mart's columns: position, name, type, rows without a value."""
    return published(spark, sf_dir)[0].schema("orders_enriched")


def published_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: the notebook's months, from the newest published versions."""
    return analytics_datasets(published(spark, sf_dir)[0])["monthly_trend"]


def stored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a staging view in the catalogue over a view of the source's file."""
    catalogue = built_models(spark, sf_dir).catalogue
    raw = catalogue.save_view("raw_products", testdata.products_sql(sf_dir))
    name = catalogue.name("raw_products")
    return catalogue.save_view("stg_products",
                               staging.view_sql("stg_products", raw, name, WIDE))


# An order has many lines here, so its key is not unique among them.
KNOWN_FAILURES = (("unique", "stg_orders", "order_id"), ("unique", "orders_enriched", "order_id"))


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source tables extracted, built, tested, published and compared:
    rows built and published of every table."""
    root, before = fresh_dir(spark, "whole"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        done = run_all(spark, ParquetDirSource(spark, sf_dir), root, testdata.raw_tables,
                       KNOWN_FAILURES, WIDE, tables=testdata.SOURCE_TABLES, parallel_tables=4,
                       database="w_" + root[-12:])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return done["store_counts"]


QUERIES.update({
    f.__name__: f
    for f in (
        published_trend, stored_view, whole_run, parquet_roundtrip, csv_roundtrip, csv_customers, csv_orders, extract_report,
        file_profile, publish_report, published_tables, store_counts, publish_roundtrip,
        snapshot_history, read_newest, read_as_of, schema_report,
    )
})
