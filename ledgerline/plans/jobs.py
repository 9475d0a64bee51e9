"""The user-facing jobs.

=====  =========================================================================
E1     ``extract``: every (or each requested) source table -> Parquet + report
E2     ``build_models``: staging views -> materialised mart -> four reports
E3     ``run_data_tests``: the quality suite, raising on any failure
E4     ``publish``: versioned tables with verification and a per-table report
E5     ``analytics``: the notebook datasets from the published tables
E6     ``run_all``: E1 -> E2 -> E3 -> E4, then Q11 (built vs published counts)
=====  =========================================================================

Each job is a function over DataFrames; tables are written under the cluster's
shared folder and known by name in the session catalogue, which also cuts
lineage between stages: the mart is written once and the reports re-read it,
so a lost executor costs at most the stage it was in.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import CONTRACT, Widths
from ledgerline.operators import analytics, marts, quality, reports, staging
from ledgerline.session import input_bytes, run_concurrently, size_shuffle_partitions
from ledgerline.sinks.catalogue import PLAIN, Catalogue, Layout
from ledgerline.sinks.files import remove_path, replace_path, write_parquet
from ledgerline.sinks.lakehouse import PublishedTables, raise_on_failure
from ledgerline.sources.jdbc import conform, resolve_tables, unconvertible

# The published tables.
PUBLISHED_TABLES = (
    "orders_enriched",
    "rpt_revenue_by_country",
    "rpt_revenue_by_category",
    "rpt_customer_summary",
    "rpt_product_performance",
)

REPORT_SCHEMA = ("schema_name string, table_name string, row_count bigint, "
                 "seconds double, status string")


class TableSource(Protocol):
    def list_tables(self) -> list[tuple[str, str]]: ...
    def read(self, schema: str, table: str) -> DataFrame: ...


class ExtractionFailed(RuntimeError):
    """At least one table failed to extract (the others were still written)."""


def _target(out_dir: str, schema: str, table: str, clashes: set[str]) -> str:
    """``<out>/<table>.parquet``; ``<out>/<schema>/<table>.parquet`` on a name clash."""
    if table in clashes:
        return os.path.join(out_dir, schema, f"{table}.parquet")
    return os.path.join(out_dir, f"{table}.parquet")


def extract(spark: SparkSession, source: TableSource, out_dir: str,
            tables: Sequence[str] | None = None, parallel_tables: int = 1) -> DataFrame:
    """Copy source tables to Snappy Parquet; one report row per table.

    Each table is read in parallel by the source's partitions.  By default
    tables are submitted one after another, as a database source expects
    (every concurrent table opens its own partitions' connections);
    ``parallel_tables`` > 1 submits that many at once, which keeps a cluster
    busy when a source has many small tables.  A failing table is reported
    with row count -1 and the rest still run.  A value that cannot be cast
    to its column's type fails its table rather than being silently nulled;
    the report says in which columns, and how many values.
    """
    available = source.list_tables()
    chosen = list(dict.fromkeys(
        resolve_tables(available, tables) if tables else available))
    # A name in two schemas clashes whether or not both are asked for now.
    names = [t for _, t in dict.fromkeys([*available, *chosen])]
    clashes = {t for t in names if names.count(t) > 1}

    def copy(schema: str, table: str) -> tuple:
        t0 = time.perf_counter()
        try:
            df = source.read(schema, table)
            types = getattr(source, "column_types", lambda s, t: {})(schema, table)
            counted = unconvertible(df, types)
            obs = Observation(f"extract_{uuid.uuid4().hex}")
            observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                                  *(c.alias(f"lost:{k}") for k, c in counted.items()))
            # Written aside: the last good file stays until this one is whole.
            aside = os.path.join(out_dir, "_incoming", uuid.uuid4().hex)
            n = write_parquet(conform(observed, types)[0].drop("_lost"), aside)
            lost = {k: obs.get.get(f"lost:{k}", 0) for k in counted}
            if any(lost.values()):
                remove_path(spark, aside)
                where = ", ".join(f"{k} ({types[k]}): {v}" for k, v in lost.items() if v)
                raise ValueError(f"{sum(lost.values())} value(s) do not fit their column type: "
                                 + where)
            replace_path(spark, aside, _target(out_dir, schema, table, clashes))
            return (schema, table, n, time.perf_counter() - t0, "ok")
        except Exception as exc:  # noqa: BLE001 - reported per table
            return (schema, table, -1, time.perf_counter() - t0,
                    f"failed: {type(exc).__name__}: {exc}")

    done = run_concurrently({f"{s}.{t}": (lambda s=s, t=t: copy(s, t)) for s, t in chosen},
                            max_workers=parallel_tables)
    rows = [done[f"{s}.{t}"] for s, t in chosen]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def raise_on_extract_failure(report: DataFrame) -> None:
    bad = report.where(F.col("row_count") < 0).select("schema_name", "table_name").collect()
    if bad:
        raise ExtractionFailed("failed tables: " + ", ".join(f"[{s}].[{t}]" for s, t in bad))


HOT_ORDER_ROWS = 5_000_000   # lines of one order that make its bucket too long


def mart_layout(orders: DataFrame, buckets: int | None = None,
                hot_order_rows: int = HOT_ORDER_ROWS) -> Layout:
    """The mart's files: clustered by order, a folder a year, rows by month.

    Reports count orders within a bucket; a month's report skips other years'
    folders and, by the row groups' ranges, most of its own year.  ``buckets``:
    by default as many as the session's shuffle partitions, which
    ``size_shuffle_partitions`` takes from the size of the input.

    One task writes and reads a bucket.  So where an order has very many lines
    (one narrow pass over ``orders`` with a bounded sketch tells) the mart is
    not clustered, and the reports shuffle what is left after their partial
    aggregates, which collapse that order's lines.
    """
    n = buckets or int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if marts.hot_keys(orders.select("order_id"), "order_id", n, hot_order_rows):
        return Layout(("order_year",))
    return Layout(("order_year",), ("order_id",), n, ("order_month", "order_id"))


#: Stored input for each shuffle partition of a whole run, and so for each bucket
#: of the mart: a task then sorts and counts about a million order lines.
BUILD_BYTES = 16 * 1024 * 1024


class Built(dict):
    """Models by name, each read from its table; the ``catalogue`` that has them
    by name; ``observed``, the checks counted while they were written; the sets
    of ``order_keys``."""

    catalogue: Catalogue
    observed: DataFrame
    order_keys: DataFrame


def build_models(spark: SparkSession, raw: Mapping[str, DataFrame], out_dir: str,
                 export_path: str | None = None, widths: Widths = CONTRACT,
                 write_orders: bool = False, database: str = "default",
                 buckets: int | None = None, view_sources: Mapping[str, str] | None = None,
                 hot_order_rows: int = HOT_ORDER_ROWS) -> Built:
    """Staging views, the materialised mart, then the four reports.

    All are tables of ``database`` afterwards, replaced together with their
    content only when it is whole (``spark.table("default.orders_enriched")``);
    their files lie under ``out_dir``.  The mart is written once (K4), clustered
    by order, so that no report shuffles it to count orders; the report writes
    are independent and are submitted together.  NULLs, non-positive values and
    rows are counted while each table is written.

    ``export_path`` adds the external Parquet copy (K5).  ``write_orders``
    writes the staged orders too: worth it where the raw orders are themselves
    a join that the data tests would run again.  ``buckets`` and
    ``hot_order_rows``: see :func:`mart_layout`.  ``view_sources``: names of the raw tables in the
    catalogue; the staging models then become views there (K3).
    """
    staged = staging.stage_all(raw, widths)
    catalogue = Catalogue(spark, out_dir, database)
    for model, source in (view_sources or {}).items():
        catalogue.save_view(model, staging.view_sql(model, raw[staging.STAGED[model]], source,
                                                    widths))
    taken: dict[str, dict[str, int]] = {}

    def written_out(name: str, df: DataFrame, layout: Layout = PLAIN,
                    placed: bool = False) -> DataFrame:
        taken[name] = catalogue.save(name, df, layout, quality.metrics_of(name), placed)
        return catalogue.table(name)

    def all_of(tasks: dict) -> dict:
        done = run_concurrently(tasks, max_workers=len(tasks))
        for result in done.values():
            if isinstance(result, BaseException):
                raise result
        return done

    if write_orders:
        staged["stg_orders"] = written_out("stg_orders", staged["stg_orders"])
    layout = mart_layout(staged["stg_orders"], buckets, hot_order_rows)
    joined = (marts.clustered_mart(staged, widths, layout.buckets, *layout.cluster_by)
              if layout.buckets else None)
    mart = written_out("orders_enriched", marts.build_mart(staged, widths) if joined is None
                       else joined, layout, joined is not None)
    if export_path:
        write_parquet(mart, export_path)
    # Two reports need the sales of each product: they are added up once, aside.
    later = ("rpt_revenue_by_category", "rpt_product_performance")
    step = os.path.join(out_dir, f"_product_sales_{uuid.uuid4().hex}")
    sales = reports.product_sales(mart)

    def tasks(built: Mapping[str, DataFrame]) -> dict:
        return {name: (lambda n=name, df=df: written_out(n, df)) for name, df in built.items()}

    first = {**reports.build_reports(mart, staged["stg_products"], widths),
             "order_keys": analytics.order_keys(mart)}
    written = all_of({"product_sales": lambda: write_parquet(sales, step),
                      **tasks({k: df for k, df in first.items() if k not in later})})
    del written["product_sales"]
    second = reports.build_reports(mart, staged["stg_products"], widths,
                                   spark.read.schema(sales.schema).parquet(step))
    written.update(all_of(tasks({k: second[k] for k in later})))
    remove_path(spark, step)
    catalogue.save("observed_checks", quality.observed_checks(spark, taken))
    return _built(catalogue, {**staged, **written, "orders_enriched": mart})


def _built(catalogue: Catalogue, models: Mapping[str, DataFrame]) -> Built:
    out = Built({k: v for k, v in models.items() if k != "order_keys"})
    out.catalogue = catalogue
    out.order_keys = models["order_keys"]
    out.observed = catalogue.attach("observed_checks")
    return out


def attach_models(spark: SparkSession, raw: Mapping[str, DataFrame], out_dir: str,
                  widths: Widths = CONTRACT, database: str = "default") -> Built:
    """The models that an earlier session built under ``out_dir``."""
    catalogue = Catalogue(spark, out_dir, database)
    return _built(catalogue, {
        **staging.stage_all(raw, widths),
        **{t: catalogue.attach(t) for t in (*PUBLISHED_TABLES, "order_keys")}})


def run_data_tests(models: Mapping[str, DataFrame], raw: Mapping[str, DataFrame],
                   allow: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """The quality suite; raises ``DataQualityError`` on any failure.

    What was counted while the models were written is not counted again.
    """
    results = quality.suite(models, raw, observed=getattr(models, "observed", None))
    quality.gate(results, allow)
    return results


def publish(spark: SparkSession, models: Mapping[str, DataFrame], warehouse: str,
            tables: Sequence[str] = PUBLISHED_TABLES, namespace: str = "default") -> DataFrame:
    """Publish the chosen tables as new versions; raise if any failed."""
    store = PublishedTables(spark, warehouse, namespace)
    report = store.publish_all({t: models[t] for t in tables})
    raise_on_failure(report)
    return report


def store_gate(spark: SparkSession, models: Mapping[str, DataFrame], warehouse: str,
               tables: Sequence[str] = PUBLISHED_TABLES, namespace: str = "default",
               allow: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Q10 + Q11: every table is published with as many rows as were built; raises
    ``DataQualityError`` otherwise.  Returns both counts of every table."""
    store = PublishedTables(spark, warehouse, namespace)
    quality.gate(quality.store_contract(models, store, tables), allow)
    return quality.counts_match({t: models[t] for t in tables},
                                {t: store.read(t) for t in tables})


def analytics_datasets(store: PublishedTables) -> dict[str, DataFrame]:
    """E5: the notebook's datasets, read from the newest published versions."""
    mart = store.read("orders_enriched")
    country = store.read("rpt_revenue_by_country")
    customers = store.read("rpt_customer_summary")
    products = store.read("rpt_product_performance")
    category = store.read("rpt_revenue_by_category")
    keys = analytics.order_keys(mart)
    return {
        "orders_preview": analytics.preview(mart),
        "monthly_trend": analytics.monthly_trend_sorted(analytics.monthly_trend(country, keys)),
        "country_totals": analytics.country_totals_sorted(
            analytics.country_totals(country, keys)),
        "top_customers": analytics.top_customers(customers),
        "customer_tiers": analytics.customer_tiers(customers),
        "tier_counts": analytics.tier_counts(customers),
        "product_ranking": analytics.product_ranking(products),
        "category_share": analytics.category_share(category),
        "customers_by_spend": analytics.customers_by_spend(customers),
    }


def run_all(spark: SparkSession, source: TableSource, root: str,
            raw_reader=None, allow: Sequence[tuple[str, str, str]] = (),
            widths: Widths = CONTRACT, tables: Sequence[str] | None = None,
            parallel_tables: int = 1, buckets: int | None = None, database: str = "default",
            namespace: str = "default") -> dict[str, DataFrame]:
    """Extract -> build -> test -> publish -> compare the stores, under ``root``.

    ``raw_reader(spark, parquet_dir)`` turns the extracted files into the
    three raw tables (default: ``customers``/``products``/``orders`` files).
    ``widths``: wider types for large keys and sums; ``tables``: the source
    tables to extract.  The shuffle is sized from the extracted files.
    """
    parquet_dir = os.path.join(root, "parquet")
    report = extract(spark, source, parquet_dir, tables, parallel_tables)
    raise_on_extract_failure(report)
    size_shuffle_partitions(spark, input_bytes(spark, parquet_dir), BUILD_BYTES)
    if raw_reader is None:
        raw = {t: spark.read.parquet(os.path.join(parquet_dir, f"{t}.parquet"))
               for t in ("customers", "products", "orders")}
    else:
        raw = raw_reader(spark, parquet_dir)
    models = build_models(spark, raw, os.path.join(root, "models"),
                          os.path.join(root, "output", "orders_enriched.parquet"),
                          widths, database=database, buckets=buckets)
    tests = run_data_tests(models, raw, allow)
    warehouse = os.path.join(root, "warehouse")
    published = publish(spark, models, warehouse, namespace=namespace)
    stores = store_gate(spark, models, warehouse, namespace=namespace, allow=allow)
    return {"extract_report": report, "data_tests": tests, "publish_report": published,
            "store_counts": stores, **models}
