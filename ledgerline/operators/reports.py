"""Reporting layer: four aggregates over the enriched fact.

Every report is one ``groupBy`` with partial (map-side) aggregation before the
shuffle, so a hot key -- one country or one category holding a third of all
lines -- is collapsed inside each map task and never reaches a single reducer
as raw rows.  ``count(distinct order_id)`` is planned by Catalyst as a
two-level aggregate keyed first on ``(group, order_id)``, which spreads even
the hottest group across all shuffle partitions.

Widths follow the contract (``Widths``: sums decimal(12,2), unit sums int,
averages decimal(10,2)); a larger deployment passes wider ones instead of
failing on overflow (ANSI mode raises, never wraps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import (
    CONTRACT,
    Widths,
    day_diff,
    decimal_of_double,
    ratio_as_decimal,
)
from ledgerline.session import fresh_dir
from ledgerline.sinks.files import write_parquet


def _sales_aggs() -> list:
    """The shared base aggregates, each computed once per group."""
    return [
        F.countDistinct("order_id").alias("_orders"),
        F.sum("quantity").alias("_units"),
        F.sum("line_total").alias("_revenue"),
    ]


def _sales_cols(widths: Widths, orders: str, units: str, revenue: str,
                units_type: str | None = None) -> list:
    """Derived report columns from :func:`_sales_aggs`."""
    return [
        F.col("_orders").alias(orders),
        F.col("_units").cast(units_type or widths.units).alias(units),
        F.col("_revenue").cast(widths.revenue).alias(revenue),
        ratio_as_decimal(F.col("_revenue"), F.col("_orders"), widths.average_digits, 2)
        .alias("avg_order_value"),
    ]


def rpt_revenue_by_country(enriched: DataFrame, widths: Widths = CONTRACT) -> DataFrame:
    """A1: revenue per country, year and month.

    ``units_sold`` is the uncast integer sum, returned as bigint.
    """
    return (
        enriched.groupBy(
            "country",
            F.col("order_year").alias("year"),
            F.col("order_month").alias("month"),
        )
        .agg(*_sales_aggs())
        .select("country", "year", "month",
                *_sales_cols(widths, "num_orders", "units_sold", "total_revenue", "bigint"))
    )


def for_months(enriched: DataFrame, months: DataFrame) -> DataFrame:
    """The mart's rows of the months in ``months`` (order_year, order_month).

    Where the mart lies in folders by year, Spark first looks at ``months`` and
    then reads the folders of their years alone (dynamic partition pruning).
    A month stands in ``months`` once, at most a few thousand rows.
    """
    chosen = F.broadcast(months.select("order_year", "order_month").distinct())
    return enriched.join(chosen, ["order_year", "order_month"], "left_semi")


def product_sales(enriched: DataFrame) -> DataFrame:
    """Base aggregates and lines of each product: the product report needs them as
    they are, the category report adds them up."""
    return enriched.groupBy("product_id", "product_name", "category", "unit_price").agg(
        *_sales_aggs(), F.count(F.lit(1)).alias("_lines"))


def rpt_revenue_by_category(enriched: DataFrame, widths: Widths = CONTRACT,
                            sales: DataFrame | None = None) -> DataFrame:
    """A2: revenue per product category, with two distinct counts.

    ``avg_unit_price`` averages the price over fact rows (weighted by line),
    not over products.  Sums and the product count come from one aggregate
    per (category, product); only the distinct orders need a second look at
    the fact, a two-level count.  Two distinct counts in one aggregate would
    multiply the fact's rows instead.  ``sales``: the written
    :func:`product_sales`, in place of that aggregate.
    """
    cents = (F.col("unit_price") * 100).cast("decimal(38,0)")
    if sales is None:
        products = enriched.groupBy("category", "product_id").agg(
            F.sum("quantity").alias("_units"), F.sum("line_total").alias("_revenue"),
            F.sum(cents).alias("_cents"), F.count("unit_price").alias("_priced"))
        number = F.count("product_id")
    else:
        lines = F.col("_lines").cast("decimal(19,0)")
        products = sales.select(
            "category", "product_id", "_units", "_revenue",
            ((F.col("unit_price") * 100).cast("decimal(18,0)") * lines).alias("_cents"),
            F.when(F.col("unit_price").isNull(), 0).otherwise(F.col("_lines")).alias("_priced"))
        number = F.countDistinct("product_id")
    sums = products.groupBy("category").agg(
        *(F.sum(c).alias(c) for c in ("_units", "_revenue", "_cents", "_priced")),
        number.alias("num_products"))
    orders = enriched.groupBy(F.col("category").alias("_category")).agg(
        F.countDistinct("order_id").alias("_orders"))
    # avg(decimal) is the sum of the unscaled values over count * 100, in double.
    average = F.col("_cents").cast("double") / (F.col("_priced").cast("double") * 100.0)
    return (
        sums.join(orders, F.col("category").eqNullSafe(F.col("_category")))
        .select("category", *_sales_cols(widths, "num_orders", "units_sold", "total_revenue"),
                decimal_of_double(average, widths.average_digits, 2).alias("avg_unit_price"),
                "num_products")
    )


def rpt_customer_summary(enriched: DataFrame, widths: Widths = CONTRACT) -> DataFrame:
    """A3: lifetime metrics per customer (only customers with orders)."""
    return (
        enriched.groupBy("customer_id", "customer_name", "email", "country")
        .agg(*_sales_aggs(),
             F.min("order_date").alias("first_order_date"),
             F.max("order_date").alias("last_order_date"))
        .select("customer_id", "customer_name", "email", "country",
                *_sales_cols(widths, "total_orders", "total_units", "total_spend"),
                "first_order_date", "last_order_date",
                day_diff("first_order_date", "last_order_date").alias("days_as_customer"))
    )


def rpt_product_performance(
    enriched: DataFrame, stg_products: DataFrame, widths: Widths = CONTRACT,
    sales: DataFrame | None = None,
) -> DataFrame:
    """A4 + J4: sales per product joined back to the product's stock level.

    The aggregate runs first, so the join sees one row per sold product
    rather than one per order line.  ``sales``: the written
    :func:`product_sales`, in place of that aggregate.
    """
    sales = (product_sales(enriched) if sales is None else sales).select(
        "product_id", "product_name", "category", "unit_price",
        *_sales_cols(widths, "num_orders", "units_sold", "total_revenue"))
    stock = stg_products.select("product_id", F.col("stock_qty").alias("stock_remaining"))
    return sales.join(stock, "product_id", "inner").select(
        "product_id",
        "product_name",
        "category",
        "unit_price",
        "num_orders",
        "units_sold",
        "total_revenue",
        "avg_order_value",
        "stock_remaining",
        (F.col("stock_remaining") + F.col("units_sold")).cast(widths.units)
        .alias("original_stock_estimate"),
    )


# Display orders of the mart and reports (O1-O3), as (column,
# descending) pairs, and the columns that break ties.
REPORT_ORDER: dict[str, list[tuple[str, bool]]] = {
    "orders_enriched": [("order_id", False)],
    "rpt_revenue_by_country": [("year", False), ("month", False), ("country", False)],
    "rpt_revenue_by_category": [("total_revenue", True)],
    "rpt_customer_summary": [("total_spend", True)],
    "rpt_product_performance": [("total_revenue", True)],
}
TIES: dict[str, tuple[str, ...]] = {
    "orders_enriched": ("product_id", "quantity"),
    "rpt_revenue_by_category": ("category",),
    "rpt_customer_summary": ("customer_id",),
    "rpt_product_performance": ("product_id",),
}


def build_reports(enriched: DataFrame, stg_products: DataFrame, widths: Widths = CONTRACT,
                  sales: DataFrame | None = None) -> dict[str, DataFrame]:
    """All four reports from one enriched fact (``sales``: see the last two)."""
    return {
        "rpt_revenue_by_country": rpt_revenue_by_country(enriched, widths),
        "rpt_revenue_by_category": rpt_revenue_by_category(enriched, widths, sales),
        "rpt_customer_summary": rpt_customer_summary(enriched, widths),
        "rpt_product_performance": rpt_product_performance(enriched, stg_products, widths, sales),
    }


def order_keys(name: str) -> list[Column]:
    """Sort keys of a report's display order, ties broken; NULLs last."""
    return [*(F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last()
              for c, desc in REPORT_ORDER[name]),
            *(F.col(c).asc_nulls_last() for c in TIES.get(name, ()))]


def ordered(name: str, df: DataFrame) -> DataFrame:
    """The report in its display order (a distributed range sort)."""
    return df.orderBy(*order_keys(name))


def with_position(df: DataFrame, keys: list[Column]) -> DataFrame:
    """``df`` with ``position``, 1 for the first row in the order of ``keys``.

    A range-partitioned sort gives each row its place within its partition;
    the rows of the partitions before are added to it.  No task sees more
    than its own range, however large the table.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "ordered")
    write_parquet(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({
            "_part": F.spark_partition_id(),
            "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), path)
    placed = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").count().select(   # one row per partition
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return (placed.join(offsets, "_part")
            .withColumn("position", F.col("_place") + F.col("_before") + 1)
            .drop("_part", "_place", "_before"))
