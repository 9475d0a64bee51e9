"""Analytics datasets derived from the reports.

These are the data behind the notebook's tables and charts, computed as
distributed DataFrames; only the final (small) result is ever shown.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import (
    SPEND_TIER_BOUNDS,
    SPEND_TIER_LABELS,
    bucket,
    period_label,
    share_pct,
)
from ledgerline.operators import keysets

TOTAL_TYPE = "decimal(28,2)"


def _distinct(df: DataFrame, key: str) -> Column:
    """The exact number of distinct values of ``key`` as a scalar subquery."""
    if keysets.holds_integers(df, key):
        return keysets.size(keysets.key_set(df, key), "n").scalar()
    return df.agg(F.countDistinct(key)).scalar()


def source_profile(orders: DataFrame) -> DataFrame:
    """One-row profile of the orders table.

    One aggregate for each key column, reading that column alone: two distinct
    counts in one aggregate would make Spark write every row twice.  Integer
    keys are counted as a set of bits.
    """
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.min("order_date").alias("earliest_order"),
        F.max("order_date").alias("latest_order"),
    ).select("total_orders", _distinct(orders, "customer_id").alias("unique_customers"),
             _distinct(orders, "product_id").alias("unique_products"),
             "earliest_order", "latest_order")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of labelled row counts, one row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


ORDER_GROUPS = ("country", "order_year", "order_month")


def order_keys(enriched: DataFrame) -> DataFrame:
    """A5: the set of orders in each country, year and month.

    Counts over any coarser grouping follow from it by merging sets, exactly:
    an order that stands in two countries is one order of its month.
    """
    return keysets.key_set(enriched, "order_id", *ORDER_GROUPS)


def _with_orders(totals: DataFrame, keys: DataFrame, groups: Mapping[str, str]) -> DataFrame:
    """``totals`` with the size of each group's merged set as ``total_orders``."""
    named = keys.select(*(F.col(k).alias(f"_{name}") for name, k in groups.items()),
                        keysets.WORD, keysets.BITS)
    columns = [f"_{name}" for name in groups]
    counts = keysets.size(keysets.merged(named, *columns), "total_orders", *columns)
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in groups]
    return totals.join(counts, same, "left").drop(*columns).withColumn(
        "total_orders", F.coalesce("total_orders", F.lit(0).cast("bigint")))


def monthly_trend(rpt_revenue_by_country: DataFrame, keys: DataFrame | None = None,
                  total_type: str = TOTAL_TYPE) -> DataFrame:
    """A15 + P10: orders and revenue per month with a ``YYYY-MM`` period.

    ``keys``: from :func:`order_keys`; the orders of a month are the merged set
    of its countries.  Without it the countries' counts are added, which is
    exact only as long as an order has one country.
    """
    totals = rpt_revenue_by_country.groupBy("year", "month").agg(
        F.sum("num_orders").cast("bigint").alias("total_orders"),
        F.sum("total_revenue").cast(total_type).alias("total_revenue"))
    if keys is not None:
        totals = _with_orders(totals.drop("total_orders"), keys,
                              {"year": "order_year", "month": "order_month"})
    return totals.select("year", "month", period_label("year", "month").alias("period"),
                         "total_orders", "total_revenue")


def country_totals(rpt_revenue_by_country: DataFrame, keys: DataFrame | None = None,
                   total_type: str = TOTAL_TYPE) -> DataFrame:
    """Revenue and orders per country over all months (``keys`` as above)."""
    totals = rpt_revenue_by_country.groupBy("country").agg(
        F.sum("total_revenue").cast(total_type).alias("total_revenue"),
        F.sum("num_orders").cast("bigint").alias("total_orders"))
    if keys is not None:
        totals = _with_orders(totals.drop("total_orders"), keys, {"country": "country"})
    return totals.select("country", "total_revenue", "total_orders")


def top_customers(rpt_customer_summary: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` biggest spenders (ties broken by customer id).

    Planned as TakeOrderedAndProject: every task keeps its own top ``n`` and
    only those rows are merged.
    """
    return rpt_customer_summary.orderBy(
        F.col("total_spend").desc_nulls_last(), F.col("customer_id").asc()
    ).limit(n)


def customer_tiers(
    rpt_customer_summary: DataFrame,
    bounds: Sequence[float] = SPEND_TIER_BOUNDS,
    labels: Sequence[str] = SPEND_TIER_LABELS,
) -> DataFrame:
    """Each customer's spend tier (right-closed bins)."""
    return rpt_customer_summary.select(
        "customer_id",
        "customer_name",
        "total_orders",
        "total_spend",
        bucket("total_spend", bounds, labels).alias("spend_tier"),
    )


def tier_counts(
    rpt_customer_summary: DataFrame,
    bounds: Sequence[float] = SPEND_TIER_BOUNDS,
    labels: Sequence[str] = SPEND_TIER_LABELS,
) -> DataFrame:
    """A17 + W1: customers per tier, every tier present, with its share.

    One pass: a single global aggregate counts every tier at once, then the
    row is unfolded into one row per tier (empty tiers give 0).  The share is
    relative to the customers that have a tier.
    """
    tier = bucket("total_spend", bounds, labels)
    counts = rpt_customer_summary.agg(
        *[F.count_if(tier == F.lit(label)).alias(f"c{i}") for i, label in enumerate(labels)],
        F.count(tier).alias("tiered"),
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("tier_order"),
            F.lit(label).alias("spend_tier"),
            F.col(f"c{i}").alias("customers"),
        )
        for i, label in enumerate(labels)
    ])
    return counts.select(F.inline(rows), "tiered").select(
        "tier_order",
        "spend_tier",
        "customers",
        F.when(F.col("tiered") > 0, share_pct("customers", "tiered")).alias("share_pct"),
    )


def with_share_of_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """``value`` as a percentage of its column total.

    The total is an uncorrelated scalar subquery: Spark runs it once and
    hands the single value to every task, so there is no join and no task
    ever holds more than its own partition of ``df``.
    """
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, share_pct(value, total))


def category_share(rpt_revenue_by_category: DataFrame) -> DataFrame:
    """Each category's share of total revenue (the pie chart)."""
    return with_share_of_total(
        rpt_revenue_by_category.select("category", "total_revenue"),
        "total_revenue",
        "revenue_share_pct",
    )


def product_ranking(rpt_product_performance: DataFrame) -> DataFrame:
    """O6 + P14: products by revenue, highest first (chart columns only)."""
    return rpt_product_performance.select(
        "product_id", "product_name", "units_sold", "total_revenue", "num_orders"
    ).orderBy(F.col("total_revenue").desc_nulls_last(), F.col("product_id").asc())


def customers_by_spend(rpt_customer_summary: DataFrame) -> DataFrame:
    """Customers by spend, lowest first (horizontal bar chart)."""
    return rpt_customer_summary.select("customer_name", "total_spend").orderBy(
        F.col("total_spend").asc_nulls_last(), F.col("customer_name").asc()
    )


def preview(orders_enriched: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` fact rows in order-id order.

    ``(order_id, product_id, quantity)`` fixes every other column of a fact
    row, so the order is total up to identical rows.
    """
    return orders_enriched.orderBy("order_id", "product_id", "quantity").limit(n)


def monthly_trend_sorted(df: DataFrame) -> DataFrame:
    """Months ascending."""
    return df.orderBy("year", "month")


def country_totals_sorted(df: DataFrame) -> DataFrame:
    """Countries by revenue, highest first."""
    return df.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("country").asc())
