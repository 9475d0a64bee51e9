"""Mart layer: the enriched order fact.

One row per staged order line that has both a known customer and a known
product (inner joins: orphans drop out here; ``quality.orphans`` reports
them).  Join strategy is left to the optimizer: AQE broadcasts a dimension
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise keeps a sort-merge join, splitting skewed fact partitions
(``spark.sql.adaptive.skewJoin.enabled``) so one hot customer or product
does not land in a single task.  Where adaptive execution is off, hot keys are
found by a bounded sketch and joined apart (``split_join``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import CONTRACT, Widths, day_diff

# The mart's columns, in order.
ENRICHED_COLUMNS = (
    "order_id",
    "order_date",
    "status",
    "quantity",
    "customer_id",
    "customer_name",
    "email",
    "country",
    "signup_date",
    "product_id",
    "product_name",
    "category",
    "unit_price",
    "line_total",
    "days_since_signup",
    "order_month",
    "order_year",
)


#: A key is hot if it holds more rows than an even share of a shuffle partition.
HOT_TRACKED = 4096     # keys that the sketch keeps count of
HOT_KEYS = 256         # keys that can be joined apart
HOT_ROWS = 100_000     # dimension rows of hot keys that every task may be sent


def hot_keys(fact: DataFrame, key: str, parts: int | None = None, least: int = 0) -> list:
    """Keys on so many rows that one shuffle partition would hold too much.

    One pass with a bounded sketch of frequent items, merged over the tasks:
    a key on more than about 2 in :data:`HOT_TRACKED` rows is always in it.  ``parts``:
    the number of shuffle partitions; ``least``: rows that are few for a task.
    """
    parts = parts or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = fact.where(F.col(key).isNotNull()).agg(
        F.call_function("approx_top_k", F.col(key), F.lit(HOT_KEYS), F.lit(HOT_TRACKED))
        .alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] or ()
            if r["count"] * parts > found["n"] and r["count"] >= least]


def split_join(fact: DataFrame, dim: DataFrame, key: str, hot: Sequence) -> DataFrame:
    """Inner join on ``key``, with the rows of ``hot`` keys joined apart.

    Their few dimension rows go to every task, so these rows are not shuffled;
    all others meet in an ordinary join.  Which keys are called hot has no
    influence on the result.  Where a hot key stands on very many dimension
    rows (it should stand on one) everything is joined the ordinary way.
    """
    if not hot:
        return fact.join(dim, key, "inner")
    few = dim.where(F.col(key).isin(list(hot)))
    if few.limit(HOT_ROWS + 1).count() > HOT_ROWS:
        return fact.join(dim, key, "inner")
    is_hot = F.col(key).isin(list(hot))
    return fact.where(is_hot).join(F.broadcast(few), key, "inner").unionByName(
        fact.where(~is_hot).join(dim, key, "inner"))


def adapts(spark: SparkSession) -> bool:
    """Whether adaptive execution splits skewed joins in this session."""
    on = lambda name: spark.conf.get(name, "true").lower() == "true"
    return on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.skewJoin.enabled")


#: Estimated bytes of a dimension, up to which it goes to every task.
SMALL_BYTES = 1 << 27


def is_small(dim: DataFrame) -> bool:
    """Whether ``dim`` is small enough to be sent to every task, by its rows and
    the length of their strings (one narrow aggregate); never where the session
    broadcasts nothing."""
    limit = dim.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    if limit.startswith("-") or limit == "0":
        return False
    strings = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in dim.dtypes if t == "string"]
    row = F.lit(40 + 8 * len(dim.columns)).cast("bigint")
    return (dim.agg(F.sum(sum(strings, row))).first()[0] or 0) <= SMALL_BYTES


def orders_enriched(
    stg_orders: DataFrame,
    stg_customers: DataFrame,
    stg_products: DataFrame,
    widths: Widths = CONTRACT,
    split_hot: bool | None = None,
) -> DataFrame:
    """Orders joined to customers (J1) and products (J2) plus metrics.

    * ``line_total = quantity * unit_price`` exact, as decimal(10,2) (P4)
    * ``days_since_signup = order_date - signup_date`` in days (P5)
    * ``order_month``, ``order_year`` of the order date (P6)

    ``split_hot``: find the hot keys first and join them apart; by default where
    adaptive execution would not split a skewed join.

    No final sort: a table has no order, and sorting the fact would cost a
    full range shuffle of the largest dataset.  Sort at display time.
    """
    o = stg_orders.select("order_id", "order_date", "status", "quantity",
                          "customer_id", "product_id")
    c = stg_customers.select("customer_id", "customer_name", "email", "country",
                             "signup_date")
    p = stg_products.select("product_id", "product_name", "category", "unit_price")
    if split_hot is None:
        split_hot = not adapts(stg_orders.sparkSession)
    hot = {key: hot_keys(o.select(key), key) if split_hot else []
           for key in ("customer_id", "product_id")}
    joined = split_join(split_join(o, c, "customer_id", hot["customer_id"]),
                        p, "product_id", hot["product_id"])
    derived = {
        "line_total": (F.col("quantity") * F.col("unit_price")).cast(widths.line_total),
        "days_since_signup": day_diff("signup_date", "order_date"),
        "order_month": F.month("order_date").cast("int"),
        "order_year": F.year("order_date").cast("int"),
    }
    return joined.withColumns(derived).select(*ENRICHED_COLUMNS)


def build_mart(staged: dict[str, DataFrame], widths: Widths = CONTRACT,
               split_hot: bool | None = None) -> DataFrame:
    """``orders_enriched`` from the dict returned by ``staging.stage_all``."""
    return orders_enriched(staged["stg_orders"], staged["stg_customers"],
                           staged["stg_products"], widths, split_hot)


def clustered_mart(staged: dict[str, DataFrame], widths: Widths, buckets: int,
                   *keys: str) -> DataFrame | None:
    """:func:`build_mart` in ``buckets`` partitions by hash of ``keys``; None where
    a dimension is too large for every task.

    The narrow order lines are exchanged, and the joins that widen them then
    leave every row where it is.
    """
    dims = {t: staged[t] for t in ("stg_customers", "stg_products")}
    if not all(is_small(d) for d in dims.values()):
        return None
    placed = {"stg_orders": staged["stg_orders"].repartition(buckets, *keys),
              **{t: F.broadcast(d) for t, d in dims.items()}}
    return build_mart(placed, widths, split_hot=False)
