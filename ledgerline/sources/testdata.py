"""Map the TPC-H-style test tables onto the three raw source tables.

=====================  ==================================================
raw column             derived from
=====================  ==================================================
orders.order_id        lineitem.l_orderkey (the fact grain is a line)
orders.customer_id     orders.o_custkey (joined on the order key)
orders.product_id      lineitem.l_partkey
orders.quantity        lineitem.l_quantity
orders.order_date      orders.o_orderdate
orders.status          orders.o_orderstatus
customers.*            customer.c_custkey, c_name, nation.n_name
customers.email        c_name || '@Example.com' (mixed case on purpose)
customers.signup_date  the customer's first o_orderdate
products.*             part.p_partkey, p_name, p_type, p_retailprice, p_size
=====================  ==================================================

All but :func:`raw_customers`, which writes its table, return lazy DataFrames;
Catalyst prunes the scans to the columns used and pushes the join keys'
not-null filters into them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import fresh_dir
from ledgerline.sinks.files import write_parquet

# Fixed value: suffix that turns a customer name into an e-mail address.
EMAIL_DOMAIN = "@Example.com"


# Declared schemas of the test tables this module reads: a read with a
# schema skips the footer-inference job Spark otherwise runs per table.
TEST_SCHEMAS: dict[str, str] = {
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
               "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string"),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


#: The test tables that the three raw tables come from.
SOURCE_TABLES = ("customer", "lineitem", "nation", "orders", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table by name (``<sf_dir>/<name>.parquet``)."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    reader = spark.read.schema(TEST_SCHEMAS[name]) if name in TEST_SCHEMAS else spark.read
    return reader.parquet(path)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stored, before they meet their headers."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers: key, customer, date and status."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines joined to their headers.

    Both sides are large; the join shuffles both on the order key (sort-merge),
    or AQE turns it into a broadcast when the header side measures small.
    Lines without a header drop out here; the data tests count them.
    """
    return order_lines(spark, sf_dir).join(
        order_headers(spark, sf_dir), "order_id", "inner").select(
        "order_id", "customer_id", "product_id", "quantity", "order_date", "status"
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with country (nation name) and signup date (first order).

    Written once to the shared folder: the fact join then reads the customers
    through an exchange of its own, so that a hot customer's lines can be
    split.  Straight from the first-order join, the customer side would keep
    that join's partitioning and could not be.
    """
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    first_order = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.min("o_orderdate").alias("signup_date"))
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.col("c_name"), F.lit(EMAIL_DOMAIN)).alias("email"),
        "c_nationkey",
    )
    built = (
        customers.join(nation, "c_nationkey", "left")
        .join(first_order, "customer_id", "left")
        .select("customer_id", "customer_name", "email", "country", "signup_date")
    )
    path = fresh_dir(spark, "customers")
    write_parquet(built, path)
    return spark.read.schema(built.schema).parquet(path)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from ``part``; ``p_size`` stands in for the stock level."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("p_size").alias("stock_qty"),
    )


def products_sql(sf_dir: str) -> str:
    """The same as a query over the file, for a view that stays."""
    path = os.path.join(sf_dir, "part.parquet")
    return ("SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, "
            f"p_retailprice AS unit_price, p_size AS stock_qty FROM parquet.`{path}`")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw tables keyed ``customers``, ``products``, ``orders``."""
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
    }
