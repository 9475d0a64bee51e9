"""Schemas of the three raw source tables and the staged layer.

Raw tables are what extraction writes (every field nullable); staged tables
carry the declared types.  Passing a schema to a file read avoids inference,
which would for instance read ``unit_price`` from CSV as a double.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("signup_date", T.DateType()),
    ]
)

RAW_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("stock_qty", T.LongType()),
    ]
)

RAW_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("status", T.StringType()),
    ]
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": RAW_CUSTOMERS,
    "products": RAW_PRODUCTS,
    "orders": RAW_ORDERS,
}

# Columns each raw table must provide (extra columns are allowed).
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    name: tuple(schema.fieldNames()) for name, schema in RAW_SCHEMAS.items()
}
