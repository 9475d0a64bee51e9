"""Staging layer (P1-P3): type casts and light cleaning, no business logic.

Staged tables are views: lazy DataFrames, or views of the session catalogue,
that Catalyst folds into whatever reads them; both come from the same SQL of
each column.  Casts follow the declared contract:

* ids, ``quantity``, ``stock_qty`` -> integer (half-to-even from fractions)
* ``signup_date``, ``order_date`` -> date
* ``unit_price`` -> decimal(10,2)
* ``email``, ``status`` lower case; ``country`` upper case
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import CONTRACT, Widths

PRICE_TYPE = "decimal(10,2)"


def to_int(raw: T.StructType, name: str, int_type: str) -> str:
    """``name::integer``: fractional inputs round half to even first."""
    if isinstance(raw[name].dataType, (T.DoubleType, T.FloatType)):
        return f"CAST(bround({name}, 0) AS {int_type})"
    return f"CAST({name} AS {int_type})"


def to_decimal(raw: T.StructType, name: str, dtype: str = PRICE_TYPE) -> str:
    """``name::decimal(p,s)``; doubles are rounded on their double value."""
    if isinstance(raw[name].dataType, (T.DoubleType, T.FloatType)):
        factor = f"1E{dtype[dtype.index(',') + 1:-1].strip()}D"
        return f"CAST(round(CAST({name} AS DOUBLE) * {factor}) / {factor} AS {dtype})"
    return f"CAST({name} AS {dtype})"


def staged_columns(model: str, raw: T.StructType, widths: Widths = CONTRACT) -> dict[str, str]:
    """SQL of every column of a staging model over its raw table."""
    if model == "stg_customers":     # P1
        return {
            "customer_id": to_int(raw, "customer_id", widths.ids),
            "customer_name": "customer_name",
            "email": "lower(email)",
            "country": "upper(country)",
            "signup_date": "CAST(signup_date AS DATE)",
        }
    if model == "stg_orders":        # P2
        return {
            "order_id": to_int(raw, "order_id", widths.ids),
            "customer_id": to_int(raw, "customer_id", widths.ids),
            "product_id": to_int(raw, "product_id", widths.ids),
            "quantity": to_int(raw, "quantity", widths.units),
            "order_date": "CAST(order_date AS DATE)",
            "status": "lower(status)",
        }
    return {                         # P3
        "product_id": to_int(raw, "product_id", widths.ids),
        "product_name": "product_name",
        "category": "category",
        "unit_price": to_decimal(raw, "unit_price"),
        "stock_qty": to_int(raw, "stock_qty", widths.units),
    }


# Each staging model and its raw table.
STAGED = {"stg_customers": "customers", "stg_orders": "orders", "stg_products": "products"}


def stage(model: str, raw: DataFrame, widths: Widths = CONTRACT) -> DataFrame:
    """A staging model as a lazy DataFrame."""
    return raw.select(*(F.expr(sql).alias(name)
                        for name, sql in staged_columns(model, raw.schema, widths).items()))


def stg_customers(raw: DataFrame, widths: Widths = CONTRACT) -> DataFrame:
    """Customers with lower-case email and upper-case country."""
    return stage("stg_customers", raw, widths)


def stg_orders(raw: DataFrame, widths: Widths = CONTRACT) -> DataFrame:
    """Order lines with integer keys, date and lower-case status."""
    return stage("stg_orders", raw, widths)


def stg_products(raw: DataFrame, widths: Widths = CONTRACT) -> DataFrame:
    """Products with a decimal(10,2) price and integer stock."""
    return stage("stg_products", raw, widths)


def view_sql(model: str, raw: DataFrame, source: str, widths: Widths = CONTRACT) -> str:
    """The same as a query over ``source`` (a table's name), for a view that stays."""
    columns = staged_columns(model, raw.schema, widths)
    chosen = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {chosen} FROM {source}"


def stage_all(raw: Mapping[str, DataFrame], widths: Widths = CONTRACT) -> dict[str, DataFrame]:
    """Stage the three raw tables; keys ``stg_customers`` etc."""
    return {model: stage(model, raw[table], widths) for model, table in STAGED.items()}
