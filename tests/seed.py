"""The 8 customers / 8 products / 18 orders seed data set, as DataFrames.

Fixed values: the seed rows of the source system, in their original order.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.schemas import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS

D = dt.date.fromisoformat

# Seed customers (id, name, email, country, signup date).
CUSTOMERS = [
    (1, "Alice Johnson", "alice@example.com", "UK", D("2023-01-15")),
    (2, "Bob Smith", "bob@example.com", "US", D("2023-02-20")),
    (3, "Carol White", "carol@example.com", "UK", D("2023-03-10")),
    (4, "David Brown", "david@example.com", "DE", D("2023-04-05")),
    (5, "Eve Davis", "eve@example.com", "US", D("2023-05-22")),
    (6, "Frank Miller", "frank@example.com", "FR", D("2023-06-18")),
    (7, "Grace Lee", "grace@example.com", "UK", D("2023-07-30")),
    (8, "Henry Wilson", "henry@example.com", "DE", D("2023-08-14")),
]

# Seed products (id, name, category, unit price, stock).
PRODUCTS = [
    (101, "Wireless Headphones", "Electronics", Decimal("79.99"), 150),
    (102, "Running Shoes", "Footwear", Decimal("59.99"), 200),
    (103, "Coffee Maker", "Kitchen", Decimal("49.99"), 80),
    (104, "Yoga Mat", "Sports", Decimal("29.99"), 300),
    (105, "Mechanical Keyboard", "Electronics", Decimal("129.99"), 60),
    (106, "Water Bottle", "Sports", Decimal("19.99"), 500),
    (107, "Desk Lamp", "Home Office", Decimal("39.99"), 120),
    (108, "Backpack", "Accessories", Decimal("49.99"), 90),
]

# Seed orders (id, customer, product, quantity, date, status).
ORDERS = [
    (1001, 1, 101, 1, D("2024-01-10"), "completed"),
    (1002, 2, 102, 2, D("2024-01-12"), "completed"),
    (1003, 1, 105, 1, D("2024-01-15"), "completed"),
    (1004, 3, 103, 1, D("2024-01-20"), "completed"),
    (1005, 4, 104, 3, D("2024-02-01"), "completed"),
    (1006, 5, 106, 2, D("2024-02-05"), "completed"),
    (1007, 2, 107, 1, D("2024-02-10"), "completed"),
    (1008, 6, 101, 2, D("2024-02-14"), "completed"),
    (1009, 7, 108, 1, D("2024-02-20"), "completed"),
    (1010, 3, 102, 1, D("2024-02-25"), "shipped"),
    (1011, 8, 105, 2, D("2024-03-01"), "shipped"),
    (1012, 1, 106, 4, D("2024-03-05"), "shipped"),
    (1013, 5, 103, 1, D("2024-03-10"), "pending"),
    (1014, 4, 107, 2, D("2024-03-12"), "pending"),
    (1015, 6, 104, 1, D("2024-03-15"), "pending"),
    (1016, 7, 101, 1, D("2024-03-18"), "completed"),
    (1017, 8, 102, 3, D("2024-03-20"), "completed"),
    (1018, 2, 108, 2, D("2024-03-22"), "completed"),
]


def raw_seed(spark: SparkSession, customers=None, products=None, orders=None
             ) -> dict[str, DataFrame]:
    """The seed as raw tables (optionally with replaced rows)."""
    return {
        "customers": spark.createDataFrame(CUSTOMERS if customers is None else customers,
                                           RAW_CUSTOMERS),
        "products": spark.createDataFrame(PRODUCTS if products is None else products,
                                          RAW_PRODUCTS),
        "orders": spark.createDataFrame(ORDERS if orders is None else orders, RAW_ORDERS),
    }
