"""The mart is placed by its narrow lines, and products are added up once."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import plan_text

from ledgerline.functions import WIDE
from ledgerline.operators import marts, reports

DAY = dt.date(2024, 1, 5)


@pytest.fixture(scope="module")
def staged(spark):
    orders = [(i % 40 if i % 41 else None, i % 7, i % 11, i % 5, DAY, "open") for i in range(400)]
    customers = [(i, f"n{i}", f"e{i}", "X", DAY) for i in (*range(6), 3)]       # 3 twice
    products = [(i, f"p{i % 4}", f"c{i % 3}" if i % 5 else None,
                 None if i == 2 else Decimal(f"{i}.25"), 5) for i in (*range(10), 4)]
    return {
        "stg_orders": spark.createDataFrame(
            orders, "order_id long, customer_id long, product_id long, quantity long, "
                    "order_date date, status string"),
        "stg_customers": spark.createDataFrame(
            customers, "customer_id long, customer_name string, email string, country string, "
                       "signup_date date"),
        "stg_products": spark.createDataFrame(
            products, "product_id long, product_name string, category string, "
                      "unit_price decimal(10,2), stock_qty long"),
    }


def ordered(df):
    return sorted(map(str, df.collect()))


def test_lines_are_exchanged_before_the_joins_widen_them(spark, staged):
    mart = marts.clustered_mart(staged, WIDE, 3, "order_id")
    plan = plan_text(mart, "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.rindex("BroadcastHashJoin") < plan.index("Exchange hashpartitioning(order_id")
    assert ordered(mart) == ordered(marts.build_mart(staged, WIDE))
    assert mart.rdd.getNumPartitions() == 3


def test_large_dimensions_are_not_sent_to_every_task(spark, staged, monkeypatch):
    monkeypatch.setattr(marts, "SMALL_BYTES", 100)
    assert marts.clustered_mart(staged, WIDE, 3, "order_id") is None


def test_no_dimension_is_small_where_nothing_is_broadcast(spark, staged):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not marts.is_small(staged["stg_customers"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert marts.is_small(staged["stg_customers"].limit(0))


def test_reports_from_product_sales(spark, staged, tmp_path):
    mart = marts.build_mart(staged, WIDE)
    sales = reports.product_sales(mart)
    sales.write.parquet(str(tmp_path / "sales"))
    read = spark.read.schema(sales.schema).parquet(str(tmp_path / "sales"))
    once = reports.build_reports(mart, staged["stg_products"], WIDE, read)
    direct = reports.build_reports(mart, staged["stg_products"], WIDE)
    for name in ("rpt_revenue_by_category", "rpt_product_performance"):
        assert ordered(once[name]) == ordered(direct[name])
        assert once[name].dtypes == direct[name].dtypes
        assert "order_id" not in plan_text(once["rpt_product_performance"], "simple")
