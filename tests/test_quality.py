"""Every data-quality check on a passing input and on a planted failure."""

from __future__ import annotations

from decimal import Decimal

import pytest
from seed import CUSTOMERS, ORDERS, PRODUCTS, raw_seed

from ledgerline.operators import quality
from ledgerline.plans.models import model_graph
from ledgerline.session import fresh_dir
from ledgerline.sinks.lakehouse import PublishedTables
from ledgerline.sources.schemas import REQUIRED_COLUMNS


def counts(df):
    return {(r.check_name, r.table_name, r.column_name): r.failing_rows for r in df.collect()}


def test_seed_passes_whole_suite(seed_models):
    m, raw = seed_models
    res = counts(quality.suite(m, raw))
    assert len(res) == 3 + 22 + 7 + 6 + 3 + 5
    assert all(v == 0 for v in res.values()), {k: v for k, v in res.items() if v}
    quality.gate(quality.suite(m, raw))


def test_planted_failures(spark):
    customers = CUSTOMERS + [(1, "Dup Alice", "x@y.z", "UK", None), (None, "No Id", None, None, None)]
    products = PRODUCTS + [(109, "Free Thing", "Misc", Decimal("0.00"), 1),
                           (110, "Unpriced", "Misc", None, 1)]
    orders = ORDERS + [(1019, 99, 101, 1, None, "completed"),    # unknown customer
                       (1020, 1, 999, 1, None, "completed"),     # unknown product
                       (1020, 1, 101, 1, None, "completed"),     # duplicate order id
                       (None, 1, 101, 1, None, "completed")]     # NULL order id
    raw = raw_seed(spark, customers, products, orders)
    m = model_graph(raw)
    res = counts(quality.suite(m, raw))
    assert res[("not_null", "customers", "customer_id")] == 1
    assert res[("not_null", "stg_orders", "order_id")] == 1
    # the NULL-id order joins customer 1, which is planted twice
    assert res[("not_null", "orders_enriched", "order_id")] == 2
    assert res[("unique", "stg_customers", "customer_id")] == 1
    assert res[("unique", "stg_orders", "order_id")] == 1
    assert res[("positive", "products", "unit_price")] == 1          # NULL ignored
    assert res[("orphan:stg_customers", "stg_orders", "customer_id")] == 1
    assert res[("orphan:stg_products", "stg_orders", "product_id")] == 1
    assert res[("fk_not_null", "orders_enriched", "customer_id|product_id")] == 0
    with pytest.raises(quality.DataQualityError):
        quality.gate(quality.suite(m, raw))


def test_lost_lines_are_counted(spark, seed_models):
    m, raw = seed_models
    lines = spark.createDataFrame([(1001,), (1002,), (5,), (5,), (None,)], "order_id bigint")
    raw = {**raw, "order_lines": lines, "order_headers": raw["orders"].select("order_id")}
    res = counts(quality.suite(m, raw, raw_keys=[("order_lines", "order_id")]))
    assert res[("not_null", "order_lines", "order_id")] == 1
    assert res[("orphan:order_headers", "order_lines", "order_id")] == 2


def test_gate_raises_on_columns_counts_and_stores(spark, seed_models):
    m, raw = seed_models
    lost = {**raw, "orders": raw["orders"].drop("status")}
    assert counts(quality.suite(m, lost))[("required_columns", "orders", "*")] == 1
    few = quality.suite(m, raw, minimum={"orders_enriched": 20}, exact={"stg_products": 9})
    res = counts(few)
    assert res[("min_rows", "orders_enriched", "*")] == 2
    assert res[("exact_rows", "stg_products", "*")] == 1

    store = PublishedTables(spark, fresh_dir(spark, "w"))
    names = ("rpt_customer_summary", "rpt_revenue_by_category")
    store.publish("rpt_customer_summary", m["rpt_customer_summary"].limit(6))
    stored = quality.suite(m, raw, store=store, published=names)
    res = counts(stored)
    assert res[("table_exists", "rpt_revenue_by_category", "*")] == 1
    assert res[("table_exists", "rpt_customer_summary", "*")] == 0
    assert res[("store_rows", "rpt_customer_summary", "*")] == 2
    for bad in (quality.suite(m, lost), few, stored):
        with pytest.raises(quality.DataQualityError):
            quality.gate(bad)


def test_positive_null_handling(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (-2.0,)], "x double")
    got = counts(quality.column_checks({"t": df}, None, [("t", "x")],
                                       [("t", "x", True), ("t", "x", False)]))
    assert got == {("positive_not_null", "t", "x"): 3, ("positive", "t", "x"): 2,
                   ("not_null", "t", "x"): 1}


def test_orphans_of_keys_that_are_no_integers(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("c",)], "k string")
    assert counts(quality.orphans(fact, dim, "k", "f", "d"))[("orphan:d", "f", "k")] == 2


def test_orphans_count_rows_not_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert counts(quality.orphans(fact, dim, "k", "f", "d"))[("orphan:d", "f", "k")] == 3


def test_gate_allow_list(spark):
    df = spark.createDataFrame([("unique", "t", "c", 3)], "check_name string, table_name string, "
                               "column_name string, failing_rows bigint")
    with pytest.raises(quality.DataQualityError):
        quality.gate(df)
    assert quality.gate(df, allow=[("unique", "t", "c")]) == []


def test_row_counts_and_required_columns(seed_models, spark):
    m, raw = seed_models
    rc = {r.table_name: (r.row_count, r.passed)
          for r in quality.row_counts(m, exact={"orders_enriched": 18}).collect()}
    assert rc["orders_enriched"] == (18, True)
    assert rc["rpt_customer_summary"] == (8, True)
    for name, cols in REQUIRED_COLUMNS.items():
        assert quality.required_columns(raw[name], name, cols) == []
    assert quality.required_columns(raw["orders"].drop("status"), "orders",
                                    REQUIRED_COLUMNS["orders"]) == ["status"]
