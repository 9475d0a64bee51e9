"""Edge inputs: empty tables, orphans, NULL sort keys, mixed case, casts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from seed import CUSTOMERS, ORDERS, raw_seed

from ledgerline.functions import WIDE, as_int, decimal_avg, ratio_as_decimal
from ledgerline.operators import reports
from ledgerline.plans.models import model_graph


def test_empty_inputs_flow_through_every_model(spark):
    m = model_graph(raw_seed(spark, [], [], []))
    for name, df in m.items():
        assert df.count() == 0, name
    assert m["rpt_revenue_by_category"].columns[0] == "category"


def test_orphans_and_unordered_entities_are_dropped(spark):
    orders = ORDERS + [(2001, 42, 101, 1, dt.date(2024, 4, 1), "completed")]
    customers = CUSTOMERS + [(9, "No Orders", "n@o.x", "it", dt.date(2023, 1, 1))]
    m = model_graph(raw_seed(spark, customers, None, orders))
    assert m["orders_enriched"].count() == 18
    ids = {r.customer_id for r in m["rpt_customer_summary"].collect()}
    assert 9 not in ids and 42 not in ids


def test_mixed_case_cleaning(spark):
    customers = [(1, "A", "MiXeD@Example.COM", "uk", dt.date(2023, 1, 1))]
    orders = [(1, 1, 101, 1, dt.date(2024, 1, 1), "COMPLETED")]
    m = model_graph(raw_seed(spark, customers, None, orders))
    r = m["orders_enriched"].collect()[0]
    assert (r.email, r.country, r.status) == ("mixed@example.com", "UK", "completed")


def test_null_sort_keys_last(spark):
    df = spark.createDataFrame([(None, 2024, 1), ("DE", 2024, 1), ("AT", None, 1)],
                               "country string, year int, month int")
    got = [tuple(r) for r in reports.ordered("rpt_revenue_by_country", df).collect()]
    assert got == [("DE", 2024, 1), (None, 2024, 1), ("AT", None, 1)]


def test_as_int_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (3.5,), (-1.5,), (2.0,)], "x double")
    assert [r[0] for r in df.select(as_int("x")).collect()] == [2, 2, 4, -2, 2]


def test_ratio_rounds_on_the_double(spark):
    df = spark.createDataFrame([(Decimal("159.95"), 2), (Decimal("0.25"), 2),
                                (Decimal("2.675"), 1)], "s decimal(12,3), n bigint")
    got = [r[0] for r in df.select(ratio_as_decimal(df.s, df.n)).collect()]
    assert got == [Decimal("79.97"), Decimal("0.13"), Decimal("2.68")]


def test_decimal_avg_ignores_nulls(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),), (None,)],
                               "p decimal(10,2)")
    assert df.agg(decimal_avg("p")).collect()[0][0] == Decimal("0.02")
    assert df.where("p is null").agg(decimal_avg("p")).collect()[0][0] is None


def test_fractional_raw_quantity_rounds_like_the_contract(spark):
    from ledgerline.operators.staging import stg_orders

    raw = spark.createDataFrame([(1.0, 1.0, 1.0, 2.5, dt.datetime(2024, 1, 1, 13, 0), "P")],
                                "order_id double, customer_id double, product_id double, "
                                "quantity double, order_date timestamp_ntz, status string")
    r = stg_orders(raw).collect()[0]
    assert (r.order_id, r.quantity, r.order_date, r.status) == (1, 2, dt.date(2024, 1, 1), "p")


def test_widths_can_be_widened(spark):
    m = model_graph(raw_seed(spark), WIDE)
    types = dict(m["rpt_customer_summary"].dtypes)
    assert (types["customer_id"], types["total_spend"], types["total_units"]) == (
        "bigint", "decimal(28,2)", "bigint")
    assert dict(m["rpt_product_performance"].dtypes)["original_stock_estimate"] == "bigint"
    base = {r.customer_id: r.total_spend for r in model_graph(raw_seed(spark))
            ["rpt_customer_summary"].collect()}
    assert {r.customer_id: r.total_spend for r in m["rpt_customer_summary"].collect()} == base
