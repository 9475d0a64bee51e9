"""A customer holding a third of all order lines: same results, split joins."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, plan_text
from pyspark.sql import functions as F

from ledgerline.functions import CONTRACT, WIDE, Widths
from ledgerline.plans.models import model_graph
from ledgerline.session import input_bytes, size_shuffle_partitions
from ledgerline.sources import testdata

HOT = 7

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_raw(spark):
    raw = testdata.raw_tables(spark, SF_SMALL)
    orders = raw["orders"].withColumn(
        "customer_id",
        F.when(F.abs(F.hash("order_id")) % 3 == 0, F.lit(HOT)).otherwise(F.col("customer_id")))
    return {**raw, "orders": orders}


def summary(spark, aqe: bool, widths: Widths):
    spark.conf.set("spark.sql.adaptive.enabled", str(aqe).lower())
    try:
        df = model_graph(skewed_raw(spark), widths)["rpt_customer_summary"]
        return sorted(tuple(r) for r in df.collect()), df
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("widths", [CONTRACT, WIDE], ids=["int", "bigint"])
def test_hot_customer_results_match_and_join_is_split(spark, skew_conf, widths):
    plain, _ = summary(spark, False, widths)
    handled, df = summary(spark, True, widths)
    assert handled == plain
    hot = [r for r in handled if r[0] == HOT][0]
    mart = model_graph(skewed_raw(spark), widths)["orders_enriched"]
    assert mart.where(F.col("customer_id") == HOT).count() * 3 >= mart.count() * 0.9
    assert hot[4] > 0
    df.collect()
    final = plan_text(df, "simple").split("== Initial Plan ==")[0]
    split = [ln for ln in final.splitlines() if "SortMergeJoin(skew=true) [customer_id" in ln]
    assert split, final


def test_hot_customer_is_joined_apart_without_adaptive_execution(spark, skew_conf):
    """The hot customer's lines meet a broadcast of its one row; all others are merged."""
    from ledgerline.operators import marts

    raw = skewed_raw(spark)
    lazy = model_graph(raw, CONTRACT)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert marts.hot_keys(lazy["stg_orders"], "customer_id", 8) == [HOT]
        mart = model_graph(raw, CONTRACT)["orders_enriched"]
        plan = plan_text(mart, "simple")
        assert "Union" in plan and "BroadcastHashJoin [customer_id" in plan
        assert "SortMergeJoin [customer_id" in plan
        got = sorted(map(str, mart.collect()))
        whole = marts.orders_enriched(lazy["stg_orders"], lazy["stg_customers"],
                                      lazy["stg_products"], split_hot=False)
        assert "Union" not in plan_text(whole, "simple")
        assert got == sorted(map(str, whole.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_split_join_equals_a_join(spark, monkeypatch):
    from ledgerline.operators import marts

    fact = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0), (None, 1), (9, 2)],
                                 "k int, v int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, w string")
    want = sorted(map(str, fact.join(dim, "k").collect()))
    for hot in ([], [1], [1, 2], [77]):
        assert sorted(map(str, marts.split_join(fact, dim, "k", hot).collect())) == want
    monkeypatch.setattr(marts, "HOT_ROWS", 1)     # a hot key on many dimension rows
    plain = marts.split_join(fact, dim, "k", [1])
    assert "Union" not in plan_text(plain, "simple")
    assert sorted(map(str, plain.collect())) == want
    assert marts.hot_keys(fact.limit(0), "k", 8) == []


def test_shuffle_partitions_follow_input_size(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = size_shuffle_partitions(spark, 10 * 1024**4)  # 10 TiB
        assert n == 10 * 1024**4 // (64 * 1024**2)   # no upper bound
        small = size_shuffle_partitions(spark, input_bytes(spark, SF_SMALL))
        assert small == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_hot_order_in_the_line_join_is_split(spark, skew_conf, tmp_path):
    """One order key on a third of all lines: the line/order join splits it."""
    from ledgerline.plans.models import model_graph

    src = str(tmp_path)
    hot = spark.read.parquet(f"{SF_SMALL}/orders.parquet").agg(F.min("o_orderkey")).first()[0]
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    lines.withColumn(
        "l_orderkey",
        F.when(F.abs(F.hash("l_orderkey", "l_linenumber", "l_partkey")) % 3 == 0,
               F.lit(hot).cast("bigint")).otherwise(F.col("l_orderkey")),
    ).repartition(8).write.parquet(f"{src}/lineitem.parquet")
    # Several files, as in any real deployment: AQE splits a skewed reducer
    # partition along map-output boundaries, so it needs more than one mapper.
    for t in ("orders", "customer", "part", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{src}/{t}.parquet")

    def country_report(aqe: bool):
        spark.conf.set("spark.sql.adaptive.enabled", str(aqe).lower())
        try:
            df = model_graph(testdata.raw_tables(spark, src))["rpt_revenue_by_country"]
            return sorted(tuple(r) for r in df.collect()), df
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")

    plain, _ = country_report(aqe=False)
    handled, df = country_report(aqe=True)
    assert handled == plain
    joined = model_graph(testdata.raw_tables(spark, src))["orders_enriched"]
    share = joined.where(F.col("order_id") == hot).count()
    assert share * 3 >= joined.count() * 0.9
    final = plan_text(df, "simple").split("== Initial Plan ==")[0]
    split = [ln for ln in final.splitlines() if "SortMergeJoin" in ln and "order_id" in ln]
    assert split and all("skew=true" in ln for ln in split), split


def test_a_hot_order_keeps_the_mart_from_being_clustered(spark):
    """Its bucket would be one long task: rows equal, no bucket, no folder of it alone."""
    from ledgerline.plans import jobs
    from ledgerline.session import fresh_dir

    raw = testdata.raw_tables(spark, SF_SMALL)
    hot = raw["orders"].withColumn("order_id", F.when(
        F.abs(F.hash("order_id", "product_id")) % 3 == 0, F.lit(1)).otherwise(F.col("order_id")))
    raw = {**raw, "orders": hot}
    split = jobs.build_models(spark, raw, fresh_dir(spark, "m"), widths=WIDE, database="hot_order",
                              hot_order_rows=500)
    whole = jobs.build_models(spark, raw, fresh_dir(spark, "m"), widths=WIDE, database="long_bucket")
    plan = lambda m: plan_text(m["orders_enriched"].groupBy("order_id").count(), "simple")
    assert "Bucketed: true" not in plan(split) and "Bucketed: true" in plan(whole)
    for name in ("orders_enriched", "rpt_revenue_by_country", "rpt_customer_summary"):
        assert sorted(map(str, split[name].collect())) == sorted(map(str, whole[name].collect()))
