"""File sinks, the versioned store, CSV/Parquet round trips."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from ledgerline.session import fresh_dir
from ledgerline.sinks.files import write_csv, write_parquet
from ledgerline.sinks.lakehouse import PublishedTables
from ledgerline.sources.files import file_profile, read_csv, read_parquet
from ledgerline.sources.schemas import RAW_PRODUCTS


def test_parquet_write_is_idempotent(spark, seed_models):
    m, _ = seed_models
    path = fresh_dir(spark, "t") + "/mart"
    assert write_parquet(m["orders_enriched"], path) == 18
    first = sorted(read_parquet(spark, path).collect())
    assert write_parquet(m["orders_enriched"], path) == 18
    assert sorted(read_parquet(spark, path).collect()) == first
    assert read_parquet(spark, path, columns=["order_id"]).columns == ["order_id"]


def test_empty_table_keeps_schema(spark):
    path = fresh_dir(spark, "t") + "/empty"
    df = spark.createDataFrame([], RAW_PRODUCTS)
    assert write_parquet(df, path) == 0
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.schema.fieldNames() == RAW_PRODUCTS.fieldNames()


def test_csv_round_trip_keeps_decimal(spark, seed_models):
    _, raw = seed_models
    path = fresh_dir(spark, "t") + "/products.csv"
    write_csv(raw["products"], path)
    back = read_csv(spark, path, RAW_PRODUCTS)
    assert dict(back.dtypes)["unit_price"] == "decimal(10,2)"
    assert sorted(back.collect()) == sorted(raw["products"].collect())


def test_file_profile(spark, seed_models):
    _, raw = seed_models
    d = fresh_dir(spark, "t")
    for name, df in raw.items():
        write_parquet(df, os.path.join(d, f"{name}.parquet"))
    prof = {r.table_name: (r.row_count, r.column_count)
            for r in file_profile(spark, {n: os.path.join(d, f"{n}.parquet") for n in raw}).collect()}
    assert prof == {"customers": (8, 5), "products": (8, 5), "orders": (18, 6)}


def test_snapshots_history_and_time_travel(spark):
    store = PublishedTables(spark, fresh_dir(spark, "wh"))
    assert not store.exists("t")
    v1 = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    v2 = spark.createDataFrame([(3, "c")], "id int, v string")
    c1 = store.publish("t", v1)
    c2 = store.publish("t", v2)
    assert (c1["snapshot_id"], c2["snapshot_id"]) == (1, 2)
    assert store.exists("t")
    assert sorted(store.read("t").collect()) == sorted(v2.collect())
    assert sorted(store.read("t", snapshot_id=1).collect()) == sorted(v1.collect())
    assert sorted(store.read("t", as_of=c1["committed_at"]).collect()) == sorted(v1.collect())
    with pytest.raises(LookupError):
        store.read("t", as_of=c1["committed_at"] - dt.timedelta(days=1))
    hist = [(r.snapshot_id, r.added_records, r.total_records, r.operation)
            for r in store.history("t").collect()]
    assert hist == [(1, 2, 2, "overwrite"), (2, 1, 1, "overwrite")]
    assert [r.parent_id for r in store.history("t").collect()] == [None, 1]
    tables = {r.table_name: (r.snapshot_id, r.total_records, r.column_count)
              for r in store.tables().collect()}
    assert tables == {"t": (2, 1, 2)}
    sch = [(r.position, r.column_name, r.data_type, r.null_rows)
           for r in store.schema("t").collect()]
    assert sch == [(1, "id", "int", 0), (2, "v", "string", 0)]


def test_uncommitted_write_is_invisible(spark):
    root = fresh_dir(spark, "wh")
    store = PublishedTables(spark, root)
    store.publish("t", spark.createDataFrame([(1,)], "id int"))
    # A crashed writer leaves what it wrote aside.
    write_parquet(spark.createDataFrame([(9,), (9,)], "id int"),
                  os.path.join(root, "default", "_incoming", "lost"))
    assert [r.id for r in store.read("t").collect()] == [1]
    assert store.table_names() == ["t"]
    store.publish("t", spark.createDataFrame([(5,)], "id int"))
    assert [r.id for r in store.read("t").collect()] == [5]
    assert store.versions("t")[-1][0] == 2


def test_versions_are_found_again_without_a_catalogue(spark):
    """Another session knows the folders only; an empty version counts as one."""
    root = fresh_dir(spark, "wh")
    store = PublishedTables(spark, root, database="first_session")
    store.publish("t", spark.createDataFrame([], "id int, v string"))
    store.publish("t", spark.createDataFrame([(1, None)], "id int, v string"))
    store.publish("t", spark.createDataFrame([], "id int, v string"))
    other = PublishedTables(spark, root, database="second_session")
    assert other.table_names() == ["t"] and not other.exists("u")
    assert [r.total_records for r in other.history("t").collect()] == [0, 1, 0]
    assert other.read("t").count() == 0 and other.read("t", snapshot_id=2).first().id == 1
    assert [r.null_rows for r in other.schema("t", 2).collect()] == [0, 1]
    assert other.tables().first().total_records == 0
    with pytest.raises(ValueError, match="differ"):
        other.publish("t", spark.createDataFrame([(1,)], "id int"))
    with pytest.raises(ValueError, match="named as"):
        other.publish("u", spark.createDataFrame([(1,)], "snapshot_id int"))


def test_a_version_reads_its_folder_only(spark):
    from conftest import plan_text

    store = PublishedTables(spark, fresh_dir(spark, "wh"))
    for i in range(3):
        store.publish("t", spark.range(i + 1))
    plan = plan_text(store.read("t", snapshot_id=2))
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan
    assert store.read("t", snapshot_id=2).count() == 2


def test_two_roots_do_not_mix(spark):
    a, b = (PublishedTables(spark, fresh_dir(spark, "wh")) for _ in "ab")
    a.publish("t", spark.range(1))
    b.publish("t", spark.range(2))
    assert a.read("t").count() == 1 and b.read("t").count() == 2
    a.publish("t", spark.range(3))
    assert (a.versions("t")[-1][0], b.versions("t")[-1][0]) == (2, 1)


def test_replace_restores_what_an_interrupted_one_left(spark):
    from ledgerline.sinks.files import replace_path, restore_path

    d = fresh_dir(spark, "swap")
    write_parquet(spark.range(1), f"{d}/t")
    os.rename(f"{d}/t", f"{d}/t.old")            # a driver lost between the two moves
    assert restore_path(spark, f"{d}/t") and spark.read.parquet(f"{d}/t").count() == 1
    os.rename(f"{d}/t", f"{d}/t.old")
    write_parquet(spark.range(2), f"{d}/new")
    replace_path(spark, f"{d}/new", f"{d}/t")
    assert spark.read.parquet(f"{d}/t").count() == 2 and os.listdir(d) == ["t"]


def test_publish_all_reports_each_table(spark, seed_models):
    m, _ = seed_models
    store = PublishedTables(spark, fresh_dir(spark, "wh"))
    rep = {r.table_name: (r.written_rows, r.verified_rows, r.status)
           for r in store.publish_all({"orders_enriched": m["orders_enriched"],
                                       "rpt_customer_summary": m["rpt_customer_summary"]}).collect()}
    assert rep == {"orders_enriched": (18, 18, "ok"), "rpt_customer_summary": (8, 8, "ok")}


def test_history_times_come_from_epoch_millis(spark):
    store = PublishedTables(spark, fresh_dir(spark, "wh"))
    c = store.publish("t", spark.createDataFrame([(1,)], "id int"))
    row = store.history("t").collect()[0]
    assert dict(store.history("t").dtypes)["committed_at"] == "timestamp"
    got = row.committed_at.replace(tzinfo=dt.timezone.utc) if row.committed_at.tzinfo is None \
        else row.committed_at
    assert abs((got - c["committed_at"]).total_seconds()) < 1.0


def test_counts_match_between_stores(spark):
    from ledgerline.operators.quality import counts_match

    a = {"x": spark.range(3), "y": spark.range(2)}
    b = {"x": spark.range(3), "y": spark.range(5), "z": spark.range(1)}
    got = {r.table_name: (r.left_rows, r.right_rows, r.matched)
           for r in counts_match(a, b).collect()}
    assert got == {"x": (3, 3, True), "y": (2, 5, False), "z": (None, 1, False)}


def test_models_as_sql_views(spark, seed_models):
    from ledgerline.plans.models import register_views

    m, _ = seed_models
    register_views(m, ["rpt_revenue_by_category"])
    got = spark.sql("SELECT category, total_revenue FROM rpt_revenue_by_category "
                    "ORDER BY total_revenue DESC LIMIT 1").collect()[0]
    assert got.category == "Electronics"


def test_concurrent_actions_return_results_and_errors_by_name(spark):
    from ledgerline.session import run_concurrently

    def boom():
        raise ValueError("no such table")

    out = run_concurrently({
        "a": lambda: spark.range(1000).count(),
        "b": lambda: spark.range(10).where("id % 2 = 0").count(),
        "c": boom,
    })
    assert out["a"] == 1000 and out["b"] == 5
    assert isinstance(out["c"], ValueError)
    assert run_concurrently({}) == {}


def test_publish_all_isolates_a_failing_table(spark):
    from pyspark.sql import functions as F

    store = PublishedTables(spark, fresh_dir(spark, "wh"))
    good = spark.createDataFrame([(1,), (2,)], "id int")
    bad = spark.range(3).select(F.lit("not a number").cast("int").alias("id"))  # fails when run
    rep = {r.table_name: r.status for r in store.publish_all({"good": good, "bad": bad}).collect()}
    assert rep["good"] == "ok" and rep["bad"].startswith("failed")
    assert store.exists("good") and not store.exists("bad")
    assert sorted(r.id for r in store.read("good").collect()) == [1, 2]


class _StubContext:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self._checkpoint = checkpoint
        self.set_to = None

    def getCheckpointDir(self):
        return self._checkpoint

    def setCheckpointDir(self, path):
        self.set_to = path


class _StubSession:
    def __init__(self, master, conf=None, checkpoint=None):
        self.sparkContext = _StubContext(master, checkpoint)
        self.conf = type("Conf", (), {"get": lambda _self, k, d=None: (conf or {}).get(k, d)})()


def test_shared_dir_uses_the_cluster_setting_and_never_a_local_folder_on_a_cluster():
    from ledgerline.session import shared_dir

    on_cluster = _StubSession("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared"},
                              checkpoint="hdfs://nn/shared/abc")
    assert shared_dir(on_cluster, "runs") == "hdfs://nn/shared/runs"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_StubSession("spark://master:7077"))
    local = _StubSession("local[4]")
    root = shared_dir(local)
    assert local.sparkContext.set_to == root and os.path.isdir(root)
