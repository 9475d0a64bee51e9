"""Key sets of 64-bit words: exact counts and unions, rows whose key is missing."""

from __future__ import annotations

import random

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from ledgerline.operators import keysets

KEYS = [None, 0, 1, 63, 64, 65, -1, -64, -65, 2**31 - 1, 2**62, -2**63, 2**63 - 1, 7, 7, 7]


def test_sets_hold_any_integer(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k bigint")
    found = keysets.key_set(df, "k")
    assert keysets.size(found, "n").first().n == len({k for k in KEYS if k is not None})
    back = sorted(r.word * 64 + i for r in found.collect() for i in range(64)
                  if (r.bits >> i) & 1)
    assert back == sorted({k for k in KEYS if k is not None})
    assert keysets.size(keysets.key_set(df.limit(0), "k"), "n").first().n == 0


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_merging_counts_a_key_once(spark, kind):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(3), rng.randrange(-100, 100)) for _ in range(800)]
    df = spark.createDataFrame(rows, "g string, h int, k int").withColumn("k", F.col("k").cast(kind))
    sets = keysets.key_set(df, "k", "g", "h")
    by_g = {r.g: r.n for r in keysets.size(keysets.merged(sets, "g"), "n", "g").collect()}
    assert by_g == {g: len({k for a, _, k in rows if a == g}) for g in "ab"}
    assert keysets.size(keysets.merged(sets), "n").first().n == len({k for *_, k in rows})


@pytest.mark.parametrize("broadcast_words", [keysets.BROADCAST_WORDS, 0])
def test_missing_rows(spark, broadcast_words):
    rng = random.Random(2)
    known = {rng.randrange(-500, 5000) for _ in range(900)}
    rows = [(rng.choice([None, rng.randrange(-600, 5200)]), i) for i in range(3000)]
    rows += [(99_999, i) for i in range(1000)]        # one missing key on many rows
    fact = spark.createDataFrame(rows, "k int, line int")
    dim = spark.createDataFrame([(k,) for k in known], "k bigint")
    lost = keysets.missing(fact, "k", keysets.key_set(dim, "k"), broadcast_words)
    assert lost.columns == ["k", "line"]
    assert sorted(r.line for r in lost.collect()) == sorted(
        line for k, line in rows if k is not None and k not in known)
    assert keysets.missing(fact, "k", keysets.key_set(dim.limit(0), "k"),
                           broadcast_words).count() == fact.where("k is not null").count()


def test_looking_keys_up_shuffles_no_fact_row(spark):
    fact = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    known = keysets.key_set(spark.range(990).select(F.col("id").alias("k")), "k")
    plan = plan_text(keysets.missing(fact, "k", known), "simple")
    assert "BroadcastHashJoin" in plan
    assert all("word" in ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln)
    # Beyond the bound, the only exchanges of the fact's keys are words with their bits.
    plan = plan_text(keysets.missing(fact.select("k"), "k", known, 0), "simple")
    assert "hashpartitioning(k#" not in plan


def test_orphans_of_a_build_are_found_without_the_fact_keys_in_a_shuffle(spark):
    from conftest import SF_SMALL

    from ledgerline.plans.queries import QUERIES

    plan = plan_text(QUERIES["dq_orphans"](spark, SF_SMALL), "simple")
    assert "LeftAnti" not in plan
    for key in ("order_id", "customer_id", "product_id"):
        assert f"hashpartitioning({key}#" not in plan
