"""Randomised comparison of the rounding expressions with DuckDB's casts."""

from __future__ import annotations

import random
from decimal import Decimal

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.functions import decimal_avg, ratio_as_decimal

N = 20_000


def test_ratio_matches_duckdb(spark):
    rng = random.Random(7)
    rows = [(Decimal(rng.randint(1, 10**9)) / 100, rng.randint(1, 400)) for _ in range(N)]
    rows += [(Decimal("159.95"), 2), (Decimal("0.25"), 2), (Decimal("100.05"), 2)]
    df = spark.createDataFrame(rows, "s decimal(20,2), n bigint")
    got = {(r.s, r.n): r.v for r in df.select("s", "n", ratio_as_decimal(F.col("s"), F.col("n"))
                                               .alias("v")).collect()}
    tbl = pa.table({"s": pa.array([r[0] for r in rows], pa.decimal128(20, 2)),
                    "n": pa.array([r[1] for r in rows], pa.int64())})
    con = duckdb.connect()
    con.register("t", tbl)
    want = {(s, n): v for s, n, v in
            con.execute("SELECT s, n, (s / n)::decimal(10,2) FROM t").fetchall()}
    bad = [(k, got[k], want[k]) for k in want if got[k] != want[k]]
    assert not bad, bad[:5]


def test_decimal_avg_matches_duckdb(spark):
    rng = random.Random(11)
    rows = []
    for g in range(2_000):
        for _ in range(rng.randint(1, 12)):
            rows.append((g, Decimal(rng.randint(1, 10**6)) / 100))
    df = spark.createDataFrame(rows, "g int, p decimal(10,2)")
    got = {r.g: r.a for r in df.groupBy("g").agg(decimal_avg("p").alias("a")).collect()}
    tbl = pa.table({"g": pa.array([r[0] for r in rows], pa.int32()),
                    "p": pa.array([r[1] for r in rows], pa.decimal128(10, 2))})
    con = duckdb.connect()
    con.register("t", tbl)
    want = dict(con.execute("SELECT g, avg(p)::decimal(10,2) FROM t GROUP BY g").fetchall())
    bad = [(g, got[g], want[g]) for g in want if got[g] != want[g]]
    assert not bad, bad[:5]
