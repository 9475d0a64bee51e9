"""Connected components of a link table, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import any_row, cut, discard, rekeyed


def _with_minimum(edges: DataFrame) -> DataFrame:
    """(x, y, m): each edge with the smallest neighbour of its ``x``.

    The minimum is joined under a hashed key, so a node with a large share of
    the edges arrives through an exchange that can be split.
    """
    least = edges.groupBy("x").agg(F.min("y").alias("m")).select(
        rekeyed("x").alias("kx"), F.col("x").alias("lx"), "m")
    return (edges.withColumn("kx", rekeyed("x")).join(least, "kx")
            .filter("x = lx").select("x", "y", "m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (x, y) with x > y."""
    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    large = (_with_minimum(both).filter("y > x")
             .select(F.col("y").alias("x"), F.least("x", "m").alias("y")).distinct())
    small = _with_minimum(large)
    return (small.filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
            .unionByName(small.select("x", F.col("m").alias("y"))).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars around their smallest nodes: every ``x`` has
    one ``y``, and no ``y`` is an ``x``.  Cheaper than a round that changes nothing."""
    tails = edges.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    if any_row(tails.filter("n > 1")):
        return False
    inner = edges.select("y").join(tails.select(F.col("x").alias("t")),
                                   F.col("y") == F.col("t"), "left_semi")
    return not any_row(inner)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); component: the
    smallest node that is reachable.

    Alternating large-star and small-star steps end, after about as many
    rounds as the logarithm of the largest component, in one edge from each
    node to its component's smallest node.  Links with a null end are
    ignored; an empty table gives an empty result.
    """
    edges = cut(links.filter("u <> v").select(
        F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y")).distinct(), "edges")
    while not _settled(edges):
        before, edges = edges, cut(_round(edges), "edges")
        discard(before)
    return edges.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(
        edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())
