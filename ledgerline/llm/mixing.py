"""Mixing sources to target weights, in DataFrame functions only.

Capped water-filling: every source gets words in proportion to its weight
until it holds ``max_epochs`` times its own size; what a clamped source can
not take is shared out again by weight, until no source is above its cap.  A
source's target is then taken in whole repetitions of all its documents and
one fractional repetition: documents in seeded order up to the target, the
last of them in part where words are counted (``taken``), whole or not at all
where rows are repeated (``repeat_rows``).

Defined cases: null text has size 0 and takes nothing; the null source comes
last in the order of sources; rows that repeat an id are rows of their own
(among equal rows it does not matter which comes first); an empty table, or
one without words, takes nothing; a very long text is one document, counted
and repeated whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, cut, documents

#: Bits of the seeded place of a document within its source.
PLACE_BITS = 52


def word_count(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_place(doc_id: Column, seed: int) -> Column:
    """A place in 0 .. 2^52 - 1 from md5 of the id and the seed."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def weighted_sources(sized: DataFrame, weights: Sequence[int]) -> DataFrame:
    """(m_source, m_docs, m_total, m_weight): sources in code-point order, null
    last, weighing ``weights`` in turn.

    The rank comes from a range-partitioned sort: the rank within the
    partition plus the rows of the partitions before, so no task sees all
    sources however many there are.
    """
    sources = sized.groupBy("m_source").agg(
        F.count(F.lit(1)).alias("m_docs"), F.sum("m_size").alias("m_total"))
    order = F.col("m_source").asc_nulls_last()
    placed = cut(
        sources.repartitionByRange(order).sortWithinPartitions(order)
        .select("*", F.spark_partition_id().alias("m_p"),
                F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("m_i")),
        "sources")
    before = Window.orderBy("m_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("m_p").count().select(
        "m_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("m_before"))
    turn = ((F.col("m_i") + F.col("m_before")) % len(weights)).cast("int")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), turn + 1)
    return cut(placed.join(offsets, "m_p").select(
        "m_source", "m_docs", "m_total", weight.cast("long").alias("m_weight")), "weights")


def water_level(sources: DataFrame, max_epochs: int) -> float:
    """Words a unit of weight gets, where sources stop at their caps.

    Each round is one aggregate over the sources: clamp those that the last
    level put above their cap, share the rest out anew.  The level only
    rises, so a clamped source stays clamped.
    """
    cap = F.col("m_total") * max_epochs
    level = None
    while True:
        clamped = F.lit(False) if level is None else cap < F.lit(level) * F.col("m_weight")
        total, held, weight, n = sources.agg(
            F.sum("m_total"), F.sum(F.when(clamped, cap)),
            F.sum(F.when(~clamped, F.col("m_weight"))),
            F.count(F.when(clamped, 1))).first()
        if not total or not weight:
            return 0.0
        if level is not None and n == known:
            return level
        level, known = (total - (held or 0)) / weight, n


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3,
        seed: int = 17, source: str = "source", text: str = "text",
        doc_id: str = "doc_id", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` columns with m_size, m_total, m_target, m_whole (repetitions of
    the whole document) and m_part (words of the fractional repetition)."""
    sized = cut(docs.select(
        *carry, F.col(source).alias("m_source"), F.col(doc_id).alias("m_id"),
        word_count(F.col(text)).alias("m_size"),
        seeded_place(F.col(doc_id), seed).alias("m_place")), "sized")
    sources = weighted_sources(sized, weights)
    level = water_level(sources, max_epochs)
    target = F.least(F.col("m_total") * float(max_epochs), F.lit(level) * F.col("m_weight"))
    whole = F.coalesce(F.floor(F.try_divide(F.col("m_target"), F.col("m_total"))), F.lit(0))
    plan = (sources.withColumn("m_target", target.cast("double"))
            .withColumn("m_whole", whole.cast("long"))
            .withColumn("m_quota", F.round("m_target").cast("long")
                        - F.col("m_whole") * F.col("m_total")))

    # About as many buckets of places as a bucket has rows: each source's quota
    # ends in one of its buckets, and only that one is put in order.
    n = sources.agg(F.sum("m_docs")).first()[0] or 1
    bits = math.ceil(math.log2(n) / 2)
    sized = sized.withColumn("m_bucket", F.shiftright("m_place", PLACE_BITS - bits))
    run = Window.partitionBy("m_source").orderBy("m_bucket")
    buckets = (sized.groupBy("m_source", "m_bucket").agg(F.sum("m_size").alias("m_sum"))
               .withColumn("m_upto", F.sum("m_sum").over(run)))
    quota = plan.select(F.col("m_source").alias("m_s"), "m_quota")
    ends = (buckets.join(quota, F.col("m_source").eqNullSafe(F.col("m_s")))
            .filter((F.col("m_upto") - F.col("m_sum") <= F.col("m_quota")))
            .groupBy("m_source").agg(
                F.max("m_bucket").alias("m_end"),
                F.max(F.col("m_upto") - F.col("m_sum")).alias("m_done")))
    ends = ends.withColumnRenamed("m_source", "m_e")
    plan = cut(plan.join(ends, plan["m_source"].eqNullSafe(ends["m_e"]), "left")
               .select(F.col("m_source").alias("m_s"), "m_total", "m_target", "m_whole",
                       "m_quota", "m_end", "m_done"), "mixplan")
    rows = sized.join(plan, sized["m_source"].eqNullSafe(plan["m_s"]))
    full = rows.filter("m_bucket <> m_end").withColumn(
        "m_part", F.when(F.col("m_bucket") < F.col("m_end"), F.col("m_size"))
        .otherwise(F.lit(0)).cast("long"))
    order = Window.partitionBy("m_source").orderBy("m_place", "m_id", "m_size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    left = (F.col("m_quota") - F.col("m_done")
            - (F.sum("m_size").over(order) - F.col("m_size")))
    edge = rows.filter("m_bucket = m_end").withColumn(
        "m_part", F.greatest(F.lit(0), F.least(F.col("m_size"), left)).cast("long"))
    return full.unionByName(edge).drop(
        "m_s", "m_place", "m_bucket", "m_quota", "m_end", "m_done", "m_id", "m_source")


def taken(mixed: DataFrame) -> Column:
    """Words that the mix takes of a row, repeats counted."""
    return F.col("m_whole") * F.col("m_size") + F.col("m_part")


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """One row per repetition, whole texts only.

    The document in which a source's fractional repetition ends is taken whole
    or not at all, whichever comes nearer to the target; rows that the mix takes
    nothing of go.
    """
    copies = F.col("m_whole") + (2 * F.col("m_part") > F.col("m_size")).cast("long")
    copies = F.when(F.col("m_size") > 0, copies).otherwise(F.lit(0))
    return (mixed.withColumn("m_copies", copies).filter("m_copies > 0")
            .withColumn("m_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m_copies"))))
            .drop("m_copies", "m_copy", "m_whole", "m_part", "m_size", "m_total", "m_target"))


def op5_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's share of the mix."""
    mixed = mix(documents(spark, sf_dir))
    return mixed.select("doc_id", F.col("m_size").alias("size"),
                        F.col("m_total").alias("source_size"),
                        F.col("m_target").alias("target"), taken(mixed).alias("taken"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':17'), 1, 13))::BIGINT AS place
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS total,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, sum(total) OVER ()::BIGINT AS everything,
         coalesce(sum(3 * total) OVER before, 0)::BIGINT AS held,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS open
  FROM s
  WINDOW before AS (ORDER BY 3 * total / weight, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT coalesce(arg_min((everything - held) / open, 3 * total / weight)
                  FILTER (WHERE 3 * total >= (everything - held) / open * weight), 0.0) AS unit
  FROM r
), t AS (
  SELECT source, total, least(total * 3.0::DOUBLE, unit * weight)::DOUBLE AS target
  FROM s, level
), q AS (
  SELECT *, CASE WHEN total = 0 THEN 0 ELSE floor(target / total) END::BIGINT AS whole
  FROM t
)
SELECT doc_id, size, total AS source_size, target,
       whole * size + greatest(0, least(size, round(target)::BIGINT - whole * total
         - (sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)))::BIGINT
         AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
"""
