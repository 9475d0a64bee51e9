"""Training-text pipeline over ``documents``.

quality rules -> near-duplicates -> personal data -> mixing -> packing.

Each stage takes the documents its predecessor kept, whole, and returns
documents with the same columns, the last one the packed pieces.  ``n_chars``
follows the text where a stage changes it.

Defined cases, as in the operators: null text has no words and is dropped by
the quality rules; rows that repeat an id, or have none, are judged by their
texts, so that of equal or nearly equal texts one stays and every other text
does; no text is cut but by the packing; an empty table passes through as an
empty table; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import mixing, near_dedup, packing, pii, quality
from ledgerline.llm.common import boxed, cut, documents


def _with_text(docs: DataFrame, row: Column, text: Column) -> Column:
    """``row`` (the columns of ``docs``) with another text, n_chars recounted."""
    row = row.withField("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.char_length(text).cast(kind))
    return row.alias("row")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose source does."""
    judged = quality.judge(docs.select(boxed(docs), "source", "text"), carry=("row",))
    return judged.filter("q_kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, by five-word shingles and a similarity of 0.8."""
    return near_dedup.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    found = pii.find_spans(docs.select(boxed(docs), "text"), carry=("row",))
    clean = found.select("row", pii.redacted(F.col("row.text"), F.col("p_spans")).alias("t"))
    return clean.select(_with_text(docs, F.col("row"), F.col("t"))).select("row.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, whole, as often as the mix takes them."""
    mixed = mixing.mix(docs.select(boxed(docs), "doc_id", "source", "text"), carry=("row",))
    return mixing.repeat_rows(mixed).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: The tokenizer and the span model are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
