"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, all other text is unlabelled
(not "clean"): the risk of calling unlabelled text negative is corrected by
the share of positives in it, and kept from falling below zero, so that the
model does not learn the unlabelled toxic documents as clean (Kiryo et al.,
"Positive-Unlabeled Learning with Non-Negative Risk Estimator", 2017).

A text's features are its distinct words and their beginnings, hashed.  The
model is fitted on a bounded sample (``positives`` and ``unlabelled``
documents, parameters); features enter if they are clearly more frequent among
the positives.  Every document is then scored, whole.

Defined cases: null and empty texts, and texts without a known feature, get
the base score; without positives or labels all documents get the prior;
rows that repeat an id are scored row by row; several labels of an id: toxic
if any is; an empty table gives an empty result; other columns are not read;
of a very long text its distinct features are held, and for the sampled
documents they reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, documents, is_remainder

BITS = 22
PREFIXES = (4, 5)
PUNCTUATION = ".,!?;:\"'()[]{}*$#%&|<>-"
WORDS_CACHED = 300_000  # a cache only


class WordFeatures(dict):
    """Hashed features of a word; with ``wanted``, only those in it."""

    def __init__(self, wanted: Container[int] | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[int, ...]:
        bare = word.strip(PUNCTUATION)
        names = [bare, *(f"^{n}^{bare[:n]}" for n in PREFIXES)] if bare else []
        value = tuple(zlib.crc32(n.encode("utf-8", "replace")) >> (32 - BITS) for n in names)
        if self.wanted is not None:
            value = tuple(f for f in value if f in self.wanted)
        if len(self) < WORDS_CACHED and len(word) <= 64:
            self[word] = value
        return value


def features(text: str | None, words: WordFeatures) -> set[int]:
    """Features of a text, each once."""
    found: set[int] = set()
    for value in filter(None, map(words.__getitem__, set(text.lower().split() if text else ()))):
        found.update(value)
    return found


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordFeatures()
    for batch in batches:
        rows = [np.array(sorted(features(t.as_py(), words)), "<i4").tobytes()
                for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("positive"), pa.array(rows, pa.binary())], names=["positive", "f"])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Examples:
    """Documents as (feature, row) pairs."""

    def __init__(self, rows: list[bytes]):
        each = [np.frombuffer(r, "<i4") for r in rows]
        self.n = len(each)
        self.f = np.concatenate([*each, np.empty(0, np.int32)]).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in each]).astype(np.int64)

    def frequency(self) -> np.ndarray:
        return np.bincount(self.f, minlength=1 << BITS)

    def restrict(self, chosen: np.ndarray) -> None:
        """Keep the features in ``chosen`` (ascending) and number them by it."""
        at = np.searchsorted(chosen, self.f)
        at[at == len(chosen)] = 0
        keep = chosen[at] == self.f if len(chosen) else np.zeros(len(at), bool)
        self.f, self.row = at[keep], self.row[keep]

    def margin(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.f], minlength=self.n) + b

    def gradient(self, per_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.f, weights=per_row[self.row], minlength=size)


def telling(positive: Examples, unlabelled: Examples, lift: float, sigmas: float) -> np.ndarray:
    """Features that are ``lift`` times as frequent among the positives as in
    unlabelled text, by more than chance would give."""
    n_p, n_u = positive.frequency(), unlabelled.frequency()
    expected = n_u * (positive.n / unlabelled.n)
    return np.flatnonzero((n_p >= 3) & (n_p > lift * expected)
                          & (n_p - expected >= sigmas * np.sqrt(expected + 0.5)))


def fit(positive: Examples, unlabelled: Examples, prior: float, lift: float = 2.0,
        sigmas: float = 4.0, rounds: int = 200, rate: float = 0.1, decay: float = 1e-4
        ) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, their weights, bias) of a logistic classifier with the
    non-negative positive-unlabelled risk, by Adam on the whole sample."""
    bias = float(np.log(prior / (1 - prior)))
    if not positive.n or not unlabelled.n:
        return np.empty(0, np.int64), np.empty(0), bias
    chosen = telling(positive, unlabelled, lift, sigmas)
    positive.restrict(chosen)
    unlabelled.restrict(chosen)
    size = len(chosen)
    # The bias is the last parameter.
    theta, m, v = np.append(np.zeros(size), bias), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        z_p, z_u = positive.margin(theta[:-1], theta[-1]), unlabelled.margin(theta[:-1], theta[-1])
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        as_positive = -prior * sigmoid(-z_p) / positive.n
        minus_negative = -prior * sigmoid(z_p) / positive.n
        as_negative = sigmoid(z_u) / unlabelled.n
        # Below zero the negative risk is overfitted: step back up on it alone.
        g_p, g_u = ((as_positive + minus_negative, as_negative) if negative >= 0
                    else (-minus_negative, -as_negative))
        g = np.append(positive.gradient(g_p, size) + unlabelled.gradient(g_u, size)
                      + decay * theta[:-1], g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return chosen, theta[:-1], float(theta[-1])


def _sample(ids: DataFrame, n: int) -> DataFrame:
    """At most ``n`` ids, the first by a seeded hash."""
    return ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(n)


def train(docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 8000
            ) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) from documents and labels outside the held-out rows.

    The prior is the share of toxic documents among the labelled ones.
    """
    held_out = is_remainder(F.col("doc_id"), 3, 1)
    known = labels.filter(~held_out & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    prior = min(0.9, max(0.001, share))
    pool = docs.filter(~held_out & F.col("doc_id").isNotNull())
    chosen = (_sample(known.filter("toxic = 1").select("doc_id"), positives)
              .withColumn("positive", F.lit(True))
              .unionByName(_sample(pool.select("doc_id"), unlabelled)
                           .withColumn("positive", F.lit(False))))
    # Two bounded samples: at most positives + unlabelled ids.
    chosen = cut(chosen, "sample")
    rows = (pool.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .mapInArrow(_featurize, "positive boolean, f binary").toArrow())
    flags, each = rows["positive"].to_pylist(), rows["f"].to_pylist()
    both = [Examples([r for flag, r in zip(flags, each, strict=True) if flag is want])
            for want in (True, False)]
    return fit(*both, prior)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, bias = model.value
        weight = dict(zip(ids.tolist(), values.tolist(), strict=True))
        words = WordFeatures(weight)
        for batch in batches:
            z = [sum(weight[f] for f in sorted(features(t.as_py(), words))) + bias
                 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(sigmoid(np.array(z, float)))],
                names=["doc_id", "held_out", "score"])
    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id, held_out and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        is_remainder(F.col("doc_id"), 3, 1).alias("held_out"), "text")
    return given.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity score and class."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return score(docs, train(docs, labels)).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int"))
