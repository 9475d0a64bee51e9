"""Exact sets of integer keys that merge: one row for every 64 keys.

A set is a table of (word, bits): ``word`` is the key divided by 64, rounded
down, and bit ``key mod 64`` of ``bits`` says that the key is there.  Sets of
parts merge by ``bit_or``, which is what a shuffle's map side does already, so
a key that stands on a third of all rows costs one bit a task.  Distinct counts
are sums of ``bit_count`` and stay exact however often sets are merged, where
sums of distinct counts would count a key twice.  A key costs 16 bytes at
most, and a quarter of a byte where keys lie densely, as surrogate keys do.

(Spark's own key bitmaps, ``bitmap_construct_agg``, hold 32,768 keys in 4 kB
each: a task that meets few keys of each would ship 4 kB for every one, and
their aggregate sorts its input.  ``bit_or`` over 64-bit words aggregates by
hash.)

Defined cases: null keys are in no set; negative keys are; an empty table gives
an empty set and a count of 0.  Keys are integers of any width up to 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = "word"
BITS = "bits"
#: A presence set up to this many words (16 bytes each) is small enough to send
#: to every task: 16 MB, some 64 million keys where they lie densely.
BROADCAST_WORDS = 1 << 20


def word_of(key: str | Column) -> Column:
    """The word of a key; the same for 64 neighbouring keys."""
    return F.shiftright(F.col(key).cast("bigint") if isinstance(key, str) else key, 6)


def bit_of(key: str | Column) -> Column:
    """A word with the key's bit alone."""
    key = F.col(key).cast("bigint") if isinstance(key, str) else key
    # ``shiftleft`` takes its distance modulo 64, for negative keys as well.
    return F.call_function("shiftleft", F.lit(1).cast("bigint"),
                           key.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))


def holds_integers(df: DataFrame, key: str) -> bool:
    """Whether ``key`` can be kept in a set of this kind."""
    return isinstance(df.schema[key].dataType,
                      (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def key_set(df: DataFrame, key: str, *groups: str) -> DataFrame:
    """The set of ``key`` in each group: (groups, word, bits)."""
    return (df.where(F.col(key).isNotNull())
            .select(*groups, word_of(key).alias(WORD), bit_of(key).alias("_bit"))
            .groupBy(*groups, WORD).agg(F.bit_or("_bit").alias(BITS)))


def merged(sets: DataFrame, *groups: str) -> DataFrame:
    """The union of sets over all but ``groups``: exact, not a sum."""
    return sets.groupBy(*groups, WORD).agg(F.bit_or(BITS).alias(BITS))


def size(sets: DataFrame, name: str, *groups: str) -> DataFrame:
    """The number of keys in each group's set (disjoint words), as ``name``."""
    return sets.groupBy(*groups).agg(
        F.coalesce(F.sum(F.bit_count(BITS).cast("bigint")), F.lit(0)).alias(name))


def missing(fact: DataFrame, key: str, known: DataFrame,
            broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Rows of ``fact`` whose non-null ``key`` is not in the set ``known``.

    Up to ``broadcast_words`` words the set goes to every task and each row
    looks its bit up: the fact is not shuffled at all.  A larger set is first
    compared with the set of the fact's own keys, word by word, which moves
    bits instead of keys; only words that hold a missing key, few or none in
    sound data, meet the fact again.  Its number of words is counted first, so
    give a set that is written or cheap to build.
    """
    known = known.select(F.col(WORD).alias("_word"), F.col(BITS).alias("_bits"))
    words = known.limit(broadcast_words + 1).count()
    rows = fact.where(F.col(key).isNotNull())
    if words <= broadcast_words:
        looked = rows.join(F.broadcast(known), word_of(key) == F.col("_word"), "left")
        absent = F.coalesce(F.col("_bits"), F.lit(0).cast("bigint")).bitwiseAND(bit_of(key)) == 0
        return looked.where(absent).drop("_word", "_bits")
    own = key_set(fact, key)
    lacking = (own.join(known, F.col(WORD) == F.col("_word"), "left")
               .select(F.col(WORD).alias("_word"), F.col(BITS).bitwiseAND(
                   F.bitwise_not(F.coalesce("_bits", F.lit(0).cast("bigint")))).alias("_bits"))
               .where("_bits <> 0"))
    return (rows.join(lacking, word_of(key) == F.col("_word"))
            .where(F.col("_bits").bitwiseAND(bit_of(key)) != 0).drop("_word", "_bits"))
