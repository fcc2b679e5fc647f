"""Bloom filters held as a table of 64-bit words, built and probed with DataFrame functions only.

Every key owns ``BITS`` bits of one word. The table holds at most ``MAX_WORDS`` rows whatever the data, which is the
proven bound that allows it to be broadcast; with more keys than it can separate, more rows count as "possibly in",
never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 3
MIN_WORDS, MAX_WORDS = 1 << 10, 1 << 20


def words_for(keys: int) -> int:
    """A power of two giving about 16 bits a key, within the bounds."""
    n = MIN_WORDS
    while n < MAX_WORDS and n * 4 < keys:
        n *= 2
    return n


def word_index(h: Column, n_words: int) -> Column:
    return h.bitwiseAND(F.lit(n_words - 1))


def bit_numbers(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, 24 + 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]


def mask(h: Column) -> Column:
    out = F.lit(0).cast("long")
    for b in bit_numbers(h):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
    return out


def filter_table(hashes: DataFrame, h: str, n_words: int, at_least: int = 1) -> DataFrame:
    """(bloom_word, bloom_bits): the bits that ``at_least`` rows of ``hashes`` set.

    ``at_least=2`` gives the filter of possibly repeated hashes. Counts are combined before the shuffle, so a hash
    that a third of the rows carry arrives as one row for each map task."""
    bits = hashes.select(word_index(F.col(h), n_words).alias("bloom_word"),
                         F.explode(F.array_distinct(F.array(*bit_numbers(F.col(h))))).alias("bit"))
    counts = bits.groupBy("bloom_word", "bit").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)
    return counts.groupBy("bloom_word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bloom_bits"))


def probe(df: DataFrame, h: str, table: DataFrame, n_words: int, flag: str) -> DataFrame:
    """Add boolean ``flag``: true where all bits of the row's hash are set (always, for hashes that are in)."""
    m = mask(F.col(h))
    joined = df.withColumn("bloom_word", word_index(F.col(h), n_words)).join(F.broadcast(table), "bloom_word", "left")
    hit = F.coalesce(F.col("bloom_bits"), F.lit(0).cast("long")).bitwiseAND(m) == m
    return joined.withColumn(flag, hit).drop("bloom_word", "bloom_bits")
