"""A Bloom filter as a table, ahead of an exact look-up.

The filter is an array of 64-bit words.  A key sets a few bits of one word, so
a filter is an aggregate (``bit_or`` by word), filters merge by the same
aggregate, and a look-up is a join on the word.  A key that does not find all
its bits is surely new and skips the exact look-up; the others are looked up,
so nothing is lost to a false positive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tideline.sinks.writers import BatchTable

WORDS = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])


def false_positives(keys_per_word: float, hashes: int) -> float:
    """Expected rate when words hold a Poisson number of keys, each with ``hashes`` draws of 64 bits."""
    if keys_per_word > 300:  # all bits are set
        return 1.0
    rate, weight = 0.0, math.exp(-keys_per_word)
    for n in range(1, int(keys_per_word + 12 * math.sqrt(keys_per_word) + 20)):
        weight *= keys_per_word / n
        rate += weight * (1 - (1 - 1 / 64) ** (hashes * n)) ** hashes
    return rate


@dataclass(frozen=True)
class BloomShape:
    """Number of words and of bits a key sets."""

    words: int
    hashes: int

    @classmethod
    def for_keys(cls, expected: int, p: float) -> BloomShape:
        """The smallest filter that keeps the rate at or below ``p`` up to ``expected`` keys."""
        best = None
        for hashes in range(1, 11):
            low, high = 1, 2
            while false_positives(expected / high, hashes) > p:
                low, high = high, high * 2
            while high - low > max(1, high // 1000):
                middle = (low + high) // 2
                low, high = (low, middle) if false_positives(expected / middle, hashes) <= p else (middle, high)
            if best is None or high < best.words:
                best = cls(high, hashes)
        return best

    def word(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.words))

    def mask(self, keys: Sequence[str]) -> Column:
        """The bits of a key, each from six bits of one hash (another one after ten draws)."""
        bits = F.lit(0).cast("long")
        for i in range(self.hashes):
            h = F.xxhash64(F.lit(i // 10), *keys)
            place = F.shiftrightunsigned(h, 6 * (i % 10)).bitwiseAND(63).cast("int")
            bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        return bits


def add_keys(df: DataFrame, keys: Sequence[str], shape: BloomShape) -> DataFrame:
    """The filter ``(word, bits)`` of the keys of ``df``."""
    return df.groupBy(shape.word(keys).alias("word")).agg(F.bit_or(shape.mask(keys)).alias("bits"))


def merge_filters(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def maybe_seen(df: DataFrame, keys: Sequence[str], words: DataFrame, shape: BloomShape, out: str = "maybe") -> DataFrame:
    """Add ``out``: false for keys that the filter surely does not hold."""
    mask = shape.mask(keys)
    found = F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False))
    return df.withColumn("word", shape.word(keys)).join(words, "word", "left").withColumn(out, found).drop("word", "bits")


def new_rows(
    batch: DataFrame, batch_id: int, filters: BatchTable, seen: BatchTable, keys: Sequence[str], shape: BloomShape,
) -> DataFrame:
    """One row for each key that no batch before had; remembers them.

    Only keys that may have been seen are looked up among the remembered ones.
    A batch reads the one filter written by the last batch, whose size is fixed.
    """
    keys = list(keys)
    rows = batch.dropDuplicates(keys)
    words = filters.read(WORDS, before=batch_id)
    last = words.agg(F.max("batch")).first()[0]
    words = words.where(F.col("batch") == F.lit(last)).select("word", "bits")
    marked = maybe_seen(rows, keys, words, shape)
    known = seen.read(rows.schema, before=batch_id).select(*keys)
    sure = marked.where("NOT maybe").drop("maybe")
    checked = marked.where("maybe").drop("maybe").join(known, keys, "left_anti")
    seen.write(sure.unionByName(checked), batch_id)
    fresh = seen.read(rows.schema).where(F.col("batch") == batch_id).select(*rows.columns)
    filters.write(merge_filters(words, add_keys(fresh, keys, shape)), batch_id)
    return fresh
