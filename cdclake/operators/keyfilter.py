"""A filter of fixed size over keys, which a join's large side passes before it is shuffled.

It is a blocked Bloom filter: a key's hash chooses one of WORDS words of 64 bits, another hash BITS bits of it. Words are
made by an aggregate (partial in each task, so that a key shuffles at most one word) and sent to all tasks. A key that
was put in always passes; another passes with the probability error_rate. Behind it comes an exact join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many words are broadcast, whatever the number of keys: 16 MB of numbers, some 50 MB as a hash table.
WORDS, BITS = 1 << 20, 3


def error_rate(keys: int, words: int = WORDS) -> float:
    """The share of other keys that pass a filter of so many distinct keys: by the keys of a word, of Poisson's law."""
    mean, total, p = keys / words, 0.0, math.exp(-keys / words)
    for k in range(int(mean + 12 * math.sqrt(mean) + 30)):
        total += p * (1 - (1 - 1 / 64) ** (BITS * k)) ** BITS
        p *= mean / (k + 1)
    return min(1.0, total) if mean < 700 else 1.0


def _place(keys: tuple[str, ...]) -> tuple[Column, Column]:
    word = F.pmod(F.xxhash64(*keys), F.lit(WORDS)).cast("int")
    h = F.xxhash64(F.lit(1), *keys)
    bits = None
    for k in range(BITS):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return word, bits


def key_filter(rows: DataFrame, *keys: str) -> DataFrame:
    """(_word, _bits): the filter of the keys of rows. Null is a key like others."""
    word, bits = _place(keys)
    return rows.select(word.alias("_word"), bits.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def with_maybe(rows: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """rows with _maybe: false where the filter found doesn't have the key, true where it has it, or seems to.

    Keys are of the types that the filter's were. Columns of rows may not be named _word or _bits.
    """
    word, bits = _place(keys)
    joined = rows.join(F.broadcast(found), word == F.col("_word"), "left")
    return joined.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(bits) == bits, F.lit(False))).drop("_word", "_bits")


def sifted(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key may be among others'; those that are left out have no match there."""
    return with_maybe(rows, key_filter(others, *keys), *keys).where("_maybe").drop("_maybe")
