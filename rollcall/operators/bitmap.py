"""A set of hashes as one bitmap, tested where the rows are, before any of them moves.

For joins whose small side is above the broadcast limit: a bitmap takes two bytes for each
entry, and ``MOST_BITS`` bounds it. A row whose bit is not set has no partner; of the
others about one in sixteen is a false alarm, which the join then drops, more once the
bitmap has reached its bound. Results never depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.session import materialize, measured, shuffled

BITS_EACH = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27  # 8 KB to 16 MB


def _bit(value: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(bits))


def bitmap_of(keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """One row with the bitmap as an array of 64-bit words, ``words``; and how many bits it has."""
    bits = LEAST_BITS
    while bits < min(rows * BITS_EACH, MOST_BITS):
        bits *= 2
    bit = _bit(F.col(key), bits)
    # bits are set in map tasks; a row for each word, set or not, keeps the array dense
    words = keys.filter(F.col(key).isNotNull()).select(
        F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int")).alias("set")
    )
    empty = keys.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("set"))
    dense = words.unionByName(empty).groupBy("word").agg(F.bit_or("set").alias("set"))
    gathered = F.array_sort(F.collect_list(F.struct("word", "set")))
    return dense.agg(F.transform(gathered, lambda w: w["set"]).alias("words")), bits


def may_be_in(value: Column, words: DataFrame, bits: int) -> Column:
    """Whether the value's bit is set in a bitmap, which reaches the tasks as a scalar."""
    bit = _bit(value, bits)
    word = F.get(words.scalar(), F.shiftright(bit, 6).cast("int"))
    return F.getbit(word, (bit % 64).cast("int")) == 1


def join_keys(rows: DataFrame, keys: DataFrame, key: str, label: str) -> DataFrame:
    """``rows`` joined to ``keys`` on ``key``: by broadcast where ``keys`` is small, else only the
    rows that the bitmap of the keys lets through are shuffled."""
    table, count, small = measured(keys, label)
    if small:
        return rows.join(F.broadcast(table), key)
    words, bits = bitmap_of(table, key, count)
    return rows.filter(may_be_in(F.col(key), materialize(words, f"{label}-bitmap"), bits)).join(shuffled(table), key)
