"""A set of keys as a bitmap of fixed size, looked up in place: what it doesn't have is out for certain, without any shuffle.

Keys share bits by chance, so what it has is only likely to be in the set; callers decide those rows exactly, by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a map: half a megabyte, whatever the number of keys.
MAP_BITS = 22


def _slot(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << MAP_BITS))


def key_map(keys: DataFrame) -> Column:
    """The bitmap, as an array of longs, of all rows of keys (all columns make the key)."""
    slots = keys.select(_slot(*(F.col(c) for c in keys.columns)).alias("slot"))
    held = slots.select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bits"))
    blank = keys.sparkSession.range(1 << (MAP_BITS - 6)).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = held.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return dense.agg(ordered.getField("bits")).scalar()


def maybe_in(bitmap: Column, *key: Column) -> Column:
    """False: the key is not in the set."""
    slot = _slot(*key)
    word = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
