"""Blocked Bloom filters over record keys, built by Spark's bitmap aggregates.

A group of keys (a landed batch, a load) gets as many blocks of ``BLOCK_BITS`` bits as
its keys need, a power of two. A key falls into one block, where ``PROBES`` of its bits
are set. Asking a filter for a key then needs one row of it, found by an equi-join on
(level, block), and a key that the group does not have is told apart without reading
the group's records: with ``KEYS_PER_BLOCK`` keys a block it passes with a chance of
about 1e-6. There are no false negatives.

Keys are dealt out by (group, block) before a block is aggregated, so a group with a
third of all keys spreads over its blocks, and no task holds more than one bitmap of a
block. A NULL key part is a value like others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32768  # the size of Spark's bitmaps
KEYS_PER_BLOCK = 1024
PROBES = 12


def _hashes(key: list[str]) -> tuple[Column, Column]:
    """Two independent hashes of the key; the first chooses the block, both the bits."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in key]
    return F.xxhash64(*parts), F.xxhash64(F.lit("bits"), *parts)


def _bits(a: Column, b: Column) -> list[Column]:
    """The bits of a key within its block (double hashing with an odd step)."""
    start, step = F.pmod(a, F.lit(BLOCK_BITS)), F.pmod(b, F.lit(BLOCK_BITS // 2)) * 2 + 1
    return [F.pmod(start + i * step, F.lit(BLOCK_BITS)) for i in range(PROBES)]


def _block(a: Column, level: Column) -> Column:
    """The block of a key among 2^level blocks, from other bits of the hash than those within the block."""
    return F.shiftrightunsigned(a, 15).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)


def build(keys: DataFrame, key: list[str], group: list[str]) -> DataFrame:
    """Filters of the keys per group: ``group``, level, block, bitmap. Repeated keys cost room, nothing else.

    Each key is one row up to the bitmaps: its probes are aggregated side by side, a bitmap
    each, and only the bitmaps of a block are then laid over each other.
    """
    size = F.greatest(F.lit(1.0), F.count(F.lit(1)) / KEYS_PER_BLOCK)
    levels = keys.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group]).agg(F.ceil(F.log2(size)).cast("int").alias("level"))
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    a, b = _hashes(key)
    dealt = keys.join(levels, same).select(*group, "level", a.alias("_a"), b.alias("_b"))
    dealt = dealt.withColumn("block", _block(F.col("_a"), F.col("level"))).repartition(*group, "level", "block")
    probes = [F.bitmap_construct_agg(bit).alias(f"_bitmap_{i}") for i, bit in enumerate(_bits(F.col("_a"), F.col("_b")))]
    apart = dealt.groupBy(*group, "level", "block").agg(*probes)
    bitmaps = F.explode(F.array(*[F.col(f"_bitmap_{i}") for i in range(PROBES)])).alias("_bitmap")
    laid = apart.select(*group, "level", "block", bitmaps).groupBy(*group, "level", "block")
    return laid.agg(F.bitmap_or_agg("_bitmap").alias("bitmap"))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def may_contain(keys: DataFrame, key: list[str], filters: DataFrame, group: list[str]) -> DataFrame:
    """Pairs of a key and a group that may hold it: distinct ``key`` and ``group``.

    A key goes once for each level in use (a few numbers, not once for each group) and
    meets the one block of each filter of that level where its bits would be.
    """
    a, b = _hashes(key)
    wanted = keys.select(*key).distinct().select(*key, a.alias("_a"), b.alias("_b"))
    levels = sorted(row.level for row in filters.select("level").distinct().collect())  # powers of two: a few
    asked = wanted.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    asked = asked.withColumn("block", _block(F.col("_a"), F.col("level")))
    met = asked.join(filters.withColumnsRenamed({g: f"_g_{g}" for g in group}), ["level", "block"])
    # Bit after bit: most pairs of a key and a filter that doesn't hold it end at the first or second.
    hit = met.where(reduce(lambda x, y: x & y, [_is_set(F.col("bitmap"), bit) for bit in _bits(F.col("_a"), F.col("_b"))]))
    return hit.select(*key, *[F.col(f"_g_{g}").alias(g if g not in key else f"filter_{g}") for g in group])
