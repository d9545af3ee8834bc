"""Sharding by jump consistent hashing, in DataFrame expressions only.

A key walks a pseudo-random sequence of jumps; the last jump below the shard count is its shard.
Nothing but the key and the count decides, no ring table exists, and one more shard takes only
the rows that move into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._plan import Shared, estimated_bytes, shuffle_partitions

RANGE_BYTES = 32 << 20  # stored rows, without their texts, that one task sorts

#: The multiplier of the published generator, as 32-bit halves and 16-bit quarters.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_L1, _L0 = _LOW >> 16, _LOW & 0xFFFF


def _step(state: Column) -> Column:
    """key := key * MULTIPLIER + 1 mod 2**64 on 32-bit halves (no signed overflow under ANSI rules)."""
    hi, lo = state["hi"], state["lo"]
    mask16, mask32 = F.lit(0xFFFF).cast("long"), F.lit(0xFFFFFFFF).cast("long")
    t0 = lo * F.lit(_L0).cast("long") + F.lit(1).cast("long")
    s = F.shiftrightunsigned(t0, 16) + lo * F.lit(_L1).cast("long")
    low = F.shiftleft(s.bitwiseAND(mask16), 16).bitwiseOR(t0.bitwiseAND(mask16))
    cross = (lo * F.lit(_HIGH).cast("long")).bitwiseAND(mask32)
    upper = (hi * F.lit(_L0).cast("long")).bitwiseAND(mask32) + F.shiftleft((hi * F.lit(_L1).cast("long")).bitwiseAND(mask16), 16)
    high = (F.shiftrightunsigned(s, 16) + cross + upper).bitwiseAND(mask32)
    return F.struct(high.alias("hi"), low.alias("lo"))


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (0 to shards - 1) of a long key; null keys go to shard 0.

    Every jump moves forward by at least one, so `shards` steps suffice; steps after the
    last jump leave the state alone.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias("lo"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
    )

    def jump(state: Column, _: Column) -> Column:
        key = _step(state)
        ahead = (state["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(key["hi"], 1) + 1).cast("double"))
        return F.struct(key["hi"].alias("hi"), key["lo"].alias("lo"), state["j"].alias("b"), F.floor(ahead).cast("long").alias("j"))

    def maybe(state: Column, i: Column) -> Column:
        return F.when(state["j"] < F.lit(shards), jump(state, i)).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, maybe, lambda s: s["b"].cast("int"))


def shard(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` without its text, plus size, text_crc32, law, shard, slot and grown_shard.

    size is the UTF-8 length (null text: 0) plus 16; text_crc32 that of the UTF-8 bytes (null: of
    nothing). slot counts the rows of a shard from 0 without gaps, in the order of (key, checksum,
    size), whatever the partitions: rows are sorted in ranges of that order, and each range's few
    counts by shard are summed, so no task holds a shard. Ranges end within equal keys and texts too,
    so that no key which many rows share fills one alone; rows that agree in all three get their
    slots by their place in a table written to the shared folder. Equal keys share a shard. Null keys
    are one key, the least. An empty table gives none. Columns of `df` named like a new one give
    way, all others stay. Texts of any length are read in place.
    """
    made = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    keep = [c for c in df.columns if c.lower() not in made and c != text]
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*([F.col(f"`{c}`") for c in keep] or [F.lit(0).alias("none")])).alias("r"),
        F.col(f"`{key}`").alias("key"),
        (F.octet_length(raw).cast("long") + 16).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        jump_hash(F.col(f"`{key}`"), shards).alias("shard"),
        jump_hash(F.col(f"`{key}`"), shards + 1).alias("grown_shard"),
    )
    shared = Shared(df.sparkSession)
    rows = shared.table(rows)
    order = ("shard", F.col("key").asc_nulls_first(), "text_crc32", "size", "row")
    ranges = max(shuffle_partitions(df.sparkSession), -(-estimated_bytes(rows) // RANGE_BYTES))
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("row", "key")
    rows = shared.table(rows.withColumn("place", F.monotonically_increasing_id()).withColumn("range", F.shiftright("place", 33)))
    counts = rows.groupBy("shard", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = W.partitionBy("shard").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).cast("long")
    out = rows.join(counts.select("shard", "range", shift.alias("shift")), ["shard", "range"])
    kept = [F.col("r").getField(c).alias(c) for c in keep]
    return out.select(*kept, "size", "text_crc32", F.lit("key").alias("law"), "shard", "grown_shard", (F.col("place") + F.col("shift")).alias("slot"))
