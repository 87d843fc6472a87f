"""Sharding by jump consistent hashing, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: multiplier of the published jump hash's generator.
MULTIPLIER = 2862933555777941757
M_LOW, M_MID, M_HIGH = MULTIPLIER & 0xFFFF, MULTIPLIER >> 16 & 0xFFFF, MULTIPLIER >> 32
LOW32 = 0xFFFFFFFF

#: Each shard's rows are numbered in so many independent buckets.
SLOT_BUCKETS = 1024
#: Jumps of a key to n shards number about ln n; a key that needs more than this raises.
MOST_JUMPS = 128


def _times(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2**64 in halves of 32 bits, so that no product overflows a long."""
    mid = lo * F.lit(M_MID)
    low = lo * F.lit(M_LOW) + F.shiftleft(mid.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    high = F.shiftright(low, 32) + F.shiftright(mid, 16) + hi * F.lit(M_LOW)
    high = high + F.shiftleft((hi * F.lit(M_MID)).bitwiseAND(F.lit(0xFFFF)), 16) + lo * F.lit(M_HIGH)
    return high.bitwiseAND(F.lit(LOW32)), low.bitwiseAND(F.lit(LOW32))


def jump_hash(key: Column, n_shards: int) -> Column:
    """The shard (0 to n_shards - 1) of an unsigned 64-bit key by jump consistent hashing; a null key counts as 0."""
    key = F.coalesce(key.cast("long"), F.lit(0))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW32)).alias("lo"),
        F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"),
    )

    def step(s: Column, _: Column) -> Column:
        hi, lo = _times(s["hi"], s["lo"])
        share = F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + F.lit(1)).cast("double")
        jumped = F.struct(
            hi.alias("hi"), lo.alias("lo"), s["next"].alias("at"),
            F.floor((s["next"] + F.lit(1)).cast("double") * share).cast("long").alias("next"),
        )
        return F.when(s["next"] < F.lit(n_shards), jumped).otherwise(s)

    def end(s: Column) -> Column:
        done = s["next"] >= F.lit(n_shards)
        return F.when(done, s["at"].cast("int")).otherwise(F.raise_error(F.lit("jump hash: more jumps than expected")).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(min(n_shards, MOST_JUMPS))), start, step, end)


def slot_bucket(key: Column) -> Column:
    """A bucket from two steps of the same generator; it spreads the rows of one shard."""
    key = F.coalesce(key.cast("long"), F.lit(0))
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW32)).alias("lo"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _times(s["hi"], s["lo"])
        return F.struct(hi.alias("hi"), lo.alias("lo"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2)), start, step, lambda s: (F.shiftright(s["hi"], 4) % F.lit(SLOT_BUCKETS)).cast("int"))


def shard(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Puts every row into a shard by its id alone (law ``key``).

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard. Slots are gapless from 0 in
    each shard: rows are numbered inside (shard, bucket) windows and shifted by the bucket's start, a prefix sum over
    n_shards * SLOT_BUCKETS counts, so no shard is sorted in one task. Null ids hash as 0 and sort first; null text has
    size 1 and checksum 0; repeated rows get slots of their own; an empty table gives an empty result; other columns
    are ignored.
    """
    raw = F.col(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
    ).select(
        "*", jump_hash(F.col("doc_id"), n_shards).alias("shard"), jump_hash(F.col("doc_id"), n_shards + 1).alias("grown_shard"),
        slot_bucket(F.col("doc_id")).alias("_bucket"),
    )
    inside = Window.partitionBy("shard", "_bucket")
    numbered = rows.select("*", F.row_number().over(inside.orderBy(F.asc_nulls_first("doc_id"), "text_crc32", "size")).alias("_nth"))
    counts = docs.select(F.col(id_col).cast("long").alias("_id")).groupBy(
        jump_hash(F.col("_id"), n_shards).alias("shard"), slot_bucket(F.col("_id")).alias("_bucket")
    ).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # At most n_shards * SLOT_BUCKETS rows of three numbers, whatever the input.
    starts = F.broadcast(starts) if n_shards <= 256 else starts
    return numbered.join(starts, ["shard", "_bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_start") + F.col("_nth") - F.lit(1)).cast("long").alias("slot"), "grown_shard",
    )
