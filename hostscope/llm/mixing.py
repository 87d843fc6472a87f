"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostscope.llm.common import n_words, with_small, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix"
#: Leading hex digits of the random key that name a bucket: 16**3 buckets a source.
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """Each source's target from its size: source, source_size, target.

    The weights repeat over the sources in code-point order, null last. A source stops at ``most`` times its size and
    the excess goes to the others by weight until none is above: sorted by size per weight, the sources that stop are
    a prefix, so one pass of running sums finds the level. One row a source.
    """
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - F.lit(1)) % F.lit(len(weights))
    weighed = sizes.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), place.cast("int") + F.lit(1)).alias("_w"))
    cap = (F.col("source_size") * F.lit(most)).cast("double")
    ordered = Window.orderBy(cap / F.col("_w"), F.asc_nulls_last("source"))
    all_rows = Window.partitionBy()
    upto = ordered.rowsBetween(Window.unboundedPreceding, -1)
    levels = weighed.select(
        "*", cap.alias("_cap"),
        (F.sum("source_size").over(all_rows).cast("double") * F.lit(share) - F.coalesce(F.sum(cap).over(upto), F.lit(0.0))).alias("_left"),
        (F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0))).alias("_weight"),
    )
    # Where a source stays below its cap, all after it do too; the first such row holds the level.
    level = F.when(F.col("_left") * F.col("_w") <= F.col("_cap") * F.col("_weight"), F.col("_left") / F.col("_weight"))
    first = F.first(level, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_w") * first, F.col("_cap"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **how) -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source, source_size, target, taken, epochs.

    Every document gets a hash-random key. A source's target is whole epochs over it plus a rest; the rest is cut from
    its documents in key order at the exact word: running sums inside (source, leading digits of the key) buckets plus
    a prefix sum over the buckets' totals, so a source with a third of all rows is spread over 4096 groups. The document
    at the cut gives only its first words; ``epochs`` counts it as a whole if at least half of it is taken. Null text
    has size 0; null sources form one source; null ids share a key; repeated rows count one by one; an empty table
    gives an empty result; a source without words has target 0.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"),
    ).withColumn("_key", F.md5(F.concat(F.lit(seed + "-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    rows = written(rows.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS)), "mix")  # read twice below, without the texts
    totals = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    targets = source_targets(totals.groupBy("source").agg(F.sum("_sum").alias("source_size")), **how)
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    starts = starts.join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", F.asc_nulls_first("doc_id"), "size")
    summed = rows.withColumn("_in", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = with_small(summed, starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")), "inner", 120)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.round(F.col("target")).cast("long") - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("_start") + F.col("_in") - F.col("size")))).cast("long")
    return joined.select(
        "doc_id", "size", "source", "source_size", "target", (whole * F.col("size") + part).alias("taken"),
        (whole + F.when((part > 0) & (part * 2 >= F.col("size")), 1).otherwise(0)).cast("int").alias("epochs"),
    )
