"""Exact quantiles by distributed selection: sketches bracket each one, ranks are counted, and only brackets are sorted."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostscope.sources.scratch import written

#: A sketch's quantile is off by a share of 1 / ACCURACY in rank at most.
ACCURACY = 10_000


def around_levels(levels: Sequence[float], error: float) -> list[float]:
    """Two levels around each one, an error apart from it."""
    return [x for p in levels for x in (max(0.0, p - error), min(1.0, p + error))]


def _counted(rows: DataFrame, marks: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Distinct values inside of each bracket with the rows up to them, and the rows below with the neighbours outside.

    rows: _key, _v; marks: _key and _b, the two ends of each level's bracket.
    """
    low, high = (lambda k: F.get("_b", F.lit(2 * k))), (lambda k: F.get("_b", F.lit(2 * k + 1)))
    held = rows.join(marks.select("_key", "_b"), "_key")
    x = F.col("_v")
    sides = held.groupBy("_key").agg(F.array(*[F.struct(F.lit(k).alias("k"), F.count_if(x < low(k)).alias("below"), F.max(F.when(x < low(k), x)).alias("under"), F.min(F.when(x > high(k), x)).alias("over")) for k in range(levels)]).alias("_s"))
    sides = sides.select("_key", F.inline("_s"))
    inside = held.select("_key", "_v", F.explode(F.array_compact(F.array(*[F.when((x >= low(k)) & (x <= high(k)), F.lit(k)) for k in range(levels)]))).alias("k"))
    inside = inside.groupBy("_key", "k", "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_key", "k").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return inside.withColumn("_upto", F.sum("_n").over(upto)), sides


def quantiles(long: DataFrame, keys: Sequence[str], levels: Sequence[float], name: str = "q", value: str = "value", accuracy: int = ACCURACY) -> DataFrame:
    """(keys, q, rows): each key's exact quantiles at the levels as an array, interpolated between neighbours, and its rows.

    A sketch of each key (combined before its shuffle) gives two values around each quantile, a few ranks' error apart.
    A second pass counts the rows below each bracket and the distinct values inside, so ranks are exact; a task sorts
    one bracket's distinct values: a share of 4 / accuracy of a key's rows, never a key. A neighbour just outside of a
    bracket is the greatest value below or the least above. Null and NaN values go; keys may be null; a key without
    values has no row.
    """
    v = F.col(value).cast("double")
    rows = long.where(v.isNotNull() & ~F.isnan(v)).select(F.struct(*keys).alias("_key"), v.alias("_v"))
    around = around_levels(levels, 2 / accuracy)
    marks = rows.groupBy("_key").agg(F.percentile_approx("_v", around, accuracy).alias("_b"), F.count(F.lit(1)).alias("_all"))
    marks = written(marks, "brackets")
    x = F.col("_v")
    inside, sides = _counted(rows, marks, len(levels))
    level = F.get(F.array(*[F.lit(float(p)) for p in levels]), "k")
    place = level * (F.col("_all") - 1)
    first = F.floor(place)
    last = F.least(first + 1, F.col("_all") - 1)
    both = inside.join(sides, ["_key", "k"]).join(marks.select("_key", "_all"), "_key").withColumns({"_first": first, "_last": last, "_part": place - first})
    at = lambda rank: F.min(F.when(F.col("below") + F.col("_upto") > F.col(rank), x))
    each = both.groupBy("_key", "k", "_all", "_part").agg(
        F.when(F.max(F.col("_first") < F.col("below")), F.max("under")).otherwise(at("_first")).alias("_a"),
        F.when(F.max(F.col("_last") < F.col("below")), F.max("under")).otherwise(F.coalesce(at("_last"), F.max("over"))).alias("_z"),
    )
    # between equal neighbours, infinite ones too, there is nothing to share
    q = F.when((F.col("_part") == 0) | (F.col("_a") == F.col("_z")), F.col("_a")).otherwise(F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_part"))
    out = each.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("k", q.alias("v")))).alias("_q"), F.max("_all").alias("rows"))
    return out.select(*[F.col("_key").getField(k).alias(k) for k in keys], F.transform("_q", lambda e: e["v"]).alias(name), "rows")


def _at_ranks(rows: DataFrame, marks: DataFrame, levels: Sequence[float]) -> DataFrame:
    """(_key, k, v): the value of each level's rank, ceil(level * rows); null if the bracket doesn't hold it."""
    inside, sides = _counted(rows, marks, len(levels))
    exact = [Fraction(str(p)) for p in levels]
    part = lambda name: F.get(F.array(*[F.lit(getattr(f, name)) for f in exact]), "k")
    rank = F.greatest(F.lit(1), F.ceil(F.col("_all") * part("numerator") / part("denominator")))
    both = inside.join(sides.select("_key", "k", "below"), ["_key", "k"]).join(marks.select("_key", "_all"), "_key").withColumn("_rank", rank)
    return both.groupBy("_key", "k").agg(F.when(F.max(F.col("below") < F.col("_rank")), F.min(F.when(F.col("below") + F.col("_upto") >= F.col("_rank"), F.col("_v")))).alias("v"))


def refined(marks: DataFrame, rows: DataFrame, levels: Sequence[float], whole: int) -> DataFrame:
    """The marks with exact discrete quantiles in _q, for keys of ``whole`` rows or more; below that a sketch keeps all rows.

    marks: _key, _q (a sketch's quantiles), _b (the ends of a bracket around each), _all (the key's rows) and others;
    rows: _key, _v. Whether a rank lies in its bracket is counted; for a key whose sketch missed, all its values are in.
    """
    large = written(marks.where(F.col("_all") >= whole).select("_key", "_b", "_all"), "large-keys")
    if large.isEmpty():
        return marks.drop("_b")
    rows = rows.where("_v is not null")
    found = written(_at_ranks(rows, large, levels), "ranks")
    missed = found.where("v is null").select("_key").distinct()
    if not missed.isEmpty():
        ends = F.array(*[F.lit(x) for _ in levels for x in (float("-inf"), float("inf"))])
        again = _at_ranks(rows, large.join(missed, "_key", "left_semi").withColumn("_b", ends), levels)
        found = found.join(missed, "_key", "left_anti").unionByName(again)
    exact = found.groupBy("_key").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "v"))), lambda e: e["v"]).alias("_exact"))
    return marks.drop("_b").join(exact, "_key", "left").withColumn("_q", F.coalesce("_exact", "_q")).drop("_exact")


def discrete(long: DataFrame, keys: Sequence[str], levels: Sequence[float], name: str = "q", value: str = "value", also: Sequence[Column] = (), accuracy: int = ACCURACY) -> DataFrame:
    """(keys, q, rows): each key's least values that hold the levels' shares of its rows, exactly; further aggregates too.

    One aggregate serves keys of fewer than accuracy / 2 rows, whose sketch keeps every row. For larger ones it gives a
    bracket around each rank, and a second pass counts (see ``refined``), so no task sorts a key. Null and NaN values
    don't count; a key without values stays, with a null array.
    """
    v = F.col(value).cast("double")
    key, kept = F.struct(*keys).alias("_key"), F.when(~F.isnan(v), v)
    n, asked = len(levels), [*levels, *around_levels(levels, 2 / accuracy)]
    marks = long.groupBy(key).agg(F.percentile_approx(kept, [float(p) for p in asked], accuracy).alias("_p"), F.count(kept).alias("_all"), *also)
    marks = written(marks.withColumns({"_q": F.slice("_p", 1, n), "_b": F.slice("_p", n + 1, 2 * n)}).drop("_p"), "marks")
    out = refined(marks, long.select(key, kept.alias("_v")), levels, accuracy // 2)
    rest = [c for c in marks.columns if c not in ("_key", "_q", "_b", "_all")]
    return out.select(*[F.col("_key").getField(k).alias(k) for k in keys], F.col("_q").alias(name), F.col("_all").alias("rows"), *rest)


def median_deviation(long: DataFrame, keys: Sequence[str], medians: DataFrame, median: str = "median", name: str = "mad", of: Callable[..., DataFrame] = quantiles) -> DataFrame:
    """(keys, mad): the exact median of |value - median| of each key; medians has a row a key."""
    held = medians.select(F.struct(*keys).alias("_k"), F.col(median).alias("_median"))
    off = long.join(held, F.struct(*keys) == F.col("_k")).withColumn("value", F.abs(F.col("value") - F.col("_median")))
    return of(off.select(*keys, "value"), keys, [0.5]).select(*keys, F.get("q", F.lit(0)).alias(name))
