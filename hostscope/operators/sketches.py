"""Quantile sketches that merge: taken once a day or slice, then joined to any horizon, window or coarser group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.operators import selection
from hostscope.operators.baselines import MIN_SUPPORT, in_horizons, long_metrics
from hostscope.sources.scratch import written

#: Items that a sketch keeps on its top level. A group of fewer rows keeps all; beyond, a quantile's rank is off by some
#: 2.3 / K ** 0.9 of the rows at most (99 % of the time).
K = 4096


def metric_sketches(df: DataFrame, metrics: Sequence[str], keys: Sequence[str], k: int = K) -> DataFrame:
    """Long form (keys, metric, sketch, support): one sketch of the clean rows (weight 1 or more, where there are
    weights) and the number of all. Partial sketches are merged before and after one shuffle."""
    clean = F.when(F.col("anomaly_weight") >= 1, F.col("value")) if "anomaly_weight" in df.columns else F.col("value")
    kept = ["anomaly_weight"] if "anomaly_weight" in df.columns else []
    long = long_metrics(df.select(*keys, *kept, *metrics), metrics)
    return long.groupBy(*keys, "metric").agg(F.kll_sketch_agg_double(F.when(~F.isnan(clean), clean), F.lit(k)).alias("sketch"), F.count("value").alias("support"))


def daily_sketches(df: DataFrame, metrics: Sequence[str], keys: Sequence[str], ts: str = "window_end_ts", k: int = K) -> DataFrame:
    """Sketches by day: a day's rows are read once, whatever horizons they serve later."""
    return metric_sketches(df.withColumn("day", F.to_date(ts)), metrics, [*keys, "day"], k)


def merged(sketches: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """Sketches and supports joined by coarser keys (and metric): longer times, segments of hosts, windows of slices."""
    return sketches.groupBy(*keys, "metric").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("support").alias("support"))


def quantile(sketch: Column, levels: Sequence[float]) -> Column:
    """The least values that hold the levels' share of a sketch's rows; null for an empty one."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in levels])))


def exact_quantiles(sketches: DataFrame, rows: DataFrame, keys: Sequence[str], levels: Sequence[float], name: str = "_q", k: int = K) -> DataFrame:
    """(keys, metric, support) with the exact least values that hold the levels' shares of a merged sketch's rows.

    A sketch of fewer than k / 2 rows keeps them all and answers itself. For larger ones it gives brackets of several times
    its error, and ranks are counted in ``rows`` (keys, metric, value), the clean rows that the sketches are of.
    """
    on = [*keys, "metric"]
    key, v = F.struct(*on).alias("_key"), F.col("value").cast("double")
    around = selection.around_levels(levels, 10 / k**0.9)
    n = F.coalesce(F.kll_sketch_get_n_double("sketch"), F.lit(0))
    marks = written(sketches.select(key, quantile(F.col("sketch"), levels).alias("_q"), quantile(F.col("sketch"), around).alias("_b"), n.alias("_all"), "support"), "marks")
    out = selection.refined(marks, rows.select(key, F.when(~F.isnan(v), v).alias("_v")), levels, k // 2)
    return out.select(*[F.col("_key").getField(c).alias(c) for c in on], "support", F.col("_q").alias(name))


def sketched_baselines(sketches: DataFrame, bounds: DataFrame, keys: Sequence[str], min_support: int = MIN_SUPPORT, k: int = K, rows: DataFrame | None = None, ts: str = "window_end_ts") -> DataFrame:
    """The statistics of ``baselines`` by (keys, horizon, metric) from daily sketches; horizons are whole days.

    A new day adds its sketches and every horizon is a merge, so no history is read again. With ``rows`` (keys, ts, metric,
    value: what the sketches are of) quantiles are exact, and history is read for groups that are too large for a sketch.
    """
    held = in_horizons(sketches.withColumn("_day_ts", F.col("day").cast("timestamp")), bounds, "_day_ts")
    on, levels = [*keys, "baseline_horizon"], [0.25, 0.5, 0.75, 0.95, 0.99]
    out = merged(held, on, k)
    out = out.withColumn("_q", quantile(F.col("sketch"), levels)) if rows is None else exact_quantiles(out, in_horizons(rows, bounds, ts), on, levels, "_q", k)
    q = lambda i: F.get("_q", F.lit(i))
    iqr = q(2) - q(0)
    return out.select(
        *keys, "baseline_horizon", "metric", q(1).alias("median"), q(0).alias("p25"), q(2).alias("p75"), q(3).alias("p95"), q(4).alias("p99"), iqr.alias("iqr"),
        (iqr / 1.349).alias("mad"), F.col("support").alias("support_count"), (F.col("support") < min_support).cast("int").alias("is_cold_start"),
    )
