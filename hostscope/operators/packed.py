"""Hundreds of metrics as arrays in catalogue order: one expression over zipped arrays, so plans don't grow with metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.operators.deviation import EPS, Z_MAX

STATISTICS = ("median", "p95", "iqr", "mad")


def pack(df: DataFrame, metrics: Sequence[str], name: str = "values") -> DataFrame:
    """Metric columns become one array of doubles in the order of the catalogue."""
    return df.select(*[c for c in df.columns if c not in metrics], F.array(*[F.col(m).cast("double") for m in metrics]).alias(name))


def long_values(df: DataFrame, keys: Sequence[str], name: str = "values") -> DataFrame:
    """(keys, place, value): a row a metric, by its place in the catalogue."""
    return df.select(*keys, F.posexplode(name).alias("place", "value"))


def packed_statistics(df: DataFrame, keys: Sequence[str], width: int, name: str = "values", accuracy: int = 10_000) -> DataFrame:
    """(keys, stats): an array of (median, p95, iqr, mad) in catalogue order, null where a metric has no value.

    One aggregate for all metrics in long form, and a roll-up whose arrays are as long as the catalogue.
    """
    q = F.percentile_approx("value", [0.25, 0.5, 0.75, 0.95], accuracy)
    stats = long_values(df, keys, name).groupBy(*keys, "place").agg(q.alias("_q"))
    at = lambda i: F.get("_q", F.lit(i))
    iqr = at(2) - at(0)
    one = F.struct(at(1).alias("median"), at(3).alias("p95"), iqr.alias("iqr"), (iqr / 1.349).alias("mad"))
    held = stats.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("place", one.alias("s")))).alias("_m"))
    return held.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.try_element_at("_m", i)).alias("stats"))


def _z(x: Column, s: Column, eps: float) -> Column:
    diff = x - s["median"]
    return F.when(s["mad"] > 0, diff / (s["mad"] + eps)).when(s["iqr"] > 0, diff / (s["iqr"] + eps)).when(x.isNotNull() & s["median"].isNotNull(), F.lit(0.0))


def route(df: DataFrame, cold: Column, hosts: DataFrame, segments: DataFrame, host_keys: Sequence[str], segment_keys: Sequence[str]) -> DataFrame:
    """Each row with its host's array of statistics, or its segment's if the host is cold: two joins and one choice."""
    out = df.withColumn("is_cold_start", cold.cast("int"))
    out = out.join(hosts.withColumnRenamed("stats", "_host_stats"), list(host_keys), "left").join(segments.withColumnRenamed("stats", "_segment_stats"), list(segment_keys), "left")
    source = F.when(F.col("is_cold_start") == 1, "segment").otherwise("host")
    chosen = F.when(F.col("is_cold_start") == 1, F.col("_segment_stats")).otherwise(F.col("_host_stats"))
    return out.withColumns({"baseline_source": source, "stats": chosen}).drop("_host_stats", "_segment_stats")


def transforms(df: DataFrame, name: str = "values", stats: str = "stats", eps: float = EPS, z_max: float = Z_MAX) -> DataFrame:
    """An array column for each deviation transform of all metrics; the formulas are those of ``deviation``."""
    each = lambda f: F.zip_with(name, stats, f)
    out = df.withColumn("z_mad", each(lambda x, s: _z(x, s, eps)))
    out = out.withColumns({
        "diff": each(lambda x, s: x - s["median"]), "ratio": each(lambda x, s: x / (s["median"] + eps)), "abs_dev_over_mad": each(lambda x, s: F.abs(x - s["median"]) / (s["mad"] + eps)),
        "log_ratio": each(lambda x, s: F.log((x + eps) / (s["median"] + eps))), "z_mad_clipped": F.transform("z_mad", lambda z: F.greatest(F.least(z, F.lit(z_max)), F.lit(-z_max))),
    })
    return out.withColumn("z_mad_cube", F.transform("z_mad_clipped", lambda z: z * z * z))


def group_scores(df: DataFrame, groups: Mapping[str, Sequence[int]], z: str = "z_mad") -> DataFrame:
    """<group>_score: the greatest |z| of the metrics at a group's places; null if all are null."""
    return df.withColumns({f"{g}_score": F.array_max(F.transform(F.array(*map(F.lit, places)), lambda i: F.abs(F.get(F.col(z), i)))) for g, places in groups.items()})


def unpacked(df: DataFrame, catalogue: Sequence[str], wanted: Sequence[str], name: str) -> list[Column]:
    """Columns <metric>_<name> of the wanted metrics, for readers that need them by name."""
    place = {m: i for i, m in enumerate(catalogue)}
    return [F.get(F.col(name), F.lit(place[m])).alias(f"{m}_{name}") for m in wanted]
