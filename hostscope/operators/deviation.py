"""Deviation of windows from baselines: cold-start routing, rarity with fallback, transforms and composite scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = ("median", "p25", "p75", "p95", "p99", "iqr", "mad", "support_count")
TRANSFORMS = ("diff", "ratio", "z_mad", "abs_dev_over_mad", "z_mad_clipped", "z_mad_cube", "log_ratio")
EPS, Z_MAX = 1e-6, 6.0
RARITY = ("pair_seen_count", "pair_last_seen_ts", "active_days", "pair_daily_avg", "pair_rarity_score", "is_rare_pair_flag")


def check_keys(keys: Sequence[str], expected: Sequence[str]) -> None:
    if set(keys) != set(expected):
        raise ValueError(f"host baselines join on {', '.join(expected)}, not on {', '.join(keys)}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with several rows on a build side, which would multiply the rows joined with it."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_rows(**tables: DataFrame) -> None:
    """Raises, naming them, if any of these inputs is empty."""
    if empty := [name for name, df in tables.items() if df.isEmpty()]:
        raise ValueError(f"no rows in {', '.join(empty)}")


def check_statistics(columns: Sequence[str], metrics: Sequence[str], statistics: Sequence[str] = STATISTICS) -> None:
    if missing := [f"{m}_{s}" for m in metrics for s in statistics if f"{m}_{s}" not in columns]:
        raise ValueError(f"baselines lack {', '.join(missing)}")


def _aliased(df: DataFrame, alias: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{alias}{c}") for c in df.columns])


def route_baselines(df: DataFrame, flags: DataFrame, hosts: DataFrame, segments: DataFrame, metrics: Sequence[str], flag_keys: Sequence[str], host_keys: Sequence[str], segment_keys: Sequence[str], statistics: Sequence[str] = STATISTICS) -> DataFrame:
    """Each row with its host's statistics, or its segment's if the host is cold; a host without a flag is cold.

    Two left joins and a choice of columns in one plan; rows are neither split nor united again.
    """
    def join(left: DataFrame, right: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
        r = _aliased(right, alias)
        on = [F.col(k).eqNullSafe(F.col(alias + k)) if k == "baseline_horizon" else F.col(k) == F.col(alias + k) for k in keys]
        return left.join(r, on, "left")

    out = join(df, flags.select(*flag_keys, "is_cold_start"), flag_keys, "f__")
    out = join(out, hosts, host_keys, "h__")
    out = join(out, segments, segment_keys, "s__")
    cold = F.coalesce(F.col("f__is_cold_start"), F.lit(1))
    return out.select(
        *df.columns, cold.alias("is_cold_start"), F.when(cold == 1, "segment").otherwise("host").alias("baseline_source"),
        *[F.when(cold == 1, F.col(f"s__{m}_{s}")).otherwise(F.col(f"h__{m}_{s}")).alias(f"{m}_{s}") for m in metrics for s in statistics],
    )


def attach_pair_context(df: DataFrame, pairs: DataFrame, keys: Sequence[str] = ("host_ip", "window_label", "window_end_ts")) -> DataFrame:
    """A separate output of pair grain: a row of df for each of its pairs (one with nulls where it has none)."""
    extra = [c for c in pairs.columns if c in keys or c not in df.columns]
    return df.join(pairs.select(*extra), list(keys), "left")


def attach_rarity(df: DataFrame, host: DataFrame, segment: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Pair rarity of (host, peer, port), else of (segment, peer, port), else defaults; pair_rarity_source tells which."""
    h = host.select(*[F.col(c).alias(f"h__{c}") for c in ("host_ip", "dst_ip", "dst_port", *RARITY)])
    s = segment.select(*[F.col(c).alias(f"s__{c}") for c in ("segment_id", "dst_ip", "dst_port", *RARITY)])
    out = df.join(h, [F.col(c) == F.col(f"h__{c}") for c in ("host_ip", "dst_ip", "dst_port")], "left")
    out = out.join(s, [F.col(c) == F.col(f"s__{c}") for c in ("segment_id", "dst_ip", "dst_port")], "left")
    source = F.when(F.col("h__pair_seen_count").isNotNull(), "host").when(F.col("s__pair_seen_count").isNotNull(), "segment").otherwise("none")
    defaults = defaults or {"pair_seen_count": 0, "active_days": 0, "pair_daily_avg": 0.0, "pair_rarity_score": 1.0, "is_rare_pair_flag": 1}
    fill = lambda c: F.coalesce(F.col(f"h__{c}"), F.col(f"s__{c}"), *([F.lit(defaults[c])] if c in defaults else []))
    return out.select(*df.columns, *[fill(c).alias(c) for c in RARITY], source.alias("pair_rarity_source"))


def _z(value: Column, median: Column, mad: Column, iqr: Column, eps: float) -> Column:
    diff = value - median
    return F.when(mad > 0, diff / (mad + eps)).when(iqr > 0, diff / (iqr + eps)).when(value.isNotNull() & median.isNotNull(), F.lit(0.0))


def transform_columns(metric: str, chosen: Sequence[str] = TRANSFORMS, eps: float = EPS, z_max: float = Z_MAX) -> list[Column]:
    """Deviation transforms of one metric against <metric>_median, _mad and _iqr, as columns for one select."""
    x, median, mad, iqr = F.col(metric), F.col(f"{metric}_median"), F.col(f"{metric}_mad"), F.col(f"{metric}_iqr")
    z = _z(x, median, mad, iqr, eps)
    clipped = F.greatest(F.least(z, F.lit(z_max)), F.lit(-z_max))
    forms = {
        "diff": x - median, "ratio": x / (median + eps), "z_mad": z, "abs_dev_over_mad": F.abs(x - median) / (mad + eps), "z_mad_clipped": clipped,
        "z_mad_cube": F.signum(clipped) * F.pow(F.abs(clipped), F.lit(3.0)), "log_ratio": F.log((x + eps) / (median + eps)),
    }
    return [forms[t].alias(f"{metric}_{t}") for t in chosen]


def transforms(df: DataFrame, metrics: Sequence[str], chosen: Sequence[str] = TRANSFORMS, eps: float = EPS, z_max: float = Z_MAX) -> DataFrame:
    return df.select("*", *[c for m in metrics for c in transform_columns(m, chosen, eps, z_max)])


def tail_columns(metric: str, eps: float = EPS) -> list[Column]:
    """Excess over p95, ratio to p95, and deviation in IQRs."""
    x, p95, iqr = F.col(metric), F.col(f"{metric}_p95"), F.col(f"{metric}_iqr")
    return [
        F.greatest(x - p95, F.lit(0.0)).alias(f"{metric}_excess_over_p95"), (x / (p95 + eps)).alias(f"{metric}_ratio_p95"),
        F.when(iqr > 0, (x - F.col(f"{metric}_median")) / iqr).otherwise(0.0).alias(f"{metric}_iqr_dev"),
    ]


def time_band_violation(band: Column, score: Column, threshold: float = 3.0) -> Column:
    """Activity well off the baseline outside working hours."""
    return ((band != "work") & (score >= threshold)).cast("int")


def group_score(metrics: Sequence[str]) -> Column:
    """The greatest |z| of a group of metrics; null if all are null."""
    return F.array_max(F.transform(F.array(*[F.col(f"{m}_z_mad") for m in metrics]), lambda z: F.abs(z)))


def scores(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """<group>_score columns and the indicator copies of those other than the core."""
    out = df.withColumns({f"{g}_score": group_score(ms) for g, ms in groups.items()})
    return out.withColumns({f"{g}_indicator": F.col(f"{g}_score") for g in groups if g != "core_anomaly"})


def rarity_weighted(df: DataFrame, metric: str) -> DataFrame:
    """z weighted by pair rarity, and the rare-pair flag of the row."""
    z = F.coalesce(f"{metric}_z_mad", F.lit(0.0))
    return df.withColumns({f"{metric}_rarity_weighted_z": z * F.coalesce("pair_rarity_score", F.lit(0.0)), "has_rare_pair": F.coalesce("is_rare_pair_flag", F.lit(0))})
