"""Baselines: robust statistics of hosts and segments over horizons, anomaly capping, pair rarity and host flags."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostscope.operators import selection
from hostscope.sources.scratch import written

HOST_KEYS = ("host_ip", "role", "window_label", "time_band")
SEGMENT_KEYS = ("segment_id", "role", "window_label", "time_band")
MIN_SUPPORT = 50


@dataclass(frozen=True)
class Horizon:
    """A baseline horizon: days of history, cut at both ends."""

    name: str
    days: int
    tail_days: int = 0
    head_days: int = 0


HORIZONS = (Horizon("7d", 7), Horizon("30d", 30))


def horizon_bounds(spark: SparkSession, reference: str, horizons: Sequence[Horizon] = HORIZONS) -> DataFrame:
    """end = reference - head, start = end - (days + tail): one row a horizon."""
    rows = spark.createDataFrame([(h.name, h.days, h.tail_days, h.head_days) for h in horizons], "baseline_horizon string, days int, tail int, head int")
    ref = F.lit(reference).cast("timestamp")
    end = F.timestamp_add("DAY", -F.col("head"), ref)
    return rows.select("baseline_horizon", F.timestamp_add("DAY", -(F.col("days") + F.col("tail")), end).alias("baseline_start_ts"), end.alias("baseline_end_ts"))


def in_horizons(df: DataFrame, bounds: DataFrame, ts: str = "window_end_ts") -> DataFrame:
    """Each row once for every horizon that holds it; the bounds are a row a horizon."""
    return df.join(F.broadcast(bounds), (F.col(ts) >= F.col("baseline_start_ts")) & (F.col(ts) < F.col("baseline_end_ts")))


def _middles(df: DataFrame, metrics: Sequence[str], keys: Sequence[str], of: Callable[..., DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Medians and MADs of each key as columns _med_ and _mad_, by exact selection: one metric's group may be of any size."""
    on = [*keys, "metric"]
    long = long_metrics(df.select(*keys, *metrics), metrics)
    middle = written(of(long, on, [0.5]).select(*on, F.get("q", F.lit(0)).alias("median")), "middles")
    mad = selection.median_deviation(long, on, middle, of=of)
    wide = lambda d, c, name: d.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{name}{m}") for m in metrics])
    return wide(middle, "median", "_med_"), wide(mad, "mad", "_mad_")


def anomaly_weights(df: DataFrame, metrics: Sequence[str], z_max: float = 6.0, low: float = 0.2, keys: Sequence[str] = SEGMENT_KEYS, exact: bool = False, eps: float = 1e-6) -> DataFrame:
    """Weights of rows by their greatest robust |z| in their segment: ``low`` above z_max, else 1.

    Median and true MAD are exact and joined back; their rows number segments, not hosts. ``exact`` interpolates between
    the middle neighbours, else the lower one is the median. df is read several times: write it first if it is dear.
    """
    on = list(keys)
    middle, mad = _middles(df, metrics, on, selection.quantiles if exact else selection.discrete)
    joined = df.join(middle, on).join(written(mad, "deviations"), on)
    z = [F.abs((F.col(m) - F.col(f"_med_{m}")) / (F.col(f"_mad_{m}") + eps)) for m in metrics]
    out = joined.withColumn("max_abs_z", F.array_max(F.array(*z)))
    out = out.withColumn("anomaly_weight", F.when(F.col("max_abs_z") > z_max, low).otherwise(1.0))
    return out.drop(*[f"_med_{m}" for m in metrics], *[f"_mad_{m}" for m in metrics])


def long_metrics(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """metric and value as rows; one aggregate then serves any number of metrics."""
    rest = [c for c in df.columns if c not in metrics]
    return df.select(*rest, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))


def long_totals(df: DataFrame, metrics: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, metric, n, total): counts and sums in one wide aggregate, long only after its shuffle, which so carries a row a
    key, not one a metric."""
    x = {m: F.col(m).cast("double") for m in metrics}
    wide = df.groupBy(*keys).agg(*[F.struct(F.lit(m).alias("metric"), F.count(c).alias("n"), F.sum(c).alias("total")).alias(f"_{i}") for i, (m, c) in enumerate(x.items())])
    return wide.select(*keys, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(x))])))


def baselines(df: DataFrame, metrics: Sequence[str], keys: Sequence[str], min_support: int = MIN_SUPPORT, exact: bool = False) -> DataFrame:
    """Long form statistics by (keys, horizon, metric): median, p25, p75, p95, p99, iqr, mad, support_count, is_cold_start.

    Quantiles use clean rows (weight 1 or more), support counts all rows; a group without clean rows stays, with null
    statistics. Quantiles are exact in groups of any size: the least values that hold a level's share of the rows, or
    interpolated (``exact``). df is read again if there are large groups. mad is IQR / 1.349 (named mad_iqr_approx too).
    """
    clean = F.when(F.col("anomaly_weight") >= 1, F.col("value")) if "anomaly_weight" in df.columns else F.col("value")
    horizon = ["baseline_horizon"] if "baseline_horizon" in df.columns else []
    long, on, levels = long_metrics(df, metrics), [*keys, *horizon, "metric"], [0.25, 0.5, 0.75, 0.95, 0.99]
    if exact:
        picked = selection.quantiles(long.withColumn("value", clean), on, levels, "_q")
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in on]
        support = long.groupBy(*on).agg(F.count("value").alias("support_count"))
        stats = support.alias("a").join(picked.alias("b"), same, "left").select("a.*", "b._q")
    else:
        stats = selection.discrete(long.withColumn("_clean", clean), on, levels, "_q", "_clean", [F.count("value").alias("support_count")])
    q = lambda i: F.get("_q", F.lit(i))
    iqr = q(2) - q(0)
    return stats.select(
        *keys, *horizon, "metric", q(1).alias("median"), q(0).alias("p25"), q(2).alias("p75"), q(3).alias("p95"), q(4).alias("p99"), iqr.alias("iqr"),
        (iqr / 1.349).alias("mad"), "support_count", (F.col("support_count") < min_support).cast("int").alias("is_cold_start"),
    )


def wide_baselines(stats: DataFrame, keys: Sequence[str], metrics: Sequence[str], names: Sequence[str] = ("median", "p25", "p75", "p95", "p99", "iqr", "mad", "support_count")) -> DataFrame:
    """Columns <metric>_<statistic> for a requested list of metrics."""
    return stats.where(F.col("metric").isin(*metrics)).groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == m, F.col(n))).alias(f"{m}_{n}") for m in metrics for n in names])


def one_name_per_ip(machines: DataFrame) -> DataFrame:
    return machines.where("ip_address is not null").groupBy(F.col("ip_address").alias("host_ip")).agg(F.min("machine_name").alias("machine_name"))


def has_prefix(name: Column, prefixes: Sequence[str]) -> Column:
    """Whether a name starts with any prefix, in either case."""
    found = F.lit(False)
    for p in prefixes:
        found = found | F.lower(name).startswith(p.lower())
    return F.coalesce(found, F.lit(False))


def with_any_prefix(df: DataFrame, name: str, prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Rows whose name starts with any of a table of prefixes, in either case, each once.

    Each distinct name offers its beginnings of the lengths that prefixes have (a few, counted first), and these meet
    the prefixes in an equality join. So the cost is names times lengths, not names times prefixes.
    """
    p = prefixes.select(F.lower(prefix).alias("_prefix")).where("_prefix is not null").distinct()
    lengths = sorted(r[0] for r in p.select(F.length("_prefix")).distinct().collect())
    if not lengths:
        return df.limit(0)
    names = df.select(F.lower(name).alias("_name")).where("_name is not null").distinct()
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("_name"))
    offered = names.select("_name", F.explode(starts).alias("_n")).select("_name", F.substring("_name", F.lit(1), F.col("_n")).alias("_prefix"))
    found = offered.join(p, "_prefix", "left_semi").select("_name").distinct()
    return df.join(found, F.lower(F.col(name)) == F.col("_name"), "left_semi")


def host_flags(support: DataFrame, machines: DataFrame, prefixes: Sequence[str], keys: Sequence[str], column: str = "sessions_cnt_support_count", min_support: int = MIN_SUPPORT) -> DataFrame:
    """is_full_history, is_non_persistent_machine and is_cold_start of each host: cold if either speaks for it.

    A host has full history if its least support over bands and roles reaches the minimum.
    """
    least = support.groupBy(*keys).agg(F.min(column).alias("_s"))
    out = least.join(one_name_per_ip(machines), "host_ip", "left")
    full = F.coalesce(F.col("_s") >= min_support, F.lit(False))
    short = has_prefix(F.col("machine_name"), prefixes)
    return out.select(*keys, "machine_name", full.cast("int").alias("is_full_history"), short.cast("int").alias("is_non_persistent_machine"), (~full | short).cast("int").alias("is_cold_start"))


def pair_rarity(pairs: DataFrame, days: int, rare: int = 2, lookback: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rarity of (host, peer, port) and (segment, peer, port), in one GROUPING SETS aggregate; ``level`` tells them apart.

    Columns: seen count, last seen, active days, daily average, score 1 / (1 + n), rare flag, and new flag (absent from
    the look-back, where one is given). ``by`` names further keys, such as the horizon.
    """
    view = pairs.select(F.col("src_ip").alias("host_ip"), "segment_id", "dst_ip", "dst_port", *by, "sessions_cnt", "event_ts")
    sets = view.groupingSets([["host_ip", "dst_ip", "dst_port", *by], ["segment_id", "dst_ip", "dst_port", *by]], "host_ip", "segment_id", "dst_ip", "dst_port", *by)
    # a bit a day: no two of up to 64 consecutive days share one
    day = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.datediff("event_ts", F.lit("1970-01-01")), F.lit(64)))
    active = F.bit_count(F.bit_or(day)) if days <= 64 else F.count_distinct(F.to_date("event_ts"))
    out = sets.agg(
        F.sum("sessions_cnt").alias("pair_seen_count"), F.max("event_ts").alias("pair_last_seen_ts"), active.cast("long").alias("active_days"), F.grouping("host_ip").alias("_g"),
    )
    out = out.withColumns({
        "level": F.when(F.col("_g") == 0, "host").otherwise("segment"), "pair_daily_avg": F.col("pair_seen_count") / days,
        "pair_rarity_score": 1 / (1 + F.col("pair_seen_count").cast("double")), "is_rare_pair_flag": (F.col("pair_seen_count") <= rare).cast("int"),
    }).drop("_g")
    if lookback is None:
        return out
    known = lookback.select(F.col("src_ip").alias("host_ip"), "dst_ip", "dst_port").distinct().withColumn("_known", F.lit(1))
    return out.join(known, ["host_ip", "dst_ip", "dst_port"], "left").withColumn("is_new_pair_flag", (F.col("_known").isNull() & (F.col("level") == "host")).cast("int")).drop("_known")


def metric_lists(columns: Sequence[str], default: Sequence[str], configured: Sequence[str] = ()) -> list[str]:
    """Default and configured metrics that the columns hold, each once, in that order."""
    return [m for m in dict.fromkeys([*default, *configured]) if m in columns]


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


