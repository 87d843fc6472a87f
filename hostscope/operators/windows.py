"""Look-back windows over slices, in one scan for all windows, and the wide and long forms of their metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostscope.functions.net import record_id, time_context

#: Minutes of each window.
WINDOWS = {"w_15m": 15, "w_30m": 30, "w_1h": 60, "w_8h": 480, "w_24h": 1440}
#: Counters that add up over slices; a burst takes the greatest.
SUMMED = ("sessions_cnt", "bytes_sent_sum", "bytes_recv_sum", "duration_sum", "drop_cnt", "tcp_cnt", "udp_cnt", "icmp_cnt", "high_risk_port_sessions_cnt")
EPS = 1e-9


def anchor(df: DataFrame, ts: str = "slice_end_ts") -> DataFrame:
    """One row: the latest slice end as anchor_ts."""
    return df.agg(F.max(ts).alias("anchor_ts"))


def in_windows(df: DataFrame, anchor_ts: str, windows: Mapping[str, int] = WINDOWS, ts: str = "slice_end_ts") -> DataFrame:
    """Each slice once for every window (anchor - w, anchor] that holds it, with window_label and bounds.

    The widest window bounds the scan; the windows of a slice are an inlined array, so no window rescans the input.
    """
    end = F.lit(anchor_ts).cast("timestamp")
    reach = max(windows.values())
    kept = df.where((F.col(ts) > F.timestamp_add("MINUTE", F.lit(-reach), end)) & (F.col(ts) <= end))
    rows = F.array(*[F.struct(F.lit(k).alias("window_label"), F.lit(m).alias("_m")) for k, m in windows.items()])
    holds = F.filter(rows, lambda w: F.col(ts) > F.timestamp_add("MINUTE", -w["_m"], end))
    out = kept.select("*", F.inline(holds))
    return out.withColumns({"window_start_ts": F.timestamp_add("MINUTE", -F.col("_m"), end), "window_end_ts": end}).drop("_m")


def window_sums(slices: DataFrame, anchor_ts: str, windows: Mapping[str, int] = WINDOWS, summed: Sequence[str] = SUMMED, greatest: Sequence[str] = ("max_sessions_per_minute",)) -> DataFrame:
    """Long form: metrics of each host, role and window."""
    keys = ["host_ip", "role", "window_label", "window_start_ts", "window_end_ts"]
    return in_windows(slices, anchor_ts, windows).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in summed if c in slices.columns], *[F.max(c).alias(c) for c in greatest if c in slices.columns],
    )


def with_ratios(df: DataFrame, eps: float = EPS) -> DataFrame:
    """Mean duration, denial ratio, byte asymmetry, protocol shares and the high-risk-port flag."""
    n = F.col("sessions_cnt") + eps
    sent, got = F.col("bytes_sent_sum"), F.col("bytes_recv_sum")
    return df.withColumns({
        "duration_mean": F.col("duration_sum") / n, "deny_ratio": F.col("drop_cnt") / n, "bytes_asymmetry_ratio": (sent - got) / (sent + got + eps),
        "tcp_ratio": F.col("tcp_cnt") / n, "udp_ratio": F.col("udp_cnt") / n, "icmp_ratio": F.col("icmp_cnt") / n,
        "has_high_risk_port": (F.col("high_risk_port_sessions_cnt") > 0).cast("int"),
    })


def pair_windows(pairs: DataFrame, anchor_ts: str, windows: Mapping[str, int] = WINDOWS) -> DataFrame:
    """Pair context of each window: summed sessions, last event."""
    keys = ["host_ip", "role", "peer_ip", "peer_port", "window_label", "window_end_ts"]
    return in_windows(pairs, anchor_ts, windows).groupBy(*keys).agg(F.sum("sessions_cnt").alias("sessions_cnt"), F.max("event_ts").alias("event_ts"))


def rolling(slices: DataFrame, minutes: int, metrics: Sequence[str] = ("sessions_cnt",), keys: Sequence[str] = ("host_ip", "role"), ts: str = "slice_end_ts") -> DataFrame:
    """The sum over (t - w, t] at every slice end t, by a range frame on whole seconds."""
    w = Window.partitionBy(*keys).orderBy("_s").rangeBetween(-(minutes * 60 - 1), 0)
    return slices.withColumn("_s", F.unix_seconds(ts)).withColumns({f"{m}_{minutes}m": F.sum(m).over(w) for m in metrics}).drop("_s")


def wide_by_role(long: DataFrame, metrics: Sequence[str], inbound: str = "in_") -> DataFrame:
    """One row a host and window: outbound metrics under their names, inbound ones prefixed; hosts of either role are kept.

    The full outer join of the two roles is a conditional aggregate here, so the input is read and shuffled once.
    """
    of = lambda c, role: F.max(F.when(F.col("role") == role, F.col(c)))
    return long.groupBy("host_ip", "window_label", "window_start_ts", "window_end_ts").agg(
        *[of(m, "outbound").alias(m) for m in metrics], *[of(m, "inbound").alias(inbound + m) for m in metrics],
    )


def long_by_role(wide: DataFrame, metrics: Sequence[str], inbound: str = "in_") -> DataFrame:
    """The inverse: a row a role, without rows whose metrics are all null."""
    rest = [c for c in wide.columns if c not in metrics and c not in {inbound + m for m in metrics}]
    views = [F.struct(F.lit(role).alias("role"), *[F.col(p + m).alias(m) for m in metrics]) for role, p in (("outbound", ""), ("inbound", inbound))]
    return wide.select(*rest, F.inline(F.array(*views))).where(F.coalesce(*metrics).isNotNull())


def stamp(df: DataFrame, version: str, batch_id: str, zone: str = "UTC") -> DataFrame:
    """Time context of the window end, version, batch and the record id."""
    return df.select("*", *time_context(F.col("window_end_ts"), zone), F.lit(version).alias("feature_spec_version"), F.lit(batch_id).alias("mini_batch_id")).withColumn(
        "record_id", record_id("host_ip", "window_label", F.date_format("window_end_ts", "yyyy-MM-dd'T'HH:mm:ss"), "mini_batch_id")
    )
