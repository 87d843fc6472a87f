"""Slice metrics: roles, counters, bursts, quantiles and pair context in one pass over cleaned sessions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.functions.net import segment_id

LEVELS = (0.25, 0.5, 0.75, 0.95, 0.99)
SLICE_KEYS = ("host_ip", "role", "slice_start_ts", "slice_end_ts")


@dataclass(frozen=True)
class Role:
    """How raw columns read from the side of one host."""

    name: str
    host: str
    peer: str
    sent: str
    received: str
    peer_port: str = "destination_port"


ROLES = (Role("outbound", "source_ip", "destination_ip", "source_bytes", "destination_bytes"), Role("inbound", "destination_ip", "source_ip", "destination_bytes", "source_bytes"))


def stamp_slice(df: DataFrame, minutes: int = 15, ts: str = "event_start") -> DataFrame:
    """slice_start_ts, slice_end_ts, dt, hh, mm from each row's time."""
    step = minutes * 60
    start = F.timestamp_seconds(F.floor(F.unix_seconds(ts) / step) * step)
    out = df.withColumns({"slice_start_ts": start, "slice_end_ts": F.timestamp_seconds(F.floor(F.unix_seconds(ts) / step) * step + step)})
    return out.withColumns({"dt": F.date_format("slice_start_ts", "yyyy-MM-dd"), "hh": F.date_format("slice_start_ts", "HH"), "mm": F.date_format("slice_start_ts", "mm")})


def stamp_fixed_slice(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """One slice for all rows; a missing end is the greatest event end, joined as one row, without an action."""
    last = df.agg(F.max("event_end").alias("_last"))
    end_ts = F.lit(end).cast("timestamp") if end else F.col("_last")
    out = (df if end else df.crossJoin(F.broadcast(last))).withColumn("slice_end_ts", end_ts)
    out = out.withColumn("slice_start_ts", F.lit(start).cast("timestamp") if start else F.timestamp_add("MINUTE", F.lit(-15), F.col("slice_end_ts")))
    return out.drop("_last").withColumns({"dt": F.date_format("slice_end_ts", "yyyy-MM-dd"), "hh": F.date_format("slice_end_ts", "HH"), "mm": F.date_format("slice_end_ts", "mm")})


def role_views(df: DataFrame, roles: Sequence[Role] = ROLES) -> DataFrame:
    """Each session once a role, seen from its host; rows without a host go. One scan, whatever the number of roles."""
    views = [
        F.struct(
            F.lit(r.name).alias("role"), F.col(r.host).alias("host_ip"), F.col(r.peer).alias("peer_ip"),
            F.col(r.peer_port).cast("int").alias("peer_port"), F.col(r.sent).alias("bytes_sent"), F.col(r.received).alias("bytes_recv"),
        ) for r in roles
    ]
    return df.select("*", F.inline(F.array(*views))).where("host_ip is not null")


def _is(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def base_counters() -> list[Column]:
    """Session counts and sums of a slice; null bytes count as 0."""
    zero = lambda c: F.sum(F.coalesce(c, F.lit(0.0)))
    return [
        F.count(F.lit(1)).alias("sessions_cnt"), zero("bytes_sent").alias("bytes_sent_sum"), zero("bytes_recv").alias("bytes_recv_sum"), zero("duration_sec").alias("duration_sum"),
        _is("event_action", "allow").alias("allow_cnt"), _is("event_action", "drop").alias("drop_cnt"), _is("event_action", "alert").alias("alert_cnt"),
        F.count_if(F.col("event_reason").startswith("tcp-rst")).alias("rst_cnt"), _is("event_reason", "aged-out").alias("aged_out_cnt"),
        _is("event_name", "THREAT").alias("threat_cnt"), _is("event_name", "TRAFFIC").alias("traffic_cnt"),
        _is("network_transport", "TCP").alias("tcp_cnt"), _is("network_transport", "UDP").alias("udp_cnt"), _is("network_transport", "ICMP").alias("icmp_cnt"),
    ]


def port_counters(sets: Mapping[str, Sequence[int]]) -> list[Column]:
    """A session counter for each port set."""
    return [F.count_if(F.col("peer_port").isin(*ports)).alias(f"{name.lower()}_sessions_cnt") for name, ports in sets.items()]


def quantiles(columns: Sequence[str] = ("bytes_sent", "bytes_recv", "duration_sec"), levels: Sequence[float] = LEVELS, accuracy: int = 10_000) -> list[Column]:
    return [F.percentile_approx(c, list(levels), accuracy).alias(f"_{c}") for c in columns]


def _spread(columns: Sequence[str], levels: Sequence[float]) -> list[Column]:
    return [F.get(f"_{c}", F.lit(i)).alias(f"{c}_p{round(level * 100)}") for c in columns for i, level in enumerate(levels)]


def burst(rows: DataFrame, keys: Sequence[str] = SLICE_KEYS) -> DataFrame:
    """max_sessions_per_minute: counted by minute first, so no slice is gathered."""
    by_minute = rows.groupBy(*keys, F.date_trunc("minute", "event_start").alias("_minute")).agg(F.count(F.lit(1)).alias("_n"))
    return by_minute.groupBy(*keys).agg(F.max("_n").alias("max_sessions_per_minute"))


def slice_metrics(rows: DataFrame, sets: Mapping[str, Sequence[int]], keys: Sequence[str] = SLICE_KEYS, columns: Sequence[str] = ("bytes_sent", "bytes_recv", "duration_sec"), levels: Sequence[float] = LEVELS) -> DataFrame:
    """All slice metrics by two aggregates on the same keys: the counters with quantiles, and the bursts."""
    main = rows.groupBy(*keys).agg(*base_counters(), *port_counters(sets), *quantiles(columns, levels))
    out = main.join(burst(rows, keys), list(keys), "left")
    return out.select(*[c for c in out.columns if not c.startswith("_")], *_spread(columns, levels))


def pair_context(rows: DataFrame, keys: Sequence[str] = SLICE_KEYS) -> DataFrame:
    """Sessions and the last event of each host, role, peer and port in a slice."""
    out = rows.groupBy(*keys, "peer_ip", "peer_port").agg(F.count(F.lit(1)).alias("sessions_cnt"), F.max("event_start").alias("event_ts"))
    return out.withColumn("pair_key", F.concat_ws("|", "host_ip", "peer_ip", F.col("peer_port").cast("string")))


def shape(rows: DataFrame, keys: Sequence[str] = SLICE_KEYS, short_sec: float = 1.0) -> DataFrame:
    """Breadth and shape of a slice: distinct peers, ports and segments, entropies, top shares, zero replies, short sessions.

    Rows are counted by peer, by port and by segment in one GROUPING SETS aggregate; a second one rolls those up.
    """
    items = {"peer_ip": F.col("peer_ip"), "peer_port": F.col("peer_port"), "_segment": segment_id(F.col("peer_ip"))}
    view = rows.select(*keys, *[c.alias(i) for i, c in items.items()], "bytes_sent", "bytes_recv", "duration_sec")
    parts = view.groupingSets([[*keys, i] for i in items], *keys, *items).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.coalesce("bytes_sent", F.lit(0.0))).alias("_b"), F.count_if(F.coalesce("bytes_recv", F.lit(0.0)) == 0).alias("_zero"),
        F.count_if(F.col("duration_sec") < short_sec).alias("_short"), *[F.grouping(i).alias(f"_not_{i}") for i in items],
    )

    def of(item: str, c: Column) -> Column:
        return F.when(F.col(f"_not_{item}") == 0, c)

    def by(item: str) -> list[Column]:
        n, b = F.sum(of(item, F.col("_n"))), F.sum(of(item, F.col("_b")))
        # -sum p ln p with p = n / N is ln N - sum(n ln n) / N
        return [
            F.count(of(item, F.col(item))).alias(f"{item}_nunique"), (F.log(n) - F.sum(of(item, F.col("_n") * F.log("_n"))) / n).alias(f"{item}_entropy"),
            (F.max(of(item, F.col("_n"))) / n).alias(f"top1_{item}_sessions_share"), F.when(b > 0, F.max(of(item, F.col("_b"))) / b).otherwise(0.0).alias(f"top1_{item}_bytes_share"),
        ]

    return parts.groupBy(*keys).agg(
        *by("peer_ip"), *by("peer_port"), F.count(of("_segment", F.lit(1))).alias("peer_segment_nunique"),
        F.sum(of("_segment", F.col("_zero"))).alias("zero_reply_cnt"), F.sum(of("_segment", F.col("_short"))).alias("short_session_cnt"),
    )


def pair_counts(df: DataFrame, minutes: int = 15) -> DataFrame:
    """Sessions of each source, destination, port and segment in a slice; both addresses, a port above 0, traffic only."""
    kept = df.where("source_ip is not null and destination_ip is not null and destination_port > 0")
    if "event_name" in df.columns:
        kept = kept.where("event_name = 'TRAFFIC'")
    kept = stamp_slice(kept, minutes).withColumn("segment_id", segment_id(F.col("source_ip")))
    return kept.groupBy(
        F.col("source_ip").alias("src_ip"), F.col("destination_ip").alias("dst_ip"), F.col("destination_port").alias("dst_port"), "segment_id", "slice_start_ts", "slice_end_ts",
    ).agg(F.count(F.lit(1)).alias("sessions_cnt"), F.max("event_start").alias("event_ts"))
