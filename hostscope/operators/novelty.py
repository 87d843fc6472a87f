"""Novelty against a look-back table, and contact with high-risk segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.functions.net import segment_id


def lookback(pairs: DataFrame, start: str, end: str, ts: str = "slice_end_ts") -> DataFrame:
    """Known items of every host in [start, end): (host_ip, item, value, seen); seen counts the slices they were met in.

    item is peer, port or pair. One scan: the three grains are an inlined array and one aggregate.
    """
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return _items(pairs.where((F.col(ts) >= a) & (F.col(ts) < b))).groupBy("host_ip", "item", "value").agg(F.count(F.lit(1)).alias("seen"))


def _slot(day, days: int):
    return F.pmod(F.datediff(day, F.lit("1970-01-01")), F.lit(days))


def day_ring(pairs: DataFrame, start: str, days: int, ts: str = "slice_end_ts") -> DataFrame:
    """The look-back of ``days`` whole days from start, as state that can move on: (host_ip, item, value, counts).

    counts is a ring with one place a day: how many slices of that day the item was met in. It holds at most 64 days.
    """
    if not 1 <= days <= 64:
        raise ValueError("a ring holds 1 to 64 days")
    first = F.lit(start).cast("date")
    day = F.to_date(ts)
    rows = _items(pairs.where((day >= first) & (day < F.date_add(first, days))).withColumn("_slot", _slot(day, days)), "_slot")
    by_day = rows.groupBy("host_ip", "item", "value", "_slot").agg(F.count(F.lit(1)).alias("_n"))
    ring = F.map_from_entries(F.collect_list(F.struct("_slot", "_n")))  # an entry a day at most
    held = by_day.groupBy("host_ip", "item", "value").agg(ring.alias("_m"))
    return held.select("host_ip", "item", "value", F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.coalesce(F.element_at("_m", i), F.lit(0))).alias("counts"))


def advance_ring(ring: DataFrame, pairs: DataFrame, day: str, days: int, ts: str = "slice_end_ts") -> DataFrame:
    """The ring after one more day: its slices are counted and take the place of the day that expires.

    Only that day's pairs are read. Items that were met on none of the ring's days any more are dropped. Days have to
    come in order, without a gap.
    """
    today = F.lit(day).cast("date")
    now = _items(pairs.where(F.to_date(ts) == today)).groupBy("host_ip", "item", "value").agg(F.count(F.lit(1)).alias("_n"))
    both = ring.join(now, ["host_ip", "item", "value"], "full_outer")
    slot = _slot(today, days)
    old = F.coalesce("counts", F.array_repeat(F.lit(0).cast("long"), days))
    new = F.transform(old, lambda n, i: F.when(i == slot, F.coalesce("_n", F.lit(0))).otherwise(n))
    return both.select("host_ip", "item", "value", new.alias("counts")).where(F.exists("counts", lambda n: n > 0))


def ring_lookback(ring: DataFrame) -> DataFrame:
    """What ``lookback`` gives, with the number of active days: the set bits of the ring's map of days."""
    bits = F.aggregate(F.transform("counts", lambda n, i: F.when(n > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    seen = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    return ring.select("host_ip", "item", "value", seen.alias("seen"), bits.alias("days_seen"), F.bit_count(bits).alias("active_days"))


def _items(pairs: DataFrame, *extra: str) -> DataFrame:
    port = F.col("peer_port").cast("string")
    rows = F.array(
        F.struct(F.lit("peer").alias("item"), F.col("peer_ip").alias("value")), F.struct(F.lit("port").alias("item"), port.alias("value")),
        F.struct(F.lit("pair").alias("item"), F.concat(F.col("peer_ip"), F.lit("|"), port).alias("value")),
    )
    return pairs.select("host_ip", *extra, F.inline(rows)).where("value is not null")


def novelty(pairs: DataFrame, known: DataFrame, keys: Sequence[str] = ("window_label", "window_end_ts"), rare: int = 2) -> DataFrame:
    """New and rare peers, ports and pairs of each host and window.

    The window's distinct items are joined with the look-back on (host, item, value): an item is new if it is not there
    and rare if it was seen at most ``rare`` times. No set of items is gathered for a host.
    """
    now = _items(pairs, *keys).distinct()
    joined = now.join(known, ["host_ip", "item", "value"], "left")
    of = lambda item, test: F.count_if((F.col("item") == item) & test)
    new, seldom = F.col("seen").isNull(), F.col("seen").isNull() | (F.col("seen") <= rare)
    out = joined.groupBy("host_ip", *keys).agg(
        *[of(i, F.lit(True)).alias(f"{i}_cnt") for i in ("peer", "port", "pair")], *[of(i, new).alias(f"new_{i}_cnt") for i in ("peer", "port", "pair")],
        *[of(i, seldom).alias(f"rare_{i}_cnt") for i in ("peer", "port", "pair")],
    )
    return out.withColumn("new_peer_ratio", F.when(F.col("peer_cnt") > 0, F.col("new_peer_cnt") / F.col("peer_cnt")).otherwise(0.0))


def high_risk_segments(pairs: DataFrame, segments: Sequence[str], keys: Sequence[str] = ("host_ip", "window_label", "window_end_ts")) -> DataFrame:
    """Sessions with, and distinct peers in, high-risk segments, with a flag; hosts without any get zeros."""
    risky = segment_id(F.col("peer_ip")).isin(*segments)
    out = pairs.groupBy(*keys).agg(F.sum(F.when(risky, F.col("sessions_cnt")).otherwise(0)).alias("high_risk_segment_sessions_cnt"), F.count_distinct(F.when(risky, F.col("peer_ip"))).alias("high_risk_segment_peers"))
    return out.withColumn("has_high_risk_segment", (F.col("high_risk_segment_sessions_cnt") > 0).cast("int"))
