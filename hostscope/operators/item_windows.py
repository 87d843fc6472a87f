"""Breadth and shape of look-back windows: item counts by slice, added and retracted as windows move."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.functions.net import segment_id
from hostscope.operators.slices import SLICE_KEYS
from hostscope.operators.windows import WINDOWS, in_windows

ITEMS = ("peer", "port", "segment")
_KEYS = ("host_ip", "role", "window_label")
_SUMS = ("n", "bytes")


def slice_items(rows: DataFrame, keys: Sequence[str] = SLICE_KEYS) -> DataFrame:
    """(keys, item, value, n, bytes): sessions and whole sent bytes of each peer, port and peer segment in a slice.

    The table that all windows are made from: distinct counts, entropies and top shares don't add up over slices, the
    counts of items do.
    """
    kinds = F.array(
        F.struct(F.lit("peer").alias("item"), F.col("peer_ip").alias("value")), F.struct(F.lit("port").alias("item"), F.col("peer_port").cast("string").alias("value")),
        F.struct(F.lit("segment").alias("item"), segment_id(F.col("peer_ip")).alias("value")),
    )
    sent = F.coalesce(F.round("bytes_sent").cast("long"), F.lit(0))
    by_pair = rows.groupBy(*keys, "peer_ip", "peer_port").agg(F.count(F.lit(1)).alias("n"), F.sum(sent).alias("bytes"))
    return by_pair.select(*keys, "n", "bytes", F.inline(kinds)).groupBy(*keys, "item", "value").agg(*[F.sum(c).alias(c) for c in _SUMS])


def window_items(items: DataFrame, anchor_ts: str, windows: Mapping[str, int] = WINDOWS) -> DataFrame:
    """(host, role, window, item, value, n, bytes): the items of every window before the anchor, from one scan."""
    return in_windows(items, anchor_ts, windows).groupBy(*_KEYS, "item", "value").agg(*[F.sum(c).alias(c) for c in _SUMS])


def advance(state: DataFrame, items: DataFrame, before: str, anchor_ts: str, windows: Mapping[str, int] = WINDOWS, ts: str = "slice_end_ts") -> DataFrame:
    """The items of every window at a later anchor, from those at an earlier one.

    Slices that came since are added and those that a window has left are retracted, so only these are read: two edges
    a window, whatever its length. An item whose sessions are all gone is dropped.
    """
    a, b = F.lit(before).cast("timestamp"), F.lit(anchor_ts).cast("timestamp")
    back = lambda t, m: F.timestamp_add("MINUTE", F.lit(-m), t)
    within = lambda low, high: (F.col(ts) > low) & (F.col(ts) <= high)
    # a slice may come and go between the two anchors: such a one is counted once with either sign
    moves = [F.struct(F.lit(label).alias("window_label"), (within(a, b).cast("int") - within(back(a, m), back(b, m)).cast("int")).alias("sign")) for label, m in windows.items()]
    edge = within(a, b)
    for m in windows.values():
        edge = edge | within(back(a, m), back(b, m))
    moved = items.where(edge).select("host_ip", "role", "item", "value", *_SUMS, F.inline(F.array(*moves))).where("sign <> 0")
    moved = moved.select(*_KEYS, "item", "value", *[(F.col(c) * F.col("sign")).alias(c) for c in _SUMS])
    out = state.select(*moved.columns).unionByName(moved).groupBy(*_KEYS, "item", "value").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return out.where("n > 0")


def window_shapes(items: DataFrame, keys: Sequence[str] = _KEYS) -> DataFrame:
    """Nine metrics of each host, role and window: distinct peers, ports and segments; entropies, top shares of sessions
    and of bytes of peers and ports.

    An item's value may be null: it counts in entropies and shares, not among the distinct ones.
    """
    def of(item: str, c: Column) -> Column:
        return F.when(F.col("item") == item, c)

    def by(item: str) -> list[Column]:
        n, b = F.sum(of(item, F.col("n"))), F.sum(of(item, F.col("bytes")))
        # -sum p ln p with p = n / N is ln N - sum(n ln n) / N
        return [
            F.count(of(item, F.col("value"))).alias(f"{item}_nunique"), (F.log(n) - F.sum(of(item, F.col("n") * F.log("n"))) / n).alias(f"{item}_entropy"),
            (F.max(of(item, F.col("n"))) / n).alias(f"top1_{item}_sessions_share"), F.when(b > 0, F.max(of(item, F.col("bytes"))) / b).otherwise(0.0).alias(f"top1_{item}_bytes_share"),
        ]

    return items.groupBy(*keys).agg(*by("peer"), *by("port"), F.count(of("segment", F.col("value"))).alias("segment_nunique"))


def slice_distincts(rows: DataFrame, keys: Sequence[str] = SLICE_KEYS, bits: int = 12) -> DataFrame:
    """Approximate form: one HyperLogLog sketch an item kind and slice, for windows whose item tables are too large."""
    kinds = {"peer": F.col("peer_ip"), "port": F.col("peer_port").cast("string"), "segment": segment_id(F.col("peer_ip"))}
    return rows.groupBy(*keys).agg(*[F.hll_sketch_agg(c, F.lit(bits)).alias(f"{k}_sketch") for k, c in kinds.items()])


def window_distincts(sketches: DataFrame, anchor_ts: str, windows: Mapping[str, int] = WINDOWS) -> DataFrame:
    """Estimated distinct peers, ports and segments of every window, by uniting its slices' sketches."""
    return in_windows(sketches, anchor_ts, windows).groupBy(*_KEYS).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"{k}_sketch")).alias(f"{k}_nunique") for k in ITEMS])
