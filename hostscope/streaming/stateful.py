"""Slices and late rows from one state: a keyed processor with event-time timers closes slices and tells late rows apart."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hostscope.operators.quality import clean
from hostscope.operators.slices import role_views
from hostscope.streaming.sessions import LATENESS

_SUMS = "sessions_cnt long, bytes_sent_sum double, drop_cnt long"
_STATE = "host_ip array<string>, role array<string>, sessions_cnt array<long>, bytes_sent_sum array<double>, drop_cnt array<long>"
_OUT = f"kind string, host_ip string, role string, slice_start_ts timestamp, session_id long, {_SUMS}"
_COLUMNS = [f.split()[0] for f in _OUT.split(", ")]

#: Parts of a slice, by hash of host and role. Calls to the state number slices times parts, not hosts.
SHARDS = 4


class SliceProcessor(StatefulProcessor):
    """The state of a part of a slice's hosts and roles: their counters in one value, and one timer at the slice's end.

    Rows that come when the watermark has reached the end are given out as late, one by one; all others are counted. As
    both are decided by the same watermark, a row is in exactly one of the two.
    """

    def __init__(self, minutes: int):
        self.ms = minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("slice", _STATE)

    def _rows(self, start: int, kind: str, pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["session_id"] if "session_id" in pdf else None
        return pdf.assign(kind=kind, slice_start_ts=pd.Timestamp(start, unit="ms"), session_id=pd.array([None] * len(pdf), "Int64") if ids is None else ids.astype("Int64"))[_COLUMNS]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = key[0] + self.ms
        closed = end <= timerValues.getCurrentWatermarkInMs()
        total: dict[tuple, list] = {}
        for pdf in rows:
            sent, drops = pdf["bytes_sent"].fillna(0.0), pdf["event_action"] == "drop"
            if closed:
                yield self._rows(key[0], "late", pdf.assign(sessions_cnt=1, bytes_sent_sum=sent, drop_cnt=drops.astype("int64")))
            else:
                self._add(total, pdf["host_ip"].tolist(), pdf["role"].tolist(), [1] * len(pdf), sent.tolist(), drops.tolist())
        if not closed and total:
            before = self.held.get()  # None if there is none; each call asks the JVM, so there are few
            if before is None:
                self.handle.registerTimer(end)
            else:
                self._add(total, *before)
            self.held.update(tuple(list(c) for c in zip(*[(*k, *v) for k, v in total.items()], strict=True)))

    @staticmethod
    def _add(total: dict[tuple, list], hosts, roles, counts, sent, drops) -> None:
        for host, role, n, b, d in zip(hosts, roles, counts, sent, drops, strict=True):
            sums = total.setdefault((host, role), [0, 0.0, 0])
            sums[0] += int(n)
            sums[1] += float(b)
            sums[2] += int(d)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total = self.held.get()
        if total is not None:
            yield self._rows(key[0], "slice", pd.DataFrame(dict(zip(("host_ip", "role", "sessions_cnt", "bytes_sent_sum", "drop_cnt"), map(list, total), strict=True))))
            self.held.clear()

    def close(self) -> None:
        pass


def keyed_state(spark: SparkSession) -> None:
    """Keeps streaming state on disk, as timers and typed state need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def slices_and_late_rows(sessions: DataFrame, lateness: str = LATENESS, minutes: int = 15, shards: int = SHARDS) -> DataFrame:
    """kind "slice": the counters of each host, role and slice, once the watermark passes its end; kind "late": each row
    that came after that, with its session.

    A key is a slice and a part of its hosts, so a busy host is spread over its slices, and each call to the state serves
    many hosts; ``shards`` bounds a state's size and must stay the same over a checkpoint's life. The watermark's column is
    left behind before the state, so that Spark doesn't drop late rows by itself; the processor asks for it instead.
    """
    rows = role_views(clean(sessions)).where("event_start is not null").withColumn("_at", F.unix_millis("event_start")).withWatermark("event_start", lateness)
    start = F.floor(F.col("_at") / (minutes * 60_000)) * (minutes * 60_000)
    shard = F.pmod(F.hash("host_ip", "role"), F.lit(shards))
    rows = rows.select(start.alias("slice_ms"), shard.alias("shard"), "host_ip", "role", "session_id", "bytes_sent", "event_action")
    return rows.groupBy("slice_ms", "shard").transformWithStateInPandas(SliceProcessor(minutes), _OUT, "Append", "EventTime")
