"""Structured Streaming over session files: slices, sliding windows, idempotent publication and late rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hostscope.operators.quality import clean
from hostscope.operators.slices import role_views

LATENESS = "10 minutes"


def slice_stream(sessions: DataFrame, lateness: str = LATENESS, minutes: int = 15) -> DataFrame:
    """Counters of each host, role and tumbling slice, emitted when the watermark passes the slice's end."""
    rows = role_views(clean(sessions)).withWatermark("event_start", lateness)
    return rows.groupBy(F.window("event_start", f"{minutes} minutes"), "host_ip", "role").agg(
        F.count(F.lit(1)).alias("sessions_cnt"), F.sum(F.coalesce("bytes_sent", F.lit(0.0))).alias("bytes_sent_sum"), F.count_if(F.col("event_action") == "drop").alias("drop_cnt"),
    )


def sliding_stream(slices: DataFrame, length: str = "1 hour", step: str = "15 minutes") -> DataFrame:
    """Sums over sliding windows of closed slices: a second stateful operator on the first one's output."""
    return slices.groupBy(F.window(F.window_time("window"), length, step), "host_ip", "role").agg(
        F.sum("sessions_cnt").alias("sessions_cnt"), F.sum("bytes_sent_sum").alias("bytes_sent_sum"),
    )


def publisher(path: str, by: Sequence[str] = ("mini_batch_id", "dt")) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that replaces the partitions it brings.

    The first partition column names the mini-batch that a row came with, so a replay leaves each row once, even one
    from a new checkpoint that cuts the input otherwise (a mini-batch always comes whole).
    """
    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    return write


def split_late(batch: DataFrame, seen_until: Column, lateness: str = LATENESS, ts: str = "event_start") -> DataFrame:
    """The batch with ``late``: 1 for rows before the published point, which is the greatest time seen less the lateness."""
    return batch.withColumn("late", F.coalesce(F.col(ts) < seen_until - F.expr(f"INTERVAL {lateness}"), F.lit(False)).cast("int"))


def late_splitter(path: str, lateness: str = LATENESS, ts: str = "event_start") -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that writes rows under (batch, late); late rows are a side output, not lost.

    The greatest time up to each batch is kept beside it, one row a batch. A batch reads that of the batch before it
    only, so a replayed one splits its rows the same way again and replaces what it wrote.
    """
    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        seen = None
        if n:
            seen = spark.read.schema("seen timestamp").parquet(f"{path}/seen/batch={n - 1}").agg(F.max("seen")).first()[0]
        here = Observation()
        out = split_late(batch, F.lit(seen).cast("timestamp"), lateness, ts).observe(here, F.max(ts).alias("seen"))
        replace = lambda df: df.withColumn("batch", F.lit(n).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replace(out).partitionBy("batch", "late").parquet(f"{path}/rows")
        now = max((x for x in (seen, here.get["seen"]) if x is not None), default=None)
        replace(spark.createDataFrame([(now,)], "seen timestamp")).partitionBy("batch").parquet(f"{path}/seen")

    return write


def late_counts(late: DataFrame, minutes: int = 15, ts: str = "event_start") -> DataFrame:
    """How many late rows each slice lost."""
    step = minutes * 60
    return late.groupBy(F.timestamp_seconds(F.floor(F.unix_seconds(ts) / step) * step).alias("slice_start_ts")).agg(F.count(F.lit(1)).alias("late_rows"))


def without_replays(sessions: DataFrame, lateness: str = LATENESS, key: str = "session_id") -> DataFrame:
    """Drops sessions seen already within the watermark."""
    return sessions.withWatermark("event_start", lateness).dropDuplicatesWithinWatermark([key])


def drain(stream: DataFrame, out: str, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None) -> None:
    """Runs a stream over all input that is there and stops; append mode into Parquet, or a batch sink."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (writer.foreachBatch(sink).start() if sink else writer.format("parquet").option("path", out).start()).awaitTermination()
