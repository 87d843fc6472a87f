"""Streaming queries: sessions are replayed as a file stream, drained, and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from hostscope.plans.base_sql import ROLES, counters, sliced, text
from hostscope.plans.registry import query
from hostscope.plans.slice_queries import t
from hostscope.sources.scratch import scratch_dir
from hostscope.sources.sessions import sessions
from hostscope.streaming import sessions as st
from hostscope.streaming import stateful

#: Arrivals of the month, each drained before the next comes.
CUTS = ("2024-01-11", "2024-01-21")


def _source(spark, d, path, files: int | None = None):
    stream = spark.readStream.schema(sessions(spark, d).schema)
    return (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(path)


def _replayed(spark, d, build, closing: int = 1):
    """What a stream with the usual lateness emits for sessions that arrive in parts by time.

    Far-off sessions at the end, one for each stateful operator, close all windows; the windows that they open are left
    out by their own times.
    """
    base = scratch_dir(spark, "sessions")
    s = sessions(spark, d)
    cut = F.lit(CUTS[0]).cast("timestamp")
    for part in (F.col("event_start") < cut, F.col("event_start") >= cut):
        s.where(part).write.mode("append").parquet(f"{base}/in")
        st.drain(build(_source(spark, d, f"{base}/in")), f"{base}/out", f"{base}/check")
    last = s.orderBy(F.desc("event_start")).limit(1)
    for k in range(1, closing + 1):
        moved = {c: F.timestamp_add("DAY", F.lit(60 * k), F.col(c)) for c in ("event_start", "event_end")}
        last.withColumns(moved).write.mode("append").parquet(f"{base}/in")
    st.drain(build(_source(spark, d, f"{base}/in", 1)), f"{base}/out", f"{base}/check")
    return spark.read.parquet(f"{base}/out").join(F.broadcast(s.agg(F.max("event_start").alias("last"))), F.col("window.start") <= F.col("last"))


@query(f"WITH {counters(15)} SELECT host_ip, role, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start, sessions_cnt, bytes_sent_sum, drop_cnt FROM slices")
def str_slices(spark, d):
    return _replayed(spark, d, st.slice_stream).select("host_ip", "role", t("window.start").alias("slice_start"), "sessions_cnt", "bytes_sent_sum", "drop_cnt")


@query(f"""WITH {counters(15)}, w AS (SELECT host_ip, role, time_bucket(INTERVAL 15 MINUTES, slice_start_ts) - to_minutes(15 * k) AS ws, sessions_cnt, bytes_sent_sum FROM slices, range(4) r(k))
 SELECT host_ip, role, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, sum(sessions_cnt)::BIGINT AS sessions_cnt, sum(bytes_sent_sum) AS bytes_sent_sum FROM w GROUP BY ALL""")
def str_sliding(spark, d):
    out = _replayed(spark, d, lambda s: st.sliding_stream(st.slice_stream(s)), closing=2)
    return out.select("host_ip", "role", t("window.start").alias("window_start"), "sessions_cnt", "bytes_sent_sum")


@query("SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n FROM events GROUP BY ALL")
def str_publication(spark, d):
    """Published by mini-batch (an input file); a second run cuts the input otherwise and leaves each row once."""
    base = scratch_dir(spark, "publish")
    sessions(spark, d).repartitionByRange(4, "event_start").write.parquet(f"{base}/in")
    for run, files in enumerate((None, 1)):
        named = _source(spark, d, f"{base}/in", files).select("*", F.col("_metadata.file_name").alias("mini_batch_id"))
        stream = st.without_replays(named, "40 days").withColumn("dt", F.date_format("event_start", "yyyy-MM-dd"))
        st.drain(stream, "", f"{base}/check{run}", st.publisher(f"{base}/out"))
    return spark.read.parquet(f"{base}/out").groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH arrived AS (SELECT ts, {' + '.join(f"CAST(ts >= TIMESTAMP '{c}' OR (event_id % 20 = 0 AND ts >= TIMESTAMP '{c}' - INTERVAL 8 DAYS) AS INTEGER)" for c in CUTS)} AS part FROM events), seen AS (SELECT part, max(ts) AS seen FROM arrived GROUP BY 1)
 SELECT strftime(time_bucket(INTERVAL 15 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS slice_start, count(*) AS late_rows FROM arrived a WHERE ts < (SELECT max(seen) FROM seen s WHERE s.part < a.part) - INTERVAL 10 MINUTES GROUP BY ALL""")
def str_late_rows(spark, d):
    """Every twentieth session of the eight days before a cut arrives after it: its row goes to the side output."""
    base = scratch_dir(spark, "late")
    s, at = sessions(spark, d), F.col("event_start")
    delayed = F.when(F.col("session_id") % 20 == 0, F.expr("INTERVAL 8 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    part = sum((F.when(at >= F.lit(c).cast("timestamp") - delayed, 1).otherwise(0) for c in CUTS), F.lit(0))
    for n in range(len(CUTS) + 1):
        s.where(part == n).write.mode("append").parquet(f"{base}/in")
        st.drain(_source(spark, d, f"{base}/in"), "", f"{base}/check", st.late_splitter(f"{base}/out"))
    late = spark.read.parquet(f"{base}/out/rows").where("late = 1")
    return st.late_counts(late).select(t("slice_start_ts").alias("slice_start"), "late_rows")


@query(f"WITH {ROLES} SELECT role, count(DISTINCT host_ip) AS hosts FROM roles GROUP BY ALL")
def str_role_hosts(spark, d):
    """Hosts by role in the drained stream: nothing is lost on the way."""
    return str_slices(spark, d).groupBy("role").agg(F.count_distinct("host_ip").alias("hosts"))


_PARTS = " + ".join(f"CAST(event_start >= TIMESTAMP '{c}' OR (session_id % 20 = 0 AND event_start >= TIMESTAMP '{c}' - INTERVAL 8 DAYS) AS INTEGER)" for c in CUTS)


@query(f"""WITH {sliced(15)}, a AS (SELECT *, {_PARTS} AS part FROM sliced), seen AS (SELECT part, max(epoch_ms(event_start)) AS ms FROM (SELECT event_start, {_PARTS} AS part FROM clean) GROUP BY 1),
 l AS (SELECT a.*, coalesce(epoch_ms(slice_end_ts) <= (SELECT max(ms) FROM seen s WHERE s.part < a.part) - 600000, false) AS late FROM a)
 SELECT 'slice' AS kind, host_ip, role, {text('slice_start_ts')} AS slice_start, NULL::BIGINT AS session_id, count(*) AS sessions_cnt, sum(coalesce(bytes_sent, 0)) AS bytes_sent_sum, count(*) FILTER (event_action = 'drop') AS drop_cnt FROM l WHERE NOT late GROUP BY ALL
 UNION ALL SELECT 'late', host_ip, role, {text('slice_start_ts')}, session_id, 1, coalesce(bytes_sent, 0), CAST(event_action = 'drop' AS BIGINT) FROM l WHERE late""")
def str_slices_and_late(spark, d):
    """One stateful operator over arrivals of which some are late, stopped and taken up again at each cut: closed slices
    and late rows together are all the input."""
    stateful.keyed_state(spark)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    base = scratch_dir(spark, "stateful")
    s, at = sessions(spark, d), F.col("event_start")
    delayed = F.when(F.col("session_id") % 20 == 0, F.expr("INTERVAL 8 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    part = sum((F.when(at >= F.lit(c).cast("timestamp") - delayed, 1).otherwise(0) for c in CUTS), F.lit(0))
    run = lambda: st.drain(stateful.slices_and_late_rows(_source(spark, d, f"{base}/in")), f"{base}/out", f"{base}/check")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(8, int(parts))))  # each keeps a store on disk and a Python worker
    try:
        for n in range(len(CUTS) + 1):
            s.where(part == n).write.mode("append").parquet(f"{base}/in")
            run()
        moved = {c: F.timestamp_add("DAY", F.lit(60), F.col(c)) for c in ("event_start", "event_end")}
        s.orderBy(F.desc("event_start")).limit(1).withColumns(moved).write.mode("append").parquet(f"{base}/in")
        run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    out = spark.read.parquet(f"{base}/out")
    return out.select("kind", "host_ip", "role", t("slice_start_ts").alias("slice_start"), "session_id", "sessions_cnt", "bytes_sent_sum", "drop_cnt")
