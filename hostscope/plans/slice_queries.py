"""Queries on sources, quality rules, slices, windows and novelty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostscope.functions import net
from hostscope.operators import novelty as nov
from hostscope.operators import quality as q
from hostscope.operators import ranges as rg
from hostscope.operators import slices as sl
from hostscope.operators import windows as win
from hostscope.plans.base_sql import ANCHOR, CLEAN, LONG_WINDOWS, PAIRS, ROLES, SEGMENT, SESSIONS, counters, in_windows, sliced, text
from hostscope.plans.registry import query
from hostscope.sources import readers
from hostscope.sources import sinks
from hostscope.sources.bucketed_index import BucketedIndex
from hostscope.sources.scratch import scratch_dir
from hostscope.sources.sessions import PORT_SETS, SESSION_SCHEMA, machines, sessions, table

t = net.as_text


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return q.clean(sessions(spark, d))


def role_rows(spark: SparkSession, d: str, minutes: int) -> DataFrame:
    return sl.stamp_slice(sl.role_views(cleaned(spark, d)), minutes)


def slice_table(spark: SparkSession, d: str, minutes: int = 60) -> DataFrame:
    """Counters of hourly slices: the retained fact table that windows read."""
    return role_rows(spark, d, minutes).groupBy(*sl.SLICE_KEYS).agg(*sl.base_counters(), *sl.port_counters(PORT_SETS))


def pair_table(spark: SparkSession, d: str, minutes: int = 60) -> DataFrame:
    return sl.pair_context(role_rows(spark, d, minutes))


@query(f"WITH {SESSIONS} SELECT session_id, source_ip, destination_ip, destination_port, {text('event_start')} AS event_start, {text('event_end')} AS event_end, source_bytes, destination_bytes, event_action, event_reason, event_name, network_transport FROM sessions")
def src_sessions(spark, d):
    s = sessions(spark, d)
    return s.select("session_id", "source_ip", "destination_ip", "destination_port", t("event_start").alias("event_start"), t("event_end").alias("event_end"), "source_bytes", "destination_bytes", "event_action", "event_reason", "event_name", "network_transport")


@query(f"WITH {SESSIONS} SELECT session_id, source_ip, source_bytes, {text('event_start')} AS event_start FROM sessions")
def src_json_lines(spark, d):
    """Sessions written as gzipped JSON Lines and read under the contract, four columns of them."""
    path = scratch_dir(spark, "json-lines")
    s = sessions(spark, d)
    s.write.option("compression", "gzip").json(path)
    out = readers.read_jsonlines(spark, path, SESSION_SCHEMA, ["session_id", "source_ip", "source_bytes", "event_start"])
    return out.withColumn("event_start", t("event_start"))


@query("SELECT event_type, count(*) AS n, round(sum(value) FILTER (event_id % 2 = 0), 6) AS total, count(*) FILTER (event_id % 3 <> 0 AND event_id % 2 = 1) AS propertied FROM events GROUP BY ALL")
def src_merged_scan(spark, d):
    """Files of differing columns under one schema: what a file lacks is null."""
    path, e = scratch_dir(spark, "merged"), table(spark, d, "events")
    e.where("event_id % 2 = 0").select("event_id", "event_type", "value").write.parquet(f"{path}/a")
    e.where("event_id % 2 = 1").select("event_type", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("props")).write.parquet(f"{path}/b")
    out = readers.read_merged(spark, f"{path}/a", f"{path}/b")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"), F.count("props").alias("propertied"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def src_scoped_scan(spark, d):
    o = table(spark, d, "orders").withColumnsRenamed({"o_orderstatus": "feature_spec_version", "o_orderpriority": "mini_batch_id"})
    return readers.scope_to_batch(o, "F", "1-URGENT").select("o_orderkey", "o_custkey")


@query(f"WITH {SESSIONS} SELECT session_id, source_ip FROM sessions WHERE event_start >= TIMESTAMP '2024-01-10 00:00:00' AND event_start < TIMESTAMP '2024-01-12 12:00:00'")
def src_time_range_scan(spark, d):
    s = sessions(spark, d).withColumn("dt", F.date_format("event_start", "yyyy-MM-dd"))
    return readers.scope_to_range(s, "2024-01-10 00:00:00", "2024-01-12 12:00:00", "event_start").select("session_id", "source_ip")


@query("SELECT DISTINCT event_type AS kind, 'main' AS source_mode FROM events")
def src_first_available(spark, d):
    df = readers.read_first_available(spark, [("none", f"{d}/no_such_table.parquet"), ("main", f"{d}/events.parquet")])
    return df.select(F.col("event_type").alias("kind"), "source_mode").distinct()


@query("""WITH r AS (SELECT * FROM (VALUES ('2024-01-05', '2024-01-08'), ('2024-01-07', '2024-01-09'), ('2024-01-20', '2024-01-21')) v(range_start, range_end))
 SELECT range_start, range_end, event_type, count(*) AS n FROM events JOIN r ON ts >= range_start::TIMESTAMP AND ts < range_end::TIMESTAMP GROUP BY ALL""")
def src_range_scan(spark, d):
    """Three ranges, two of which overlap, from one scan."""
    ranges = [("2024-01-20", "2024-01-21"), ("2024-01-05", "2024-01-08"), ("2024-01-07", "2024-01-09")]
    return readers.scan_ranges(table(spark, d, "events"), ranges, "ts").groupBy("range_start", "range_end", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT '2024-01-05' AS range_start, '2024-01-08' AS range_end, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08'
 UNION ALL SELECT '2024-01-20', '2024-01-21', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21'""")
def src_range_extract(spark, d):
    table(spark, d, "events").createOrReplaceTempView("range_events")
    sql = "SELECT event_id FROM range_events WHERE ts >= TIMESTAMP_NTZ '{{start_ts}}' AND ts < TIMESTAMP_NTZ '{{end_ts}}'"
    return readers.extract_ranges(spark, sql, [("2024-01-20", "2024-01-21"), ("2024-01-05", "2024-01-08")]).groupBy("range_start", "range_end").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CLEAN}, sets AS (SELECT * FROM (VALUES ('HIGH_RISK_PORT', 445), ('HIGH_RISK_PORT', 3389), ('ADMIN_PORT', 22), ('ADMIN_PORT', 3389), ('FILESHARE_PORT', 445), ('DIRECTORY_PORT', 389), ('DB_PORT', 3306)) v(set_name, port)) SELECT set_name, count(*) AS sessions FROM clean JOIN sets ON destination_port = port GROUP BY ALL")
def src_port_sets(spark, d):
    sets = readers.port_sets(spark, PORT_SETS)
    return cleaned(spark, d).join(F.broadcast(sets), F.col("destination_port") == F.col("port")).groupBy("set_name").agg(F.count(F.lit(1)).alias("sessions"))


MACHINES = "machines AS (SELECT DISTINCT '10.0.' || (user_id % 16) || '.' || ((user_id // 16) % 250 + 1) AS ip_address, CASE WHEN user_id % 5 = 0 THEN 'VDI-' ELSE 'server-' END || user_id AS machine_name FROM events)"


@query(f"WITH {MACHINES} SELECT ip_address, machine_name, '2024-01' AS snapshot_month, 'v1' AS contract_version FROM machines")
def src_inventory_snapshot(spark, d):
    return readers.inventory_snapshot(machines(spark, d), "2024-01")


@query(r"SELECT p.event_id, regexp_extract(p.path, '([^/]+)/[^/]+/[^/]+/\d{4}/\d{2}/\d{2}/[^/]+/[^/]+$', 1) AS project, strftime(ts, '%Y-%m-%d') AS batch_day, 'b' || (p.event_id % 7) AS batch_id FROM (SELECT *, 'bucket/proj' || (user_id % 3) || '/a/b/' || strftime(ts, '%Y/%m/%d') || '/b' || (event_id % 7) || '/x.json.gz' AS path FROM events) p")
def src_batch_paths(spark, d):
    e = table(spark, d, "events")
    path = F.concat(F.lit("bucket/proj"), (F.col("user_id") % 3).cast("string"), F.lit("/a/b/"), F.date_format("ts", "yyyy/MM/dd"), F.lit("/b"), (F.col("event_id") % 7).cast("string"), F.lit("/x.json.gz"))
    return e.select("event_id", *readers.batch_path_columns(path)).drop("org1", "org2")


@query("SELECT o_orderpriority AS day_key, count(*) AS n FROM orders GROUP BY ALL")
def snk_partitioned_write(spark, d):
    """Written twice (the second time over itself), read back: replacement leaves every row once."""
    path = scratch_dir(spark, "orders-out")
    o = table(spark, d, "orders").withColumn("day_key", F.col("o_orderpriority"))
    sinks.write_partitioned(o, path, ["day_key"])
    sinks.write_partitioned(o.where("o_orderpriority = '1-URGENT'"), path, ["day_key"])
    return spark.read.parquet(path).groupBy("day_key").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SESSIONS} SELECT strftime(event_start, '%Y-%m-%d') AS dt, strftime(event_start, '%H') AS hh, CAST(minute(event_start) // 15 + 1 AS INTEGER) AS run_no, 'b1' AS batch_id, count(*) AS n FROM sessions GROUP BY ALL")
def snk_layout(spark, d):
    return sessions(spark, d).select(*sinks.layout_columns(F.col("event_start"), F.lit("b1"))).groupBy("dt", "hh", "run_no", "batch_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SESSIONS} SELECT strftime(event_start, '%Y-%m-%d') AS dt, network_transport, count(*) AS \"rows\", count(*) FILTER (destination_bytes IS NULL) AS broken FROM sessions GROUP BY ALL")
def snk_partition_contract(spark, d):
    """What a partitioned write would hold, partition by partition, with the rows that break its contract."""
    s = sessions(spark, d).withColumn("dt", F.date_format("event_start", "yyyy-MM-dd"))
    return sinks.partition_contract(s, ["dt", "network_transport"], ["session_id", "destination_bytes"])


@query(f"WITH {SESSIONS} SELECT count(*) AS broken FROM sessions WHERE destination_bytes IS NULL")
def snk_null_keys(spark, d):
    return sinks.null_keys(sessions(spark, d), ["session_id", "destination_bytes"]).agg(F.count(F.lit(1)).alias("broken"))


@query("""WITH o AS (SELECT o_custkey AS batch_id, min(o_orderkey) AS first_key, 'NEW' AS status, 1 AS status_seq FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1),
 n AS (SELECT o_custkey AS batch_id, max(o_orderkey) AS first_key, 'DONE' AS status, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE 2 END AS status_seq FROM orders WHERE o_custkey % 4 < 2 GROUP BY 1)
 SELECT batch_id, coalesce(o.first_key, n.first_key) AS first_key, CASE WHEN coalesce(n.status_seq, -1) > coalesce(o.status_seq, -1) THEN n.status ELSE o.status END AS status, CAST(greatest(o.status_seq, n.status_seq) AS INTEGER) AS status_seq FROM o FULL JOIN n USING (batch_id)""")
def snk_batch_index_upsert(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("batch_id")).agg(F.min("o_orderkey").alias("first_key")).withColumns({"status": F.lit("NEW"), "status_seq": F.lit(1)})
    new = o.where("o_custkey % 4 < 2").groupBy(F.col("o_custkey").alias("batch_id")).agg(F.max("o_orderkey").alias("first_key")).withColumns({"status": F.lit("DONE"), "status_seq": F.when(F.col("batch_id") % 3 == 0, 0).otherwise(2)})
    return sinks.merge_batch_index(old, new, ["batch_id"], ["first_key"])


@query("""WITH o AS (SELECT o_custkey AS batch_id, min(o_orderkey) AS first_key, 'NEW' AS status, 1 AS status_seq FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1),
 n AS (SELECT o_custkey AS batch_id, max(o_orderkey) AS first_key, 'DONE' AS status, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE 2 END AS status_seq FROM orders WHERE o_custkey % 40 < 2 GROUP BY 1)
 SELECT batch_id, coalesce(o.first_key, n.first_key) AS first_key, CASE WHEN coalesce(n.status_seq, -1) > coalesce(o.status_seq, -1) THEN n.status ELSE o.status END AS status, CAST(greatest(o.status_seq, n.status_seq) AS INTEGER) AS status_seq FROM o FULL JOIN n USING (batch_id)""")
def snk_index_commit(spark, d):
    """The upsert into a table of key buckets: a first version, then one that rewrites the touched buckets only."""
    o = table(spark, d, "orders")
    old = o.where("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("batch_id")).agg(F.min("o_orderkey").alias("first_key")).withColumns({"status": F.lit("NEW"), "status_seq": F.lit(1)})
    new = o.where("o_custkey % 40 < 2").groupBy(F.col("o_custkey").alias("batch_id")).agg(F.max("o_orderkey").alias("first_key")).withColumns({"status": F.lit("DONE"), "status_seq": F.when(F.col("batch_id") % 3 == 0, 0).otherwise(2)})
    index = BucketedIndex(spark, scratch_dir(spark, "index"), old.schema, ["batch_id"])
    for rows in (old, new):
        index.upsert(rows, lambda a, b: sinks.merge_batch_index(a, b, ["batch_id"], ["first_key"]))
    return index.read()


@query("SELECT l_orderkey AS order_id, l_partkey AS part_id, count(*) AS n FROM lineitem GROUP BY ALL")
def prj_map_fields(spark, d):
    li = q.map_fields(table(spark, d, "lineitem"), {"l_orderkey": "order_id", "l_partkey": "part_id"}, ["order_id", "part_id"])
    return li.groupBy("order_id", "part_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CLEAN} SELECT session_id, source_bytes, destination_bytes, duration_sec FROM clean")
def prj_quality_rules(spark, d):
    return cleaned(spark, d).select("session_id", "source_bytes", "destination_bytes", "duration_sec")


@query(f"WITH {CLEAN} SELECT session_id FROM clean WHERE event_start >= TIMESTAMP '2024-01-15 00:00:00' AND event_start < TIMESTAMP '2024-01-15 12:00:00'")
def prj_slice_filter(spark, d):
    return q.in_slice(cleaned(spark, d), "2024-01-15 00:00:00", "2024-01-15 12:00:00").select("session_id")


@query(f"WITH {sliced(15)} SELECT session_id, role, host_ip, peer_ip, peer_port, bytes_sent, bytes_recv, {text('slice_start_ts')} AS slice_start, {text('slice_end_ts')} AS slice_end, strftime(slice_start_ts, '%Y-%m-%d') AS dt, strftime(slice_start_ts, '%H') AS hh, strftime(slice_start_ts, '%M') AS mm FROM sliced")
def prj_roles_and_slices(spark, d):
    r = role_rows(spark, d, 15)
    return r.select("session_id", "role", "host_ip", "peer_ip", "peer_port", "bytes_sent", "bytes_recv", t("slice_start_ts").alias("slice_start"), t("slice_end_ts").alias("slice_end"), "dt", "hh", "mm")


@query(f"WITH {CLEAN} SELECT session_id, {text('(SELECT max(event_end) FROM clean)')} AS slice_end FROM clean")
def prj_fixed_slice(spark, d):
    """A slice's end falls back to the last event's over all rows."""
    return sl.stamp_fixed_slice(cleaned(spark, d)).select("session_id", t("slice_end_ts").alias("slice_end"))


@query(f"WITH {CLEAN} SELECT source_ip, {SEGMENT.format(ip='source_ip')} AS seg24, regexp_replace(source_ip, '^([0-9]+)[.]([0-9]+)[.].*$', '\\1.\\2.0.0/16') AS seg16, count(*) AS n FROM clean GROUP BY ALL")
def prj_segments(spark, d):
    c = cleaned(spark, d).groupBy("source_ip").agg(F.count(F.lit(1)).alias("n"))
    return c.select("source_ip", net.segment_id(F.col("source_ip")).alias("seg24"), net.segment_id(F.col("source_ip"), 16).alias("seg16"), "n")


@query(f"WITH {SESSIONS} SELECT count(*) AS \"rows\", 0::BIGINT AS empty, count(*) FILTER (source_bytes < 0) AS negative_source_bytes, count(*) FILTER (destination_bytes IS NULL) AS null_destination_bytes, 0::BIGINT AS malformed_ip FROM sessions")
def prj_quality_metrics(spark, d):
    return q.quality_metrics(sessions(spark, d))


@query(f"WITH {SESSIONS} SELECT session_id, CAST(source_bytes AS BIGINT) AS source_bytes, coalesce(CAST(destination_bytes AS BIGINT), 0) AS destination_bytes, CAST(source_port AS VARCHAR) AS source_port FROM sessions")
def prj_enforce_schema(spark, d):
    from pyspark.sql import types as T

    contract = T.StructType([T.StructField("source_bytes", T.LongType()), T.StructField("destination_bytes", T.LongType()), T.StructField("source_port", T.StringType())])
    s = sessions(spark, d).select("session_id", "source_bytes", "destination_bytes", "source_port")
    return q.enforce_schema(s, contract, {"destination_bytes": 0})


@query(f"WITH {SESSIONS} SELECT 0::BIGINT AS source_bytes, count(*) AS event_reason FROM sessions")
def prj_rejected_casts(spark, d):
    from pyspark.sql import types as T

    return q.rejected_casts(sessions(spark, d), T.StructType([T.StructField("source_bytes", T.LongType()), T.StructField("event_reason", T.IntegerType())]))


@query(f"WITH {SESSIONS} SELECT session_id, source_bytes AS bytes_src, destination_bytes AS bytes_dst FROM sessions")
def prj_legacy_shims(spark, d):
    s = sessions(spark, d).select("session_id", F.col("source_bytes").alias("bytes_sent"), F.col("destination_bytes").alias("bytes_recv"))
    return q.rename_legacy(s, {"bytes_sent": "bytes_src", "bytes_recv": "bytes_dst", "drop": "deny"})


@query(f"""WITH {SESSIONS}, l AS (SELECT session_id, event_start, hour(event_start + to_hours(2)) AS h, event_start + to_hours(2) AS loc FROM sessions)
 SELECT session_id, CAST(h AS INTEGER) AS hour_of_day, strftime(loc, '%a') AS day_name, CAST(h >= 7 AND h < 17 AS INTEGER) AS is_working_hours, CAST(h >= 17 AND h < 22 AS INTEGER) AS is_off_hours,
 CAST(h < 7 OR h >= 22 AS INTEGER) AS is_night_hours, CAST(dayofweek(loc) IN (5, 6) AS INTEGER) AS is_weekend, CASE WHEN h >= 7 AND h < 17 THEN 'work' WHEN h >= 17 AND h < 22 THEN 'off' ELSE 'night' END AS time_band FROM l""")
def prj_time_context(spark, d):
    zone = "Africa/Maputo"  # two hours ahead all year
    return sessions(spark, d).select("session_id", *net.time_context(F.col("event_start"), zone), net.time_band(F.col("event_start"), zone).alias("time_band"))


@query(f"""WITH {SESSIONS}, b AS (SELECT session_id, CASE WHEN event_action = 'alert' THEN 'night' END AS own, CASE WHEN session_id % 3 = 0 THEN session_id % 2 END AS working, CASE WHEN session_id % 5 = 0 THEN minute(event_start) % 24 END AS h, hour(event_start) AS t FROM sessions)
 SELECT session_id, coalesce(own, CASE WHEN working = 1 THEN 'work' END, {', '.join(f"CASE WHEN {c} >= 7 AND {c} < 17 THEN 'work' WHEN {c} >= 17 AND {c} < 22 THEN 'off' WHEN {c} IS NOT NULL THEN 'night' END" for c in 'ht')}) AS time_band FROM b""")
def prj_time_bands(spark, d):
    """All four sources of a band, some rows having each: their own band, a working-hours flag, an hour, the time."""
    i = F.col("session_id")
    own, working = F.when(F.col("event_action") == "alert", "night"), F.when(i % 3 == 0, i % 2)
    return sessions(spark, d).select("session_id", net.time_band(F.col("event_start"), existing=own, working=working, hour=F.when(i % 5 == 0, F.minute("event_start") % 24)).alias("time_band"))


@query(f"WITH {SESSIONS} SELECT event_action, count(*) AS \"rows\" FROM sessions WHERE event_action NOT IN ('allow', 'drop') GROUP BY ALL")
def prj_invalid_values(spark, d):
    return q.invalid_values(sessions(spark, d), "event_action", ["allow", "drop"])


@query(f"""WITH {SESSIONS}, m AS (SELECT session_id, event_start, list_max(list_filter([8, 23, 38, 53], lambda x: x <= minute(event_start))) AS a FROM sessions)
 SELECT session_id, strftime(CASE WHEN a IS NOT NULL THEN date_trunc('hour', event_start) + to_minutes(a) ELSE date_trunc('hour', event_start) - to_minutes(7) END, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(minute(event_start) // 15 + 1 AS INTEGER) AS quarter FROM m""")
def prj_window_floor(spark, d):
    mins = F.array(*map(F.lit, (8, 23, 38, 53)))
    return sessions(spark, d).select("session_id", t(net.window_floor(F.col("event_start"), mins)).alias("window_start"), net.quarter(F.col("event_start")).alias("quarter"))


@query(f"WITH {SESSIONS} SELECT session_id, concat_ws('|', source_ip, CAST(destination_bytes AS BIGINT)::VARCHAR, destination_ip) AS record_id, sha256(concat_ws('|', source_ip, coalesce(CAST(destination_bytes AS BIGINT)::VARCHAR, ''), destination_ip)) AS prediction_id FROM sessions")
def prj_record_ids(spark, d):
    s = sessions(spark, d).withColumn("b", F.col("destination_bytes").cast("long"))
    return s.select("session_id", net.record_id("source_ip", F.col("b").cast("string"), "destination_ip").alias("record_id"), net.prediction_id("source_ip", "b", "destination_ip").alias("prediction_id"))


@query(f"WITH {SESSIONS} SELECT 'destination_bytes' AS violation, count(*) AS n FROM sessions WHERE destination_bytes IS NULL")
def prj_missing_values(spark, d):
    return q.missing_values(sessions(spark, d), ["source_ip", "destination_bytes"]).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SESSIONS} SELECT strftime(date_trunc('day', event_end), '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(date_trunc('day', event_end), '%Y-%m-%d') || ' 23:59:59' AS end_ts FROM sessions GROUP BY ALL")
def prj_reference_days(spark, d):
    out = rg.reference_days(sessions(spark, d).select(F.col("event_end").alias("end_ts")))
    return out.select(t("start_ts").alias("start_ts"), t("end_ts").alias("end_ts"))


@query(f"WITH {CLEAN} SELECT network_transport, count(*) AS n FROM clean WHERE session_id % 13 NOT IN (0, 1, 2) AND session_id % 17 <> 0 GROUP BY ALL")
def prj_malformed_ips(spark, d):
    """Some sessions' addresses are broken in different ways; these go."""
    i = F.col("session_id")
    broken = F.when(i % 13 == 0, F.concat("source_ip", F.lit(".7"))).when(i % 13 == 1, F.lit("unknown")).when(i % 13 == 2, F.regexp_replace("source_ip", "[.]", "-")).otherwise(F.col("source_ip"))
    rows = cleaned(spark, d).withColumns({"source_ip": broken, "destination_ip": F.when(i % 17 == 0, F.lit("10.0.0")).otherwise(F.col("destination_ip"))})
    return q.drop_malformed_ips(rows).groupBy("network_transport").agg(F.count(F.lit(1)).alias("n"))


_SLICE_OUT = "host_ip, role, sessions_cnt, bytes_sent_sum, bytes_recv_sum, duration_sum, allow_cnt, drop_cnt, alert_cnt, rst_cnt, aged_out_cnt, threat_cnt, traffic_cnt, tcp_cnt, udp_cnt, icmp_cnt, high_risk_port_sessions_cnt, admin_port_sessions_cnt, fileshare_port_sessions_cnt, directory_port_sessions_cnt, db_port_sessions_cnt"


_EMPTY = {"session_id": "bigint", "role": "string", "host_ip": "string", "peer_ip": "string", "peer_port": "int", "bytes_sent": "double", "bytes_recv": "double", "slice_start_ts": "timestamp", "slice_end_ts": "timestamp", "dt": "string", "hh": "string", "mm": "string"}


@query(f"WITH {ROLES}, n AS (SELECT count(*) AS n FROM roles WHERE event_start < TIMESTAMP '2000-01-01') SELECT name, kind, place, n AS \"rows\" FROM n, (VALUES " + ", ".join(f"('{c}', '{k}', {i})" for i, (c, k) in enumerate(_EMPTY.items())) + ") v(name, kind, place)")
def ord_empty_contract(spark, d):
    """Role views and slices of a time without sessions: no rows, and every column in its place with its type."""
    none = sl.stamp_slice(sl.role_views(q.in_slice(cleaned(spark, d), "1999-01-01 00:00:00", "2000-01-01 00:00:00"))).select(*_EMPTY)
    there = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(k).alias("kind"), F.lit(i).alias("place")) for i, (c, k) in enumerate(none.dtypes)])
    return none.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(there), "rows")


@query(f"WITH {counters(60)} SELECT {_SLICE_OUT}, {text('slice_start_ts')} AS slice_start FROM slices")
def agg_slice_counters(spark, d):
    return slice_table(spark, d).select(*_SLICE_OUT.split(", "), t("slice_start_ts").alias("slice_start"))


@query(f"WITH {sliced(1440)}, m AS (SELECT host_ip, role, slice_start_ts, date_trunc('minute', event_start) AS mi, count(*) AS n FROM sliced GROUP BY ALL) SELECT host_ip, role, {text('slice_start_ts')} AS slice_start, max(n) AS max_sessions_per_minute FROM m GROUP BY ALL")
def agg_burst(spark, d):
    return sl.burst(role_rows(spark, d, 1440)).select("host_ip", "role", t("slice_start_ts").alias("slice_start"), "max_sessions_per_minute")


@query(f"""WITH {sliced(1440)}, m AS (SELECT host_ip, role, slice_start_ts, date_trunc('minute', event_start) AS mi, count(*) AS n FROM sliced GROUP BY ALL), b AS (SELECT host_ip, role, slice_start_ts, max(n) AS max_sessions_per_minute FROM m GROUP BY ALL)
 SELECT s.host_ip, s.role, {text('s.slice_start_ts')} AS slice_start, count(*) AS sessions_cnt, any_value(max_sessions_per_minute) AS max_sessions_per_minute, quantile_disc(bytes_sent, 0.5) AS bytes_sent_p50, quantile_disc(bytes_sent, 0.95) AS bytes_sent_p95, quantile_disc(bytes_recv, 0.25) AS bytes_recv_p25, quantile_disc(duration_sec, 0.99) AS duration_sec_p99
 FROM sliced s JOIN b ON s.host_ip = b.host_ip AND s.role = b.role AND s.slice_start_ts = b.slice_start_ts GROUP BY ALL""")
def agg_slice_metrics(spark, d):
    m = sl.slice_metrics(role_rows(spark, d, 1440), PORT_SETS)
    return m.select("host_ip", "role", t("slice_start_ts").alias("slice_start"), "sessions_cnt", "max_sessions_per_minute", "bytes_sent_p50", "bytes_sent_p95", "bytes_recv_p25", "duration_sec_p99")


@query(f"WITH {sliced(60)}{PAIRS} SELECT host_ip, role, {text('slice_start_ts')} AS slice_start, peer_ip, peer_port, sessions_cnt, {text('event_ts')} AS event_ts, pair_key FROM pairs")
def agg_pair_context(spark, d):
    return pair_table(spark, d).select("host_ip", "role", t("slice_start_ts").alias("slice_start"), "peer_ip", "peer_port", "sessions_cnt", t("event_ts").alias("event_ts"), "pair_key")


def _shape_sql() -> str:
    part = lambda c: f"SELECT host_ip, role, slice_start_ts, {c} AS item, count(*) AS n, sum(coalesce(bytes_sent, 0)) AS b FROM sliced GROUP BY ALL"
    one = lambda c, a: f"SELECT host_ip, role, slice_start_ts, count(item) AS {c}_nunique, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) AS {c}_entropy, round(max(n) / sum(n), 6) AS top1_{c}_sessions_share, round(CASE WHEN sum(b) > 0 THEN max(b) / sum(b) ELSE 0 END, 6) AS top1_{c}_bytes_share FROM {a} GROUP BY ALL"
    return f"""WITH {sliced(43200)}, i AS ({part('peer_ip')}), p AS ({part('peer_port')}), a AS ({one('peer_ip', 'i')}), b AS ({one('peer_port', 'p')}),
 c AS (SELECT host_ip, role, slice_start_ts, count(DISTINCT {SEGMENT.format(ip='peer_ip')}) AS peer_segment_nunique, count(*) FILTER (coalesce(bytes_recv, 0) = 0) AS zero_reply_cnt, count(*) FILTER (duration_sec < 1) AS short_session_cnt FROM sliced GROUP BY ALL)
 SELECT * EXCLUDE (slice_start_ts), {text('slice_start_ts')} AS slice_start FROM a JOIN b USING (host_ip, role, slice_start_ts) JOIN c USING (host_ip, role, slice_start_ts)"""


@query(_shape_sql())
def agg_shape(spark, d):
    r = role_rows(spark, d, 43200)
    out = sl.shape(r)
    doubles = [c for c, k in out.dtypes if k == "double"]
    return out.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in out.columns if not c.startswith("slice_")], t("slice_start_ts").alias("slice_start"))


@query(f"WITH {sliced(60)}, k AS (SELECT * FROM sliced WHERE role = 'outbound' AND destination_port > 0 AND event_name = 'TRAFFIC') SELECT source_ip AS src_ip, destination_ip AS dst_ip, destination_port AS dst_port, {SEGMENT.format(ip='source_ip')} AS segment_id, {text('slice_start_ts')} AS slice_start, count(*) AS sessions_cnt FROM k GROUP BY ALL")
def agg_pair_counts(spark, d):
    return sl.pair_counts(sessions(spark, d), 60).select("src_ip", "dst_ip", "dst_port", "segment_id", t("slice_start_ts").alias("slice_start"), "sessions_cnt")


@query(f"WITH {counters(60)} SELECT {text('max(slice_end_ts)')} AS anchor_ts FROM slices")
def agg_anchor(spark, d):
    return win.anchor(slice_table(spark, d)).select(t("anchor_ts").alias("anchor_ts"))


_SUMS = ", ".join(f"sum({c}){'::BIGINT' if c.endswith('_cnt') else ''} AS {c}" for c in win.SUMMED)


@query(f"WITH {counters(60)}{in_windows('slices', 'w')} SELECT host_ip, role, window_label, {text('window_start_ts')} AS window_start, {_SUMS} FROM w GROUP BY ALL")
def agg_window_sums(spark, d):
    out = win.window_sums(slice_table(spark, d), ANCHOR, LONG_WINDOWS)
    return out.select("host_ip", "role", "window_label", t("window_start_ts").alias("window_start"), *win.SUMMED)


def windowed(spark: SparkSession, d: str) -> DataFrame:
    return win.window_sums(slice_table(spark, d), ANCHOR, LONG_WINDOWS)


@query(f"""WITH {counters(60)}{in_windows('slices', 'w')}, s AS (SELECT host_ip, role, window_label, {_SUMS} FROM w GROUP BY ALL)
 SELECT host_ip, role, window_label, round(duration_sum / (sessions_cnt + 1e-9), 6) AS duration_mean, round(drop_cnt / (sessions_cnt + 1e-9), 6) AS deny_ratio, round((bytes_sent_sum - bytes_recv_sum) / (bytes_sent_sum + bytes_recv_sum + 1e-9), 6) AS bytes_asymmetry_ratio, round(tcp_cnt / (sessions_cnt + 1e-9), 6) AS tcp_ratio, CAST(high_risk_port_sessions_cnt > 0 AS INTEGER) AS has_high_risk_port FROM s""")
def agg_window_ratios(spark, d):
    out = win.with_ratios(windowed(spark, d))
    return out.select("host_ip", "role", "window_label", *[F.round(c, 6).alias(c) for c in ("duration_mean", "deny_ratio", "bytes_asymmetry_ratio", "tcp_ratio")], "has_high_risk_port")


@query(f"WITH {sliced(60)}{PAIRS}{in_windows('pairs', 'w')} SELECT host_ip, role, peer_ip, peer_port, window_label, sum(sessions_cnt)::BIGINT AS sessions_cnt, {text('max(event_ts)')} AS event_ts FROM w GROUP BY ALL")
def agg_pair_windows(spark, d):
    return win.pair_windows(pair_table(spark, d), ANCHOR, LONG_WINDOWS).select("host_ip", "role", "peer_ip", "peer_port", "window_label", "sessions_cnt", t("event_ts").alias("event_ts"))


@query(f"WITH {counters(60)}{in_windows('slices', 'w')}, s AS (SELECT host_ip, role, window_label, {_SUMS} FROM w GROUP BY ALL) SELECT host_ip, window_label, max(sessions_cnt) FILTER (role = 'outbound') AS sessions_cnt, max(bytes_sent_sum) FILTER (role = 'outbound') AS bytes_sent_sum, max(sessions_cnt) FILTER (role = 'inbound') AS in_sessions_cnt, max(bytes_sent_sum) FILTER (role = 'inbound') AS in_bytes_sent_sum FROM s GROUP BY ALL")
def jon_directions(spark, d):
    return win.wide_by_role(windowed(spark, d), ["sessions_cnt", "bytes_sent_sum"]).drop("window_start_ts", "window_end_ts")


@query(f"WITH {counters(60)}{in_windows('slices', 'w')} SELECT host_ip, window_label, role, sum(sessions_cnt)::BIGINT AS sessions_cnt, sum(bytes_sent_sum) AS bytes_sent_sum FROM w GROUP BY ALL")
def prj_wide_to_long(spark, d):
    metrics = ["sessions_cnt", "bytes_sent_sum"]
    return win.long_by_role(win.wide_by_role(windowed(spark, d), metrics), metrics).drop("window_start_ts", "window_end_ts")


@query(f"WITH {counters(60)} SELECT host_ip, role, {text('slice_end_ts')} AS slice_end, sum(sessions_cnt) OVER (PARTITION BY host_ip, role ORDER BY slice_end_ts RANGE BETWEEN INTERVAL 86399 SECONDS PRECEDING AND CURRENT ROW)::BIGINT AS sessions_cnt_1440m FROM slices")
def win_rolling(spark, d):
    return win.rolling(slice_table(spark, d), 1440).select("host_ip", "role", t("slice_end_ts").alias("slice_end"), "sessions_cnt_1440m")


_BACK = ("2024-01-01 00:00:00", "2024-01-16 00:00:00")
_ITEMS = """, items AS (SELECT host_ip, slice_end_ts, item, value FROM (SELECT host_ip, slice_end_ts, 'peer' AS item, peer_ip AS value FROM pairs UNION ALL SELECT host_ip, slice_end_ts, 'port', peer_port::VARCHAR FROM pairs UNION ALL SELECT host_ip, slice_end_ts, 'pair', peer_ip || '|' || peer_port FROM pairs)),
 known AS (SELECT host_ip, item, value, count(*) AS seen FROM items WHERE slice_end_ts >= TIMESTAMP '2024-01-01 00:00:00' AND slice_end_ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY ALL)"""


@query(f"WITH {sliced(60)}{PAIRS}{_ITEMS} SELECT * FROM known")
def agg_lookback(spark, d):
    return nov.lookback(pair_table(spark, d), *_BACK)


@query(f"""WITH {sliced(60)}{PAIRS}{_ITEMS}{in_windows('items', 'w', {'w_24h': 1440, 'w_7d': 10080})}, now AS (SELECT DISTINCT host_ip, window_label, item, value FROM w), j AS (SELECT now.*, seen FROM now LEFT JOIN known USING (host_ip, item, value))
 SELECT host_ip, window_label, {', '.join(f"count(*) FILTER (item = '{i}') AS {i}_cnt, count(*) FILTER (item = '{i}' AND seen IS NULL) AS new_{i}_cnt, count(*) FILTER (item = '{i}' AND coalesce(seen, 0) <= 2) AS rare_{i}_cnt" for i in ('peer', 'port', 'pair'))},
 round(CASE WHEN count(*) FILTER (item = 'peer') > 0 THEN count(*) FILTER (item = 'peer' AND seen IS NULL) / count(*) FILTER (item = 'peer') ELSE 0 END, 6) AS new_peer_ratio FROM j GROUP BY ALL""")
def agg_novelty(spark, d):
    pairs = pair_table(spark, d)
    now = win.in_windows(pairs, ANCHOR, {"w_24h": 1440, "w_7d": 10080})
    out = nov.novelty(now, nov.lookback(pairs, *_BACK), ("window_label",))
    return out.withColumn("new_peer_ratio", F.round("new_peer_ratio", 6))


@query(f"""WITH {sliced(60)}{PAIRS}{in_windows('pairs', 'w')}, s AS (SELECT *, {SEGMENT.format(ip='peer_ip')} IN ('172.16.3.0/24', '10.0.2.0/24') AS risky FROM w)
 SELECT host_ip, window_label, coalesce(sum(sessions_cnt) FILTER (risky), 0)::BIGINT AS high_risk_segment_sessions_cnt, count(DISTINCT peer_ip) FILTER (risky) AS high_risk_segment_peers, CAST(coalesce(sum(sessions_cnt) FILTER (risky), 0) > 0 AS INTEGER) AS has_high_risk_segment FROM s GROUP BY ALL""")
def agg_high_risk_segments(spark, d):
    pairs = win.in_windows(pair_table(spark, d), ANCHOR, LONG_WINDOWS)
    return nov.high_risk_segments(pairs, ["172.16.3.0/24", "10.0.2.0/24"], ("host_ip", "window_label"))


@query(f"WITH {ROLES} SELECT role, count(*) AS n, count(source_port) FILTER (role = 'outbound') AS ports FROM roles GROUP BY ALL")
def set_union_by_name(spark, d):
    c = cleaned(spark, d)
    a, b = c.select(F.lit("outbound").alias("role"), "session_id", "source_port"), c.select(F.lit("inbound").alias("role"), "session_id")
    return q.union_all([a, b]).groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count("source_port").alias("ports"))


@query(f"WITH {MACHINES} SELECT count(*) AS source_rows, count(*) AS written_rows FROM machines")
def src_snapshot_manifest(spark, d):
    """A snapshot written by month, read back and counted against its source."""
    snapshot = readers.inventory_snapshot(machines(spark, d), "2024-01")
    return sinks.snapshot_with_manifest(snapshot, scratch_dir(spark, "snapshot"), ["snapshot_month"]).select("source_rows", "written_rows")


@query("SELECT 'b1' AS batch_id, 'ingestion' AS source_mode, strftime(min(ts), '%Y-%m-%d') AS first_day, count(*) AS n FROM events")
def snk_run_provenance(spark, d):
    found = readers.read_first_available(spark, [("ingestion", f"{d}/events.parquet")])
    days = found.groupBy("source_mode").agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_day"), F.count(F.lit(1)).alias("n"))
    record = sinks.run_provenance(spark, "b1", "ingestion", "first source has rows", "2024-01-01", "2024-01-31", f"{d}/events.parquet")
    return record.select("batch_id", "source_mode").join(days, "source_mode")
