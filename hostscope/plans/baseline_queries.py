"""Queries on baselines, deviation and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostscope.functions import net
from hostscope.operators import baselines as bl
from hostscope.operators import deviation as dv
from hostscope.operators import quality as q
from hostscope.operators import slices as sl
from hostscope.plans.base_sql import SEGMENT, counters
from hostscope.plans.registry import query
from hostscope.plans.slice_queries import MACHINES, slice_table, t
from hostscope.sources import sinks
from hostscope.sources.copartitioned import bucketed, meet
from hostscope.sources.scratch import scratch_dir, written
from hostscope.sources.sessions import machines, sessions, table

METRICS = ["sessions_cnt", "bytes_sent_sum", "duration_sum", "bytes_recv_sum", "admin_port_sessions_cnt"]
REFERENCE = "2024-01-31 00:00:00"
HOST = ["host_ip", "role", "time_band"]
SEGMENT_KEYS = ["segment_id", "role", "time_band"]
SUPPORT = 3


def daily(spark: SparkSession, d: str) -> DataFrame:
    """Hourly slices as the windows that baselines learn from, with segment and time band."""
    s = slice_table(spark, d).withColumn("window_end_ts", F.col("slice_end_ts"))
    return s.select("host_ip", "role", "slice_start_ts", "window_end_ts", *METRICS, net.segment_id(F.col("host_ip")).alias("segment_id"), net.time_band(F.col("slice_start_ts")).alias("time_band"))


BASE = counters(60) + f""", base AS (SELECT host_ip, role, slice_start_ts, slice_end_ts AS window_end_ts, {', '.join(METRICS)}, {SEGMENT.format(ip='host_ip')} AS segment_id,
 CASE WHEN hour(slice_start_ts) >= 7 AND hour(slice_start_ts) < 17 THEN 'work' WHEN hour(slice_start_ts) >= 17 AND hour(slice_start_ts) < 22 THEN 'off' ELSE 'night' END AS time_band FROM slices),
 horizons AS (SELECT * FROM (VALUES ('7d', TIMESTAMP '2024-01-24', TIMESTAMP '2024-01-31'), ('30d', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31')) v(baseline_horizon, baseline_start_ts, baseline_end_ts)),
 inh AS (SELECT base.*, baseline_horizon FROM base JOIN horizons ON window_end_ts >= baseline_start_ts AND window_end_ts < baseline_end_ts)"""


def _weights_sql() -> str:
    meds = ", ".join(f"quantile_disc({m}::DOUBLE, 0.5) AS med_{m}" for m in METRICS)
    mads = ", ".join(f"quantile_disc(abs({m} - med_{m})::DOUBLE, 0.5) AS mad_{m}" for m in METRICS)
    z = ", ".join(f"abs(({m} - med_{m}) / (mad_{m} + 1e-6))" for m in METRICS)
    return BASE + f""", med AS (SELECT segment_id, role, time_band, baseline_horizon, {meds} FROM inh GROUP BY ALL), dev AS (SELECT * FROM inh JOIN med USING (segment_id, role, time_band, baseline_horizon)),
 mad AS (SELECT segment_id, role, time_band, baseline_horizon, {mads} FROM dev GROUP BY ALL), w AS (SELECT *, greatest({z}) AS max_abs_z, CASE WHEN greatest({z}) > 6.0 THEN 0.2 ELSE 1.0 END AS anomaly_weight FROM dev JOIN mad USING (segment_id, role, time_band, baseline_horizon))"""


WEIGHTS = _weights_sql()


def weighted(spark: SparkSession, d: str) -> DataFrame:
    """Windows of the horizons with their weights; slices are written first, so that sessions are read once."""
    rows = bl.in_horizons(written(daily(spark, d), "slices"), bl.horizon_bounds(spark, REFERENCE))
    return bl.anomaly_weights(rows, METRICS, keys=[*SEGMENT_KEYS, "baseline_horizon"])


def _stats_sql(keys: list[str], name: str) -> str:
    k = ", ".join(keys)
    one = lambda m: f"""SELECT {k}, baseline_horizon, '{m}' AS metric, quantile_disc({m}::DOUBLE, 0.5) FILTER (anomaly_weight >= 1) AS median, quantile_disc({m}::DOUBLE, 0.25) FILTER (anomaly_weight >= 1) AS p25, quantile_disc({m}::DOUBLE, 0.75) FILTER (anomaly_weight >= 1) AS p75,
 quantile_disc({m}::DOUBLE, 0.95) FILTER (anomaly_weight >= 1) AS p95, quantile_disc({m}::DOUBLE, 0.99) FILTER (anomaly_weight >= 1) AS p99, count({m}) AS support_count FROM w GROUP BY ALL"""  # noqa: E731
    return f", {name} AS (SELECT *, p75 - p25 AS iqr, (p75 - p25) / 1.349 AS mad, CAST(support_count < {SUPPORT} AS INTEGER) AS is_cold_start FROM (" + " UNION ALL ".join(map(one, METRICS)) + "))"


HOSTS, SEGMENTS = _stats_sql(HOST, "hosts"), _stats_sql(SEGMENT_KEYS, "segments")
_R = ", ".join(f"round({c}, 6) AS {c}" for c in ("median", "p25", "p75", "p95", "p99", "iqr", "mad"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


@query(f"WITH {BASE} SELECT baseline_horizon, strftime(baseline_start_ts, '%Y-%m-%d %H:%M:%S') AS baseline_start, strftime(baseline_end_ts, '%Y-%m-%d %H:%M:%S') AS baseline_end, count(*) AS \"rows\" FROM horizons JOIN base ON window_end_ts >= baseline_start_ts AND window_end_ts < baseline_end_ts GROUP BY ALL")
def agg_horizons(spark, d):
    rows = bl.in_horizons(daily(spark, d), bl.horizon_bounds(spark, REFERENCE))
    return rows.groupBy("baseline_horizon", t("baseline_start_ts").alias("baseline_start"), t("baseline_end_ts").alias("baseline_end")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"WITH {WEIGHTS} SELECT host_ip, role, baseline_horizon, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start, round(max_abs_z, 6) AS max_abs_z, anomaly_weight::DOUBLE AS anomaly_weight FROM w")
def agg_anomaly_weights(spark, d):
    return weighted(spark, d).select("host_ip", "role", "baseline_horizon", t("slice_start_ts").alias("slice_start"), F.round("max_abs_z", 6).alias("max_abs_z"), "anomaly_weight")


@query(f"WITH {WEIGHTS}{HOSTS} SELECT * EXCLUDE (median, p25, p75, p95, p99, iqr, mad), {_R} FROM hosts")
def agg_host_baselines(spark, d):
    return _rounded(host_stats(spark, d))


@query(f"WITH {WEIGHTS}{SEGMENTS} SELECT * EXCLUDE (median, p25, p75, p95, p99, iqr, mad), {_R} FROM segments")
def agg_segment_baselines(spark, d):
    return _rounded(bl.baselines(written(weighted(spark, d), "windows"), METRICS, SEGMENT_KEYS, SUPPORT))


_PAIR = f""", pc AS (SELECT source_ip AS src_ip, destination_ip AS dst_ip, destination_port AS dst_port, {SEGMENT.format(ip='source_ip')} AS segment_id, event_start, date_trunc('hour', event_start) AS h FROM sessions WHERE destination_port > 0 AND event_name = 'TRAFFIC'),
 known AS (SELECT DISTINCT src_ip AS host_ip, dst_ip, dst_port FROM pc WHERE h < TIMESTAMP '2024-01-16'),
 rare AS (SELECT src_ip AS host_ip, NULL AS segment_id, dst_ip, dst_port, count(*) AS pair_seen_count, max(event_start) AS last_seen, count(DISTINCT event_start::DATE) AS active_days, 'host' AS level FROM pc WHERE h >= TIMESTAMP '2024-01-16' GROUP BY ALL
 UNION ALL SELECT NULL, segment_id, dst_ip, dst_port, count(*), max(event_start), count(DISTINCT event_start::DATE), 'segment' FROM pc WHERE h >= TIMESTAMP '2024-01-16' GROUP BY ALL)"""


def _pairs(spark, d):
    pc = sl.pair_counts(sessions(spark, d), 60)
    cut = F.lit("2024-01-16").cast("timestamp")
    return pc.where(F.col("slice_start_ts") < cut), pc.where(F.col("slice_start_ts") >= cut)


@query(f"""WITH {BASE}{_PAIR}, lastday AS (SELECT src_ip AS host_ip, segment_id, dst_ip, dst_port, max(event_start)::DATE AS md, count(DISTINCT event_start::DATE) AS active_days FROM pc WHERE h >= TIMESTAMP '2024-01-16' GROUP BY ALL)
 SELECT r.host_ip, r.segment_id, r.dst_ip, r.dst_port, pair_seen_count, strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen, active_days, level, round(pair_seen_count / 15, 6) AS pair_daily_avg, round(1 / (1 + pair_seen_count), 6) AS pair_rarity_score, CAST(pair_seen_count <= 2 AS INTEGER) AS is_rare_pair_flag,
 CAST(k.host_ip IS NULL AND level = 'host' AS INTEGER) AS is_new_pair_flag FROM rare r LEFT JOIN known k ON r.host_ip = k.host_ip AND r.dst_ip = k.dst_ip AND r.dst_port = k.dst_port""")
def agg_pair_rarity(spark, d):
    """active_days counts days of each slice's last event, which are the days of its events: slices lie inside hours."""
    old, new = _pairs(spark, d)
    out = bl.pair_rarity(new, 15, lookback=old)
    return _rounded(out.select("host_ip", "segment_id", "dst_ip", "dst_port", "pair_seen_count", t("pair_last_seen_ts").alias("last_seen"), "active_days", "level", "pair_daily_avg", "pair_rarity_score", "is_rare_pair_flag", "is_new_pair_flag"))


FLAGS = f""", {MACHINES}, names AS (SELECT ip_address AS host_ip, min(machine_name) AS machine_name FROM machines WHERE ip_address IS NOT NULL GROUP BY 1),
 support AS (SELECT host_ip, baseline_horizon, min(support_count) AS s FROM hosts WHERE metric = 'sessions_cnt' GROUP BY ALL),
 flags AS (SELECT host_ip, baseline_horizon, machine_name, CAST(s >= {SUPPORT} AS INTEGER) AS is_full_history, CAST(coalesce(lower(machine_name) LIKE 'vdi-%', false) AS INTEGER) AS is_non_persistent_machine, CAST(s < {SUPPORT} OR coalesce(lower(machine_name) LIKE 'vdi-%', false) AS INTEGER) AS is_cold_start FROM support LEFT JOIN names USING (host_ip))"""


def host_stats(spark, d):
    return bl.baselines(written(weighted(spark, d), "windows"), METRICS, HOST, SUPPORT)


def flags(spark, d, stats=None):
    stats = stats if stats is not None else host_stats(spark, d)
    support = stats.where("metric = 'sessions_cnt'").withColumnRenamed("support_count", "sessions_cnt_support_count")
    return bl.host_flags(support, machines(spark, d), ["vdi-", "Citrix-"], ["host_ip", "baseline_horizon"], min_support=SUPPORT)


@query(f"WITH {WEIGHTS}{HOSTS}{FLAGS} SELECT * FROM flags")
def agg_host_flags(spark, d):
    return flags(spark, d)


@query(f"WITH {MACHINES} SELECT ip_address, machine_name FROM machines WHERE lower(machine_name) LIKE 'vdi-%' OR lower(machine_name) LIKE 'server-1%'")
def jon_prefix_match(spark, d):
    return machines(spark, d).where(bl.has_prefix(F.col("machine_name"), ["VDI-", "SERVER-1"])).select("ip_address", "machine_name")


@query("""WITH p AS (SELECT DISTINCT upper(substr(c_name, 1, length(c_name) - CAST(c_custkey % 2 AS INTEGER))) AS prefix FROM customer WHERE c_custkey % 31 = 0) SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM p WHERE starts_with(lower(c_name), lower(prefix)))""")
def jon_prefix_table(spark, d):
    """Names that start with any of a long table of prefixes, by equality of beginnings."""
    c = table(spark, d, "customer")
    prefixes = c.where("c_custkey % 31 = 0").select(F.upper(F.substring("c_name", F.lit(1), (F.length("c_name") - F.col("c_custkey") % 2).cast("int"))).alias("prefix"))
    return bl.with_any_prefix(c, "c_name", prefixes).select("c_custkey", "c_name")


@query(f"WITH {BASE}, {MACHINES}, names AS (SELECT ip_address AS host_ip, min(machine_name) AS machine_name FROM machines GROUP BY 1) SELECT host_ip, machine_name, count(*) AS n FROM base LEFT JOIN names USING (host_ip) GROUP BY ALL")
def jon_machine_names(spark, d):
    hosts = daily(spark, d).groupBy("host_ip").agg(F.count(F.lit(1)).alias("n"))
    return hosts.join(bl.one_name_per_ip(machines(spark, d)), "host_ip", "left")


_STAT = ("median", "p95", "iqr", "mad", "support_count")
_CAST = lambda alias: ", ".join(f"max({alias}.{s}) FILTER ({alias}.metric = '{m}') AS {m}_{s}" for m in METRICS for s in _STAT)
ROUTED = f""", hw AS (SELECT host_ip, role, time_band, baseline_horizon, {_CAST('hosts')} FROM hosts GROUP BY ALL), sw AS (SELECT segment_id, role, time_band, baseline_horizon, {_CAST('segments')} FROM segments GROUP BY ALL),
 routed AS (SELECT inh.*, coalesce(is_cold_start, 1) AS cold, CASE WHEN coalesce(is_cold_start, 1) = 1 THEN 'segment' ELSE 'host' END AS baseline_source, {', '.join(f"CASE WHEN coalesce(is_cold_start, 1) = 1 THEN sw.{m}_{s} ELSE hw.{m}_{s} END AS {m}_{s}" for m in METRICS for s in _STAT)}
 FROM inh LEFT JOIN flags USING (host_ip, baseline_horizon) LEFT JOIN hw USING (host_ip, role, time_band, baseline_horizon) LEFT JOIN sw USING (segment_id, role, time_band, baseline_horizon))"""
ROUTE_SQL = WEIGHTS + HOSTS + SEGMENTS + FLAGS + ROUTED


def routed(spark: SparkSession, d: str) -> DataFrame:
    """Baselines are learned from written windows and written themselves; the same windows are then routed."""
    w = written(weighted(spark, d), "windows")
    hosts, segments = (written(bl.baselines(w, METRICS, k, SUPPORT), "baselines") for k in (HOST, SEGMENT_KEYS))
    keys = [*HOST, "baseline_horizon"]
    seg = [*SEGMENT_KEYS, "baseline_horizon"]
    rows = w.drop("baseline_start_ts", "baseline_end_ts", "max_abs_z", "anomaly_weight")
    return dv.route_baselines(rows, flags(spark, d, hosts), bl.wide_baselines(hosts, keys, METRICS, _STAT), bl.wide_baselines(segments, seg, METRICS, _STAT), METRICS, ["host_ip", "baseline_horizon"], keys, seg, _STAT)


@query(f"WITH {ROUTE_SQL} SELECT host_ip, role, baseline_horizon, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start, cold AS is_cold_start, baseline_source, round(sessions_cnt_median, 6) AS sessions_cnt_median, round(bytes_sent_sum_mad, 6) AS bytes_sent_sum_mad, duration_sum_support_count FROM routed")
def jon_cold_start_routing(spark, d):
    return _rounded(routed(spark, d).select("host_ip", "role", "baseline_horizon", t("slice_start_ts").alias("slice_start"), "is_cold_start", "baseline_source", "sessions_cnt_median", "bytes_sent_sum_mad", "duration_sum_support_count"))


def copartitioned(spark: SparkSession, d: str) -> DataFrame:
    """Windows with the baselines of their own host: windows and the wide statistics are dealt into buckets once, and the
    join keeps to these."""
    keys = [*HOST, "baseline_horizon"]
    w = bucketed(weighted(spark, d), keys, "windows")
    stats = bucketed(bl.wide_baselines(bl.baselines(w, METRICS, HOST, SUPPORT), keys, METRICS, _STAT), keys, "statistics")
    return meet(w, stats, keys, "left")


@query(f"WITH {WEIGHTS}{HOSTS}, hw AS (SELECT host_ip, role, time_band, baseline_horizon, {_CAST('hosts')} FROM hosts GROUP BY ALL) SELECT host_ip, role, baseline_horizon, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start, {', '.join(f'round({m}_median, 6) AS {m}_median, round({m}_mad, 6) AS {m}_mad, {m}_support_count' for m in METRICS)} FROM w LEFT JOIN hw USING (host_ip, role, time_band, baseline_horizon)")
def jon_copartitioned_baselines(spark, d):
    out = copartitioned(spark, d)
    return _rounded(out.select("host_ip", "role", "baseline_horizon", t("slice_start_ts").alias("slice_start"), *[f"{m}_{s}" for m in METRICS for s in ("median", "mad", "support_count")]))


@query(f"WITH {ROUTE_SQL} SELECT baseline_horizon, baseline_source, count(*) AS \"rows\" FROM routed GROUP BY ALL")
def agg_value_counts(spark, d):
    return routed(spark, d).groupBy("baseline_horizon", "baseline_source").agg(F.count(F.lit(1)).alias("rows"))


def _z(m: str) -> str:
    return f"CASE WHEN {m}_mad > 0 THEN ({m} - {m}_median) / ({m}_mad + 1e-6) WHEN {m}_iqr > 0 THEN ({m} - {m}_median) / ({m}_iqr + 1e-6) WHEN {m}_median IS NOT NULL THEN 0.0 END"


_KEY = "host_ip, role, baseline_horizon, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start"
_M = "bytes_sent_sum"


@query(f"""WITH {ROUTE_SQL}, z AS (SELECT *, {_z(_M)} AS z FROM routed) SELECT {_KEY}, round({_M} - {_M}_median, 6) AS {_M}_diff, round({_M} / ({_M}_median + 1e-6), 4) AS {_M}_ratio, round(z, 6) AS {_M}_z_mad, round(abs({_M} - {_M}_median) / ({_M}_mad + 1e-6), 4) AS {_M}_abs_dev_over_mad,
 round(greatest(least(z, 6.0), -6.0), 6) AS {_M}_z_mad_clipped, round(sign(greatest(least(z, 6.0), -6.0)) * pow(abs(greatest(least(z, 6.0), -6.0)), 3), 6) AS {_M}_z_mad_cube, round(ln(({_M} + 1e-6) / ({_M}_median + 1e-6)), 6) AS {_M}_log_ratio FROM z""")
def dev_transforms(spark, d):
    out = dv.transforms(routed(spark, d), [_M])
    four = {f"{_M}_ratio", f"{_M}_abs_dev_over_mad"}
    return out.select("host_ip", "role", "baseline_horizon", t("slice_start_ts").alias("slice_start"), *[F.round(f"{_M}_{x}", 4 if f"{_M}_{x}" in four else 6).alias(f"{_M}_{x}") for x in dv.TRANSFORMS])


@query(f"WITH {ROUTE_SQL} SELECT {_KEY}, round(greatest({_M} - {_M}_p95, 0), 6) AS {_M}_excess_over_p95, round({_M} / ({_M}_p95 + 1e-6), 6) AS {_M}_ratio_p95, round(CASE WHEN {_M}_iqr > 0 THEN ({_M} - {_M}_median) / {_M}_iqr ELSE 0 END, 6) AS {_M}_iqr_dev FROM routed")
def dev_tail_excess(spark, d):
    return _rounded(routed(spark, d).select("host_ip", "role", "baseline_horizon", t("slice_start_ts").alias("slice_start"), *dv.tail_columns(_M)))


_GROUPS = {
    "core_anomaly": ["sessions_cnt", "bytes_sent_sum", "bytes_recv_sum"], "beacon": ["sessions_cnt", "duration_sum"],
    "exfiltration": ["bytes_sent_sum"], "lateral_movement": ["admin_port_sessions_cnt"],
}
_SCORES = {g: "greatest(" + ", ".join(f"abs({_z(m)})" for m in ms) + ")" for g, ms in _GROUPS.items()}
_SCORE_NAMES = [*[f"{g}_score" for g in _GROUPS], *[f"{g}_indicator" for g in _GROUPS if g != "core_anomaly"]]


@query(f"""WITH {ROUTE_SQL}, z AS (SELECT *, {', '.join(f"{e} AS {g}_score" for g, e in _SCORES.items())} FROM routed)
 SELECT {_KEY}, {', '.join(f"round({n.replace('_indicator', '_score')}, 6) AS {n}" for n in _SCORE_NAMES)}, CAST(time_band <> 'work' AND core_anomaly_score >= 3 AS INTEGER) AS is_time_band_violation FROM z""")
def dev_scores(spark, d):
    out = dv.scores(dv.transforms(routed(spark, d), METRICS, ["z_mad"]), _GROUPS)
    out = out.withColumn("is_time_band_violation", dv.time_band_violation(F.col("time_band"), F.col("core_anomaly_score")))
    return _rounded(out.select("host_ip", "role", "baseline_horizon", t("slice_start_ts").alias("slice_start"), *_SCORE_NAMES, "is_time_band_violation"))


@query(f"""WITH {BASE}{_PAIR}, cur AS (SELECT src_ip AS host_ip, segment_id, dst_ip, dst_port, h AS slice_start_ts, count(*) AS n FROM pc WHERE h < TIMESTAMP '2024-01-16' GROUP BY ALL), hr AS (SELECT * FROM rare WHERE level = 'host'), sr AS (SELECT * FROM rare WHERE level = 'segment'),
 out_now AS (SELECT * FROM base WHERE role = 'outbound'), q AS (SELECT segment_id, quantile_disc({_M}::DOUBLE, 0.5) AS {_M}_median, quantile_disc({_M}::DOUBLE, 0.75) - quantile_disc({_M}::DOUBLE, 0.25) AS {_M}_iqr, (quantile_disc({_M}::DOUBLE, 0.75) - quantile_disc({_M}::DOUBLE, 0.25)) / 1.349 AS {_M}_mad FROM out_now GROUP BY 1),
 hz AS (SELECT host_ip, slice_start_ts, {_z(_M)} AS z FROM out_now JOIN q USING (segment_id)), seen AS (SELECT c.*, z, coalesce(hr.pair_seen_count, sr.pair_seen_count, 0) AS pair_seen_count, CASE WHEN hr.pair_seen_count IS NOT NULL THEN 'host' WHEN sr.pair_seen_count IS NOT NULL THEN 'segment' ELSE 'none' END AS pair_rarity_source
 FROM cur c JOIN hz ON hz.host_ip = c.host_ip AND hz.slice_start_ts = c.slice_start_ts LEFT JOIN hr ON c.host_ip = hr.host_ip AND c.dst_ip = hr.dst_ip AND c.dst_port = hr.dst_port LEFT JOIN sr ON c.segment_id = sr.segment_id AND c.dst_ip = sr.dst_ip AND c.dst_port = sr.dst_port)
 SELECT host_ip, dst_ip, dst_port, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start, pair_seen_count, round(1 / (1 + pair_seen_count), 6) AS pair_rarity_score, pair_rarity_source, CAST(pair_seen_count <= 2 AS INTEGER) AS has_rare_pair, round(z / (1 + pair_seen_count), 5) AS {_M}_rarity_weighted_z FROM seen""")
def jon_pair_rarity(spark, d):
    """Pairs of a host with its z of sent bytes against its segment, weighted by how rare the pair is."""
    old, new = _pairs(spark, d)
    rarity = bl.pair_rarity(new, 15)
    hosts = written(daily(spark, d).where("role = 'outbound'"), "slices")
    stats = bl.wide_baselines(bl.baselines(hosts, [_M], ["segment_id"], SUPPORT), ["segment_id"], [_M], _STAT)
    z = dv.transforms(hosts.join(stats, "segment_id"), [_M], ["z_mad"]).select("host_ip", "slice_start_ts", f"{_M}_z_mad")
    now = old.select(F.col("src_ip").alias("host_ip"), "segment_id", "dst_ip", "dst_port", "slice_start_ts").join(z, ["host_ip", "slice_start_ts"])
    out = dv.rarity_weighted(dv.attach_rarity(now, rarity.where("level = 'host'"), rarity.where("level = 'segment'")), _M)
    return out.select("host_ip", "dst_ip", "dst_port", t("slice_start_ts").alias("slice_start"), "pair_seen_count", F.round("pair_rarity_score", 6).alias("pair_rarity_score"), "pair_rarity_source", "has_rare_pair", F.round(f"{_M}_rarity_weighted_z", 5).alias(f"{_M}_rarity_weighted_z"))


@query(f"""WITH {BASE}{_PAIR}, hosts_now AS (SELECT host_ip, slice_start_ts, sum(sessions_cnt) AS s FROM base WHERE role = 'outbound' GROUP BY ALL), prs AS (SELECT src_ip AS host_ip, h AS slice_start_ts, dst_ip, dst_port, count(*) AS n FROM pc GROUP BY ALL)
 SELECT host_ip, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start, s::BIGINT AS sessions, count(dst_ip) AS pairs FROM hosts_now LEFT JOIN prs USING (host_ip, slice_start_ts) GROUP BY ALL""")
def jon_pair_context(spark, d):
    """The pair grain is a table of its own; here it is counted back to the host grain."""
    hosts = daily(spark, d).where("role = 'outbound'").groupBy("host_ip", "slice_start_ts").agg(F.sum("sessions_cnt").alias("sessions"))
    pairs = sl.pair_counts(sessions(spark, d), 60).select(F.col("src_ip").alias("host_ip"), "slice_start_ts", "dst_ip", "dst_port", "sessions_cnt")
    out = dv.attach_pair_context(hosts, pairs, ["host_ip", "slice_start_ts"])
    return out.groupBy("host_ip", t("slice_start_ts").alias("slice_start"), "sessions").agg(F.count("dst_ip").alias("pairs"))


@query(f"WITH {BASE} SELECT host_ip, role, count(*) AS \"rows\" FROM base GROUP BY ALL HAVING count(*) > 1")
def jon_duplicate_keys(spark, d):
    return dv.duplicate_keys(daily(spark, d), ["host_ip", "role"])


@query(f"WITH {counters(60)} SELECT host_ip, role, 'sessions_cnt' AS metric, count(*) AS slices, sum(sessions_cnt)::DOUBLE AS total FROM slices GROUP BY ALL UNION ALL SELECT host_ip, role, 'duration_sum', count(*), sum(duration_sum)::DOUBLE FROM slices GROUP BY ALL")
def prj_metric_selection(spark, d):
    """The default and configured metrics that the slices hold, of every slice, summed by host."""
    s = slice_table(spark, d)
    names = bl.metric_lists(s.columns, ["sessions_cnt", "no_such_metric"], ["duration_sum", "sessions_cnt"])
    return bl.long_metrics(s.select("host_ip", "role", *names), names).groupBy("host_ip", "role", "metric").agg(F.count(F.lit(1)).alias("slices"), F.sum("value").alias("total"))


_PUBLISHED = f""", phost AS (SELECT src_ip, dst_ip, dst_port, baseline_horizon FROM pc JOIN horizons ON h + INTERVAL 1 HOUR >= baseline_start_ts AND h + INTERVAL 1 HOUR < baseline_end_ts GROUP BY ALL),
 pseg AS (SELECT segment_id, dst_ip, dst_port, baseline_horizon FROM pc JOIN horizons ON h + INTERVAL 1 HOUR >= baseline_start_ts AND h + INTERVAL 1 HOUR < baseline_end_ts GROUP BY ALL)"""


@query(f"""WITH {WEIGHTS}{HOSTS}{SEGMENTS}{FLAGS}{_PAIR}{_PUBLISHED}, n AS (SELECT 'host' AS published, baseline_horizon, count(*) AS "rows" FROM hosts GROUP BY ALL UNION ALL SELECT 'segment', baseline_horizon, count(*) FROM segments GROUP BY ALL
 UNION ALL SELECT 'ip_metadata', baseline_horizon, count(*) FROM flags GROUP BY ALL UNION ALL SELECT 'pair_host', baseline_horizon, count(*) FROM phost GROUP BY ALL UNION ALL SELECT 'pair_segment', baseline_horizon, count(*) FROM pseg GROUP BY ALL)
 SELECT n.*, strftime(baseline_start_ts, '%Y-%m-%d %H:%M:%S') AS baseline_start, strftime(baseline_end_ts, '%Y-%m-%d %H:%M:%S') AS baseline_end, 'replay' AS run_mode FROM n JOIN horizons USING (baseline_horizon)""")
def snk_publish(spark, d):
    """The five tables of a publication under (version, horizon, month), then their metadata; all read back.

    Schemas are given on reading, since a folder named 30d would be taken for a number.
    """
    base, bounds = scratch_dir(spark, "publication"), bl.horizon_bounds(spark, REFERENCE)
    w = written(weighted(spark, d), "windows")
    hosts = written(bl.baselines(w, METRICS, HOST, SUPPORT), "baselines")
    pairs = bl.in_horizons(sl.pair_counts(sessions(spark, d), 60), bounds, "slice_end_ts")
    rarity = written(bl.pair_rarity(pairs, 30, by=["baseline_horizon"]), "rarity")
    tables = {
        "host": hosts, "segment": bl.baselines(w, METRICS, SEGMENT_KEYS, SUPPORT), "ip_metadata": flags(spark, d, hosts),
        "pair_host": rarity.where("level = 'host'").drop("segment_id"), "pair_segment": rarity.where("level = 'segment'").drop("host_ip"),
    }
    stamped = {k: v.withColumns({"feature_spec_version": F.lit("v1"), "baseline_month": F.lit(REFERENCE[:7])}) for k, v in tables.items()}
    sinks.publish(stamped, base, ["feature_spec_version", "baseline_horizon", "baseline_month"], sinks.publication_metadata(bounds, "replay", REFERENCE))
    meta = spark.read.parquet(f"{base}/metadata").select("baseline_horizon", t("baseline_start_ts").alias("baseline_start"), t("baseline_end_ts").alias("baseline_end"), "run_mode")
    back = q.union_all([spark.read.schema(v.schema).parquet(f"{base}/{k}").select(F.lit(k).alias("published"), "baseline_horizon") for k, v in stamped.items()])
    return back.groupBy("published", "baseline_horizon").agg(F.count(F.lit(1)).alias("rows")).join(meta, "baseline_horizon")


@query(f"WITH {BASE} SELECT baseline_horizon, strftime(min(window_end_ts), '%Y-%m-%d %H:%M:%S') AS baseline_start, strftime(max(window_end_ts), '%Y-%m-%d %H:%M:%S') AS baseline_end, 'replay' AS run_mode, '{REFERENCE}' AS created_ts FROM inh GROUP BY ALL")
def snk_publication_metadata(spark, d):
    """The bounds of the windows that a publication's horizons hold."""
    rows = bl.in_horizons(daily(spark, d), bl.horizon_bounds(spark, REFERENCE))
    held = rows.groupBy("baseline_horizon").agg(F.min("window_end_ts").alias("baseline_start_ts"), F.max("window_end_ts").alias("baseline_end_ts"))
    meta = sinks.publication_metadata(held, "replay", REFERENCE)
    return meta.select("baseline_horizon", t("baseline_start_ts").alias("baseline_start"), t("baseline_end_ts").alias("baseline_end"), "run_mode", t("created_ts").alias("created_ts"))


_ALL_STATS = ", ".join(f"count({s}) AS {s}" for s in dv.STATISTICS)


@query(f"WITH {WEIGHTS}{HOSTS} SELECT baseline_horizon, {_ALL_STATS} FROM hosts WHERE metric = '{_M}' GROUP BY ALL")
def dev_baseline_contract(spark, d):
    """Wide baselines that pass the column contract: how many hosts have each statistic."""
    stats = written(host_stats(spark, d), "baselines")
    wide = bl.wide_baselines(stats, [*HOST, "baseline_horizon"], METRICS)
    dv.check_statistics(wide.columns, METRICS)
    return wide.groupBy("baseline_horizon").agg(*[F.count(f"{_M}_{s}").alias(s) for s in dv.STATISTICS])


@query(f"WITH {WEIGHTS}{HOSTS}{SEGMENTS}, {MACHINES} SELECT (SELECT count(*) FROM hosts)::BIGINT AS hosts, (SELECT count(*) FROM segments)::BIGINT AS segments, (SELECT count(*) FROM machines)::BIGINT AS machines, (SELECT count(*) FROM (SELECT 1 FROM hosts GROUP BY host_ip, role, time_band, baseline_horizon, metric HAVING count(*) > 1))::BIGINT AS repeated_keys")
def jon_input_guard(spark, d):
    """Inputs of routing that pass its guards: the agreed join keys, rows in each table, no key twice."""
    w = written(weighted(spark, d), "windows")
    hosts, segments = (written(bl.baselines(w, METRICS, k, SUPPORT), "baselines") for k in (HOST, SEGMENT_KEYS))
    names, keys = machines(spark, d), [*HOST, "baseline_horizon"]
    dv.check_keys([c for c in hosts.columns if c in keys], keys)
    dv.require_rows(hosts=hosts, segments=segments, machines=names)
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    counts = one(hosts, "hosts").crossJoin(one(segments, "segments")).crossJoin(one(names, "machines"))
    return counts.crossJoin(one(dv.duplicate_keys(hosts, [*keys, "metric"]), "repeated_keys"))
