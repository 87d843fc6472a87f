"""Queries on time ranges, completeness and planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostscope.operators import prep
from hostscope.operators import ranges as rg
from hostscope.plans.base_sql import SESSIONS
from hostscope.plans.registry import query
from hostscope.plans.slice_queries import t
from hostscope.sources.sessions import machines, sessions, table

START, END = "2024-01-03 00:00:00", "2024-01-10 00:00:00"
FAMILIES = {"delta": "fg_a", "fg_a": "fg_c", "pair_counts": "fg_b", "fg_b": "fg_c"}


def family_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Each session as a range of its type's family: overlapping ones are many."""
    e = table(spark, d, "events")
    s = sessions(spark, d).join(e.select(F.col("event_id").alias("session_id"), F.col("event_type").alias("family")), "session_id")
    hour = F.date_trunc("hour", "event_start")
    return s.select("family", hour.alias("start_ts"), F.timestamp_add("HOUR", (F.col("session_id") % 3).cast("int"), hour).alias("end_ts"))


RANGES = f"""{SESSIONS}, ranges AS (SELECT event_type AS family, date_trunc('hour', event_start) AS start_ts, date_trunc('hour', event_start) + to_hours(session_id % 3) AS end_ts FROM sessions JOIN events ON event_id = session_id)"""
MERGED = RANGES + """, o AS (SELECT *, max(end_ts) OVER (PARTITION BY family ORDER BY start_ts, end_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ranges WHERE start_ts < end_ts),
 i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ts > reach THEN 1 ELSE 0 END) OVER (PARTITION BY family ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS island FROM o),
 merged AS (SELECT family, min(start_ts) AS start_ts, max(end_ts) AS end_ts FROM i GROUP BY family, island)"""
_T = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[t(c).alias(c) if c in columns else F.col(c) for c in df.columns])


@query(f"WITH {MERGED} SELECT family, {_T('start_ts')} AS start_ts, {_T('end_ts')} AS end_ts FROM merged")
def win_merge_ranges(spark, d):
    return _text(rg.merge_ranges(family_ranges(spark, d)), "start_ts", "end_ts")


@query(f"WITH {RANGES} SELECT family, count(*) AS n FROM ranges WHERE start_ts >= end_ts GROUP BY ALL")
def win_invalid_ranges(spark, d):
    return rg.invalid_ranges(family_ranges(spark, d)).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SESSIONS} SELECT source_ip, session_id, destination_ip FROM (SELECT *, row_number() OVER (PARTITION BY source_ip ORDER BY event_start DESC, session_id DESC) AS k FROM sessions) WHERE k = 1")
def win_latest(spark, d):
    return rg.latest(sessions(spark, d).select("source_ip", "event_start", "session_id", "destination_ip"), ["source_ip"], ["event_start", "session_id"]).drop("event_start")


@query(f"WITH {MERGED}, n AS (SELECT *, (row_number() OVER (PARTITION BY family ORDER BY start_ts, end_ts) - 1) // 5 AS chunk, strftime(start_ts, '%Y-%m-%dT%H:%M:%S') || '/' || strftime(end_ts, '%Y-%m-%dT%H:%M:%S') AS line FROM merged) SELECT family, CAST(chunk AS INTEGER) AS chunk, {_T('min(start_ts)')} AS start_ts, {_T('max(end_ts)')} AS end_ts, count(*) AS ranges, left(sha1(string_agg(line, '|' ORDER BY line)), 16) AS digest FROM n GROUP BY family, chunk")
def win_chunks(spark, d):
    return _text(rg.chunk_ranges(rg.merge_ranges(family_ranges(spark, d)), 5), "start_ts", "end_ts")


_GRID = f"grid AS (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}' - INTERVAL 15 MINUTES, INTERVAL 15 MINUTES)) AS start_ts)"
_GAPS = f"{SESSIONS}, {_GRID}, gaps AS (SELECT start_ts, start_ts + INTERVAL 15 MINUTES AS end_ts FROM grid WHERE start_ts NOT IN (SELECT time_bucket(INTERVAL 15 MINUTES, event_start) FROM sessions))"


@query(f"WITH {_GAPS} SELECT {_T('start_ts')} AS start_ts, {_T('end_ts')} AS end_ts FROM gaps")
def jon_missing_slices(spark, d):
    return _text(rg.missing_slices(sessions(spark, d), START, END), "start_ts", "end_ts")


@query(f"WITH {SESSIONS}, days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS day) SELECT strftime(day, '%Y-%m-%d') AS day FROM days WHERE day NOT IN (SELECT event_start::DATE FROM sessions)")
def jon_missing_days(spark, d):
    return rg.missing_days(sessions(spark, d), "2023-12-28 00:00:00", "2024-02-04 00:00:00").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


def batch_index(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    branch = F.when(F.col("o_custkey") % 5 != 0, F.array(F.concat(F.lit("b"), (F.col("o_custkey") % 3).cast("string"))))
    return o.select(F.col("o_orderkey").cast("string").alias("batch_id"), F.timestamp_add("MINUTE", (F.col("o_orderkey") % 1440).cast("int"), F.col("o_orderdate").cast("timestamp")).alias("etl_ts"), branch.alias("branches"))


INDEX = "idx AS (SELECT o_orderkey::VARCHAR AS batch_id, o_orderdate + to_minutes(o_orderkey % 1440) AS etl_ts, CASE WHEN o_custkey % 5 <> 0 THEN 'b' || (o_custkey % 3) END AS branch FROM orders)"


@query(f"WITH {INDEX} SELECT batch_id, {_T('etl_ts')} AS etl_ts FROM idx WHERE etl_ts >= TIMESTAMP '1997-01-01' AND etl_ts < TIMESTAMP '1997-03-01' AND (branch IS NULL OR branch = 'b1')")
def jon_index_range(spark, d):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _text(rg.lookup_range(batch_index(spark, d), "1997-01-01 00:00:00", "1997-03-01 00:00:00", "b1").drop("branches"), "etl_ts")


@query(f"WITH {INDEX} SELECT batch_id, {_T('etl_ts')} AS etl_ts FROM idx WHERE etl_ts::DATE = DATE '1997-05-28' UNION ALL SELECT batch_id, {_T('etl_ts')} FROM idx WHERE batch_id = '7'")
def jon_index_day_and_batch(spark, d):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    idx = batch_index(spark, d).drop("branches")
    return _text(rg.lookup_day(idx, "1997-05-28").unionByName(rg.lookup_batch(idx, "7")), "etl_ts")


@query(f"""WITH {INDEX}, m AS (SELECT batch_id, etl_ts, list_max(list_filter([8, 23, 38, 53], lambda x: x <= minute(etl_ts))) AS a FROM idx)
 SELECT batch_id, strftime(CASE WHEN a IS NOT NULL THEN date_trunc('hour', etl_ts) + to_minutes(a) ELSE date_trunc('hour', etl_ts) - to_minutes(7) END, '%Y-%m-%d %H:%M:%S') AS start_ts, {_T('etl_ts')} AS end_ts FROM m""")
def jon_backfill_units(spark, d):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _text(rg.backfill_units(batch_index(spark, d)), "start_ts", "end_ts")


@query(f"WITH {RANGES}, a AS (SELECT DISTINCT family, start_ts FROM ranges WHERE start_ts < TIMESTAMP '2024-01-20'), b AS (SELECT DISTINCT family, start_ts FROM ranges WHERE start_ts >= TIMESTAMP '2024-01-12') SELECT (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS newly_missing, (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS resolved, 1 AS changed")
def set_manifest_difference(spark, d):
    r = family_ranges(spark, d)
    return rg.difference(r.where("start_ts < TIMESTAMP '2024-01-20'"), r.where("start_ts >= TIMESTAMP '2024-01-12'"), ["family", "start_ts"])


_BOTH = "w AS (SELECT l_suppkey AS window_label, count(*) FILTER (l_linestatus = 'F') AS rows_a, count(*) FILTER (l_linestatus = 'O') AS rows_b FROM lineitem GROUP BY 1)"


def _two_inputs(spark: SparkSession, d: str) -> list[DataFrame]:
    li = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "window_label")
    return [li.where(F.col("l_linestatus") == s) for s in "FO"]


@query(f"WITH {_BOTH} SELECT window_label FROM w WHERE rows_a > 0 AND rows_b > 0")
def set_intersection(spark, d):
    return prep.window_overlap(*_two_inputs(spark, d), 1).where("overlaps = 1").select("window_label")


@query(f"WITH {_BOTH} SELECT *, CAST(rows_a > 0 AND rows_b > 0 AS INTEGER) AS overlaps, CAST(least(rows_a, rows_b) >= 30 AS INTEGER) AS enough FROM w WHERE rows_a + rows_b > 0")
def agg_window_overlap(spark, d):
    return prep.window_overlap(*_two_inputs(spark, d), 30)


@query("SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1")
def set_distinct(spark, d):
    """One row a key subset, the same one in every run."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    return rg.latest(li, ["l_suppkey", "l_returnflag"], ["l_orderkey", "l_linenumber"])


_VERSIONS = "v AS (SELECT 'p' || o_custkey AS project_name, 'params#v' || (o_orderkey % 7) AS job_name_version, o_orderdate::DATE AS updated_at FROM orders WHERE o_orderstatus <> 'P')"


@query(f"WITH {_VERSIONS}, r AS (SELECT project_name, job_name_version, row_number() OVER (PARTITION BY project_name ORDER BY job_name_version = 'params#v3' DESC, updated_at DESC, job_name_version DESC) AS a, row_number() OVER (PARTITION BY project_name ORDER BY updated_at DESC, job_name_version DESC) AS b FROM v) SELECT project_name, replace(max(job_name_version) FILTER (a = 1), 'params#', '') AS preferred, replace(max(job_name_version) FILTER (b = 1), 'params#', '') AS latest FROM r GROUP BY ALL")
def win_latest_version(spark, d):
    """The version of each project, with and without a preferred one; rows of other jobs don't count."""
    o = table(spark, d, "orders")
    name = F.concat(F.when(F.col("o_orderstatus") == "P", "other").otherwise("params"), F.lit("#v"), (F.col("o_orderkey") % 7).cast("string"))
    v = o.select(F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("project_name"), name.alias("job_name_version"), F.to_date("o_orderdate").alias("updated_at"))
    a = rg.latest_version(v, "params", "v3").withColumnRenamed("version", "preferred")
    return a.join(rg.latest_version(v, "params").withColumnRenamed("version", "latest"), "project_name")


@query(f"""WITH {MERGED} SELECT family, count(*) AS ranges, CAST(family IN ('click', 'view', 'signup') AS INTEGER) AS execute, CASE WHEN family = 'click' THEN 'requested' WHEN family IN ('view', 'signup') THEN 'dependency' ELSE 'not_requested' END AS reason FROM merged GROUP BY ALL""")
def set_family_plan(spark, d):
    """What click needs needs signup in turn."""
    return rg.family_plan(rg.merge_ranges(family_ranges(spark, d)), {"click": ["view"], "view": ["signup"], "purchase": ["error"]}, ["click"])


@query(f"WITH {MERGED}, want AS (SELECT * FROM (VALUES ('click'), ('error'), ('none')) v(family)) SELECT want.family, count(start_ts) AS missing_ranges, CASE WHEN count(start_ts) = 0 THEN 'READY' ELSE 'MISSING_DEPENDENCIES' END AS verdict FROM want LEFT JOIN merged USING (family) GROUP BY ALL")
def set_readiness(spark, d):
    return rg.readiness(rg.merge_ranges(family_ranges(spark, d)), ["click", "error", "none"])


@query("""WITH i AS (SELECT DISTINCT event_type AS family, 'b' || (event_id % 611) AS batch_id FROM events), p AS (SELECT family, batch_id, CAST((row_number() OVER (PARTITION BY family ORDER BY batch_id) - 1) // 50 AS INTEGER) AS page FROM i),
 l AS (SELECT family, page, string_agg(batch_id, ',' ORDER BY batch_id) AS batch_ids FROM p GROUP BY ALL), r AS (SELECT event_type AS family, string_agg(DISTINCT 'r' || (user_id % 3), ',' ORDER BY 'r' || (user_id % 3)) AS reasons, count(DISTINCT (date_trunc('day', ts), date_trunc('hour', ts))) AS ranges FROM events GROUP BY ALL) SELECT * FROM l JOIN r USING (family)""")
def set_grouped_entries(spark, d):
    e = table(spark, d, "events")
    entries = e.select(F.col("event_type").alias("family"), F.concat(F.lit("b"), (F.col("event_id") % 611).cast("string")).alias("batch_id"), F.concat(F.lit("r"), (F.col("user_id") % 3).cast("string")).alias("reason"), F.date_trunc("day", "ts").alias("start_ts"), F.date_trunc("hour", "ts").alias("end_ts"))
    return rg.grouped_entries(entries, 50)


@query(f"""WITH {_GAPS}, days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS day), md AS (SELECT day::TIMESTAMP AS start_ts, day::TIMESTAMP + INTERVAL 1 DAY AS end_ts FROM days WHERE day NOT IN (SELECT event_start::DATE FROM sessions)),
 u AS (SELECT family, start_ts, end_ts, 'slices' AS source FROM gaps, (VALUES ('delta'), ('fg_a')) f(family) UNION ALL SELECT family, start_ts, end_ts, 'days' FROM md, (VALUES ('fg_b')) f(family)),
 o AS (SELECT *, max(end_ts) OVER (PARTITION BY family, source ORDER BY start_ts, end_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM u), i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ts > reach THEN 1 ELSE 0 END) OVER (PARTITION BY family, source ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS island FROM o)
 SELECT family, source, strftime(min(start_ts), '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(max(end_ts), '%Y-%m-%d %H:%M:%S') AS end_ts FROM i GROUP BY family, source, island""")
def set_missing_manifest(spark, d):
    s = sessions(spark, d)
    out = rg.missing_manifest(rg.missing_slices(s, START, END), rg.missing_days(s, "2023-12-28 00:00:00", "2024-02-04 00:00:00"), ["delta", "fg_a"], ["fg_b"])
    return _text(out, "start_ts", "end_ts")


@query("SELECT count(*) AS requested, count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS unverified, CAST(count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) = 0 AS INTEGER) AS complete FROM orders")
def set_completion(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return rg.completion(table(spark, d, "orders"), li, ["o_orderkey"])


@query("SELECT o_orderkey, strftime(o_orderdate - INTERVAL 4 MONTHS, '%Y-%m-%d %H:%M:%S') AS train_start_ts, strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS train_end_ts FROM orders")
def mlp_training_window(spark, d):
    return _text(table(spark, d, "orders").select("o_orderkey", *rg.training_window(F.col("o_orderdate"), 4, 1)), "train_start_ts", "train_end_ts")


@query(f"WITH {RANGES} SELECT {_T('min(start_ts) - INTERVAL 24 HOURS')} AS required_start_ts, {_T('max(end_ts)')} AS required_end_ts, {_T('min(start_ts) - INTERVAL 24 HOURS - INTERVAL 44 DAYS')} AS baseline_start_ts FROM ranges")
def mlp_history_envelope(spark, d):
    return _text(rg.history_envelope(family_ranges(spark, d)), "required_start_ts", "required_end_ts", "baseline_start_ts")


@query(f"WITH {RANGES}, l AS (SELECT *, lag(end_ts) OVER (PARTITION BY family ORDER BY start_ts, end_ts) AS p FROM ranges) SELECT family, count(*) AS n FROM l WHERE start_ts >= end_ts OR start_ts < p GROUP BY ALL")
def mlp_overlapping_windows(spark, d):
    return rg.overlapping_windows(family_ranges(spark, d)).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT machine_name, row_number() OVER (ORDER BY machine_name) AS place FROM (SELECT DISTINCT CASE WHEN user_id % 5 = 0 THEN 'VDI-' ELSE 'server-' END || user_id AS machine_name FROM events)")
def ord_deterministic(spark, d):
    return rg.numbered(machines(spark, d).select("machine_name").distinct(), ["machine_name"]).orderBy("machine_name")
