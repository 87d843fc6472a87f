"""Formula checks by hand-computed values, contracts, and properties."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hostscope.functions import net
from hostscope.operators import baselines as bl
from hostscope.operators import deviation as dv
from hostscope.operators import forest
from hostscope.operators import novelty as nov
from hostscope.operators import prep
from hostscope.operators import quality as q
from hostscope.operators import ranges as rg
from hostscope.operators import slices as sl
from hostscope.operators import windows as win
from hostscope.sources import readers, sinks
from hostscope.sources.sessions import PORT_SETS, SESSION_SCHEMA


def ts(text):
    return datetime.fromisoformat(text)


def test_slice_counters_of_one_row(spark):
    row = [("h", "outbound", ts("2024-01-01 11:45:00"), ts("2024-01-01 12:00:00"), 100.0, 200.0, 1.0, "allow", "tcp-rst-from-server", "TRAFFIC", "TCP", 443)]
    df = spark.createDataFrame(row, "host_ip string, role string, slice_start_ts timestamp, slice_end_ts timestamp, bytes_sent double, bytes_recv double, duration_sec double, event_action string, event_reason string, event_name string, network_transport string, peer_port int")
    out = df.groupBy(*sl.SLICE_KEYS).agg(*sl.base_counters(), *sl.port_counters(PORT_SETS)).first()
    assert (out.sessions_cnt, out.bytes_sent_sum, out.bytes_recv_sum, out.rst_cnt, out.tcp_cnt, out.allow_cnt, out.admin_port_sessions_cnt) == (1, 100.0, 200.0, 1, 1, 1, 0)


def test_window_sums_over_history(spark):
    rows = [("h", "outbound", ts("2024-01-01 11:45:00"), 10), ("h", "outbound", ts("2024-01-01 12:00:00"), 20), ("h", "outbound", ts("2023-12-31 12:00:00"), 40)]
    df = spark.createDataFrame(rows, "host_ip string, role string, slice_end_ts timestamp, sessions_cnt long")
    out = {r.window_label: r.sessions_cnt for r in win.window_sums(df, "2024-01-01 12:00:00").collect()}
    assert out == {"w_15m": 20, "w_30m": 30, "w_1h": 30, "w_8h": 30, "w_24h": 30}  # (anchor - 24 h, anchor]: 12:00 of the day before is out
    labels = ["w_15m", "w_30m", "w_1h", "w_8h", "w_24h"]
    assert [out[k] for k in labels] == sorted(out[k] for k in labels)


def test_novelty_of_the_fixture(spark):
    now = spark.createDataFrame([("h", "1.1.1.1", 80, 5, "w"), ("h", "2.2.2.2", 443, 5, "w"), ("h", "192.168.1.10", 22, 3, "w")], "host_ip string, peer_ip string, peer_port long, sessions_cnt long, window_label string")
    past = spark.createDataFrame([("h", "1.1.1.1", 80, ts("2023-12-20 00:00:00"))], "host_ip string, peer_ip string, peer_port long, slice_end_ts timestamp")
    known = nov.lookback(past, "2023-12-01 00:00:00", "2024-01-01 00:00:00")
    out = nov.novelty(now, known, ["window_label"], rare=0).first()
    assert (out.new_peer_cnt, out.rare_peer_cnt, out.new_port_cnt, out.new_pair_cnt) == (2, 2, 2, 2)
    risky = nov.high_risk_segments(now, ["192.168.1.0/24"], ["host_ip", "window_label"]).first()
    assert (risky.high_risk_segment_sessions_cnt, risky.high_risk_segment_peers, risky.has_high_risk_segment) == (3, 1, 1)


def test_deviation_formulas(spark):
    df = spark.createDataFrame([(20.0, 10.0, 5.0, 10.0)], "m double, m_median double, m_mad double, m_iqr double")
    out = dv.transforms(df, ["m"]).first()
    assert out.m_diff == 10
    assert out.m_ratio == pytest.approx(2, abs=1e-5)
    assert out.m_z_mad == pytest.approx(2, abs=1e-5)
    assert out.m_z_mad_clipped == pytest.approx(2, abs=1e-5)
    assert out.m_z_mad_cube == pytest.approx(8, abs=1e-4)
    assert out.m_log_ratio == pytest.approx(0.6931, abs=1e-4)


def test_tail_and_single_metric_score(spark):
    df = spark.createDataFrame([(10.0, 5.0, 8.0, 2.0, -2.5)], "m double, m_median double, m_p95 double, m_iqr double, m_z_mad double")
    out = dv.scores(df.select("*", *dv.tail_columns("m")), {"core_anomaly": ["m"]}).first()
    assert (out.m_excess_over_p95, out.m_iqr_dev, out.core_anomaly_score) == (2.0, 2.5, 2.5)
    assert out.m_ratio_p95 == pytest.approx(1.25, abs=1e-5)


def test_cold_start_routing(spark):
    rows = spark.createDataFrame([("warm", "s", 1.0), ("cold", "s", 1.0), ("unknown", "s", 1.0)], "host_ip string, segment_id string, m double")
    flags = spark.createDataFrame([("warm", 0), ("cold", 1)], "host_ip string, is_cold_start int")
    hosts = spark.createDataFrame([("warm", 10.0), ("cold", 11.0)], "host_ip string, m_median double")
    segments = spark.createDataFrame([("s", 100.0)], "segment_id string, m_median double")
    out = dv.route_baselines(rows, flags, hosts, segments, ["m"], ["host_ip"], ["host_ip"], ["segment_id"], ["median"])
    assert {r.host_ip: r.m_median for r in out.collect()} == {"warm": 10.0, "cold": 100.0, "unknown": 100.0}


def test_host_flags(spark):
    support = spark.createDataFrame([("a", 100), ("b", 10)], "host_ip string, sessions_cnt_support_count int")
    names = spark.createDataFrame([("a", "VDI-123"), ("b", "server-01")], "ip_address string, machine_name string")
    out = {r.host_ip: (r.is_full_history, r.is_non_persistent_machine, r.is_cold_start) for r in bl.host_flags(support, names, ["vdi"], ["host_ip"]).collect()}
    assert out == {"a": (1, 1, 1), "b": (0, 0, 1)}


def test_baseline_keeps_groups_without_clean_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 0.2), ("b", 2.0, 1.0)], "g string, m double, anomaly_weight double")
    out = {r.g: (r.median, r.support_count) for r in bl.baselines(df, ["m"], ["g"], exact=True).collect()}
    assert out == {"a": (None, 1), "b": (2.0, 1)}


def test_window_floor(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:40:05"),), (ts("2024-01-01 10:03:00"),)], "t timestamp")
    out = [r[0] for r in df.select(net.window_floor(F.col("t"), F.array(*map(F.lit, (8, 23, 38, 53))))).collect()]
    assert out == [ts("2024-01-01 10:38:00"), ts("2024-01-01 09:53:00")]


def test_segments(spark):
    df = spark.createDataFrame([("010.1.2.3",), ("x",), (None,), ("1.2.3",)], "ip string")
    assert [r[0] for r in df.select(net.segment_id(F.col("ip"))).collect()] == ["10.1.2.0/24", "SEG_UNKNOWN", "SEG_UNKNOWN", "SEG_UNKNOWN"]
    plan = df.select(net.segment_id(F.col("ip")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_field_mapping_contract(spark):
    df = spark.createDataFrame([("a", "b")], "src string, dst string")
    assert q.map_fields(df, {"src": "source_ip"}, ["source_ip"]).columns == ["source_ip", "dst"]
    for mapping, required in (({"none": "x"}, []), ({"src": "dst"}, []), ({}, ["source_ip"])):
        with pytest.raises(ValueError):
            q.map_fields(df, mapping, required)


def test_quality_rules(spark):
    rows = [(ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:05"), -1.0, None, 1, None), (ts("2024-01-01 00:00:05"), ts("2024-01-01 00:00:00"), 1.0, 2.0, 1, 2), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "event_start timestamp, event_end timestamp, source_bytes double, destination_bytes double, source_port int, destination_port int")
    assert [(r.source_bytes, r.duration_sec) for r in q.clean(df).collect()] == [(None, 5.0), (1.0, 0.0)]


def test_merge_is_idempotent(spark):
    rows = [("f", ts("2024-01-01 00:00:00"), ts("2024-01-01 02:00:00")), ("f", ts("2024-01-01 01:00:00"), ts("2024-01-01 03:00:00")), ("f", ts("2024-01-01 03:00:00"), ts("2024-01-01 04:00:00")), ("f", ts("2024-01-01 05:00:00"), ts("2024-01-01 06:00:00"))]
    df = spark.createDataFrame(rows, "family string, start_ts timestamp, end_ts timestamp")
    once = rg.merge_ranges(df)
    assert sorted((r.start_ts.hour, r.end_ts.hour) for r in once.collect()) == [(0, 4), (5, 6)]
    assert once.exceptAll(rg.merge_ranges(once)).isEmpty()


def test_missing_and_observed_make_the_grid(spark):
    seen = spark.createDataFrame([(ts("2024-01-01 00:20:00"),), (ts("2024-01-01 01:00:00"),)], "event_start timestamp")
    a, b = "2024-01-01 00:00:00", "2024-01-01 02:00:00"
    assert rg.missing_slices(seen, a, b).count() + 2 == rg.expected_slices(spark, a, b).count() == 8


def test_strict_and_compatible_scope(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert readers.scope_to_batch(df, batch_id="b", strict=False).count() == 1
    with pytest.raises(ValueError):
        readers.scope_to_batch(df, batch_id="b")


def test_time_scope_prunes_partitions(spark, tmp_path):
    df = spark.range(4).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("slice_end_ts")).withColumn("dt", F.date_format("slice_end_ts", "yyyy-MM-dd"))
    sinks.write_partitioned(df, str(tmp_path / "t"), ["dt"])
    out = readers.scope_to_range(spark.read.parquet(str(tmp_path / "t")), "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert out.count() == 1
    assert "PartitionFilters: [isnotnull(dt" in out._jdf.queryExecution().executedPlan().toString()


def test_windows_read_their_input_once(spark, sf):
    from hostscope.plans.slice_queries import slice_table

    plan = win.window_sums(slice_table(spark, sf), "2024-01-30 12:00:00")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_json_lines_and_ports(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        f.write('{"session_id": 1, "source_ip": "10.0.0.1", "extra": 1}\n{"session_id": 2}\n')
    df = readers.read_jsonlines(spark, str(tmp_path / "a.json.gz"), SESSION_SCHEMA, ["session_id", "source_ip"], 2)
    assert sorted(df.collect()) == [(1, "10.0.0.1"), (2, None)]
    (tmp_path / "ports.json").write_text('{"ADMIN_PORT": [22, 3389], "DB_PORT": [3306]}')
    assert readers.port_sets(spark, path=str(tmp_path / "ports.json")).count() == 3


def test_sources_in_order(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    spark.range(2).write.parquet(str(tmp_path / "full"))
    out = readers.read_first_available(spark, [("a", str(tmp_path / "none")), ("b", str(tmp_path / "empty")), ("c", str(tmp_path / "full"))]).first()
    assert (out.source_mode, out.resolution_reason) == ("c", "a: missing; b: empty; c: used")
    with pytest.raises(LookupError):
        readers.read_first_available(spark, [("a", str(tmp_path / "none"))])


def test_partition_replacement_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    path = str(tmp_path / "t")
    assert sinks.write_partitioned(df, path, ["p"]) == 2
    sinks.write_partitioned(spark.createDataFrame([(3, "a")], "x int, p string"), path, ["p"])
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [2, 3]
    with pytest.raises(ValueError):
        sinks.write_partitioned(df, path, ["nope"])
    manifest = sinks.snapshot_with_manifest(df, str(tmp_path / "s"), ["p"]).first()
    assert manifest.source_rows == manifest.written_rows == 2
    assert sinks.publish({"host": df, "segment": df}, str(tmp_path / "pub"), ["p"]) == {"host": 2, "segment": 2}
    with pytest.raises(ValueError):
        sinks.run_provenance(spark, "b", " ", "r", "", "", "")
    assert sinks.run_provenance(spark, "b", "m", "r", "s", "e", "p").count() == 1


def test_contracts(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        dv.require_rows(empty=df.limit(0))
    with pytest.raises(ValueError):
        dv.check_keys(["a"], ["a", "b"])
    with pytest.raises(ValueError):
        dv.check_statistics(["m_median"], ["m"])
    assert dv.duplicate_keys(df, ["k"]).count() == 1
    with pytest.raises(ValueError):
        prep.join_inputs([("a", df.limit(0), True)], ["k"])


def test_imputation_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "m double")
    s = prep.fit_scaling(df, ["m"])
    assert [r.m for r in prep.apply_scaling(df, s, ["m"]).collect()][3:] == [None, None]
    assert [r.m for r in prep.apply_scaling(df, s, ["m"], impute="median_scaled").collect()][3:] == [0.0, 0.0]


def test_correlated_feature_goes(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), F.rand(1).alias("c"))
    assert prep.prune_correlated(df, ["a", "b", "c"]) == ["a", "c"]


def test_forest_finds_the_outlier_and_scores_each_row_once(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (399, 2)), [[12.0, -12.0]]])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(id=range(400)))
    trees = forest.fit(df, ["a", "b"], "id", trees=30, sample=64)
    out = forest.score_batches(df, forest.scorer(trees, ["a", "b"], 64), ["id"], ["a", "b"], "v1", batch=100).toPandas()
    assert sorted(out["id"]) == list(range(400))
    assert out.loc[out["score"].idxmax(), "id"] == 399
    again = forest.score_batches(df.repartition(3), forest.scorer(forest.fit(df.repartition(3), ["a", "b"], "id", trees=30, sample=64), ["a", "b"], 64), ["id"], ["a", "b"], "v1").toPandas()
    assert np.allclose(out.sort_values("id")["score"], again.sort_values("id")["score"])
    impact = forest.permutation_impact(df, forest.scorer(trees, ["a", "b"], 64), ["a", "b"], "id").collect()
    assert {r.metric for r in impact} == {"a", "b"} and all(r.impact > 0 for r in impact)


def test_forest_split_keeps_children_apart():
    tree = forest.grow_tree(np.arange(16.0).reshape(-1, 1))
    assert tree["size"][0] == 16 and sum(s for s, f in zip(tree["size"], tree["feature"]) if f < 0) == 16
    near = forest.grow_tree(np.array([[1.0], [np.nextafter(1.0, 2)]]))  # neighbouring floats still part
    assert near["size"] == [2, 1, 1] and near["threshold"][0] == np.nextafter(1.0, 2)
    assert forest.grow_tree(np.zeros((4, 2)))["size"] == [4] and forest.grow_tree(np.zeros((0, 2)))["size"] == []


def test_family_plan_follows_dependencies_of_dependencies(spark):
    merged = spark.createDataFrame([(f, "2024-01-01", "2024-01-02") for f in "abcd"], "family string, start_ts string, end_ts string")
    out = {r.family: (r.execute, r.reason) for r in rg.family_plan(merged, {"a": ["b"], "b": ["c"], "c": ["a"], "d": ["a"]}, ["a"]).collect()}
    assert out == {"a": (1, "requested"), "b": (1, "dependency"), "c": (1, "dependency"), "d": (0, "not_requested")}


def test_numbered_orders_across_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r.v + 1 == r.place for r in rg.numbered(df, ["v"]).collect())
    assert rg.numbered(df.limit(0), ["v"]).count() == 0


def test_latest_version_prefers_and_falls_back(spark):
    rows = [("p", "params#v1", "2024-01-01"), ("p", "params#v2", "2024-01-02"), ("q", "params#v1", "2024-01-01"), ("q", "other#v9", "2024-02-01"), ("p", "params#v3", None)]
    df = spark.createDataFrame(rows, "project_name string, job_name_version string, updated_at string")
    pick = lambda *a: {r.project_name: r.version for r in rg.latest_version(df, "params", *a).collect()}
    assert pick() == {"p": "v2", "q": "v1"} and pick("v3") == {"p": "v3", "q": "v1"}


def test_routing_reads_sessions_once(spark, sf):
    from hostscope.plans.baseline_queries import routed

    plan = routed(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(props" not in plan  # sessions come from events' props; the machines' names don't


def test_late_rows_are_split_the_same_when_a_batch_is_replayed(spark, tmp_path):
    from hostscope.streaming import sessions as st

    out = f"file://{tmp_path}/out"
    sink = st.late_splitter(out)
    rows = lambda *times: spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("event_start"))
    first, second = rows("2024-01-01 10:00:00", "2024-01-01 11:00:00"), rows("2024-01-01 10:49:59", "2024-01-01 10:50:00", None, "2024-01-01 12:00:00")
    for batch, n in ((first, 0), (second, 1), (second, 1), (first, 0)):
        sink(batch, n)
    back = spark.read.parquet(f"{out}/rows")
    assert back.count() == 6 and [str(r.event_start) for r in back.where("late = 1").collect()] == ["2024-01-01 10:49:59"]


def test_forest_samples_large_tables_without_offering_each_row_to_each_tree(spark):
    df = spark.range(5000).select("id", F.rand(1).alias("x"))
    trees = forest.fit(df, ["x"], "id", trees=8, sample=64)
    sizes = [r["size"][0] for r in trees.collect()]
    assert len(sizes) == 8 and min(sizes) > 40 and max(sizes) == 64
    # a row is sent to the trees that drew it only: some 2 * 64 a tree, not 5000
    sent = df.select(F.sum(F.size(forest._trees_of("id", 2 * 64 / 5000, 8, 0)))).first()[0]
    assert 800 < sent < 1300


def test_partition_contract(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "dt string, k int")
    assert {(r.dt, r.rows, r.broken) for r in sinks.partition_contract(df, ["dt"], ["k"]).collect()} == {("a", 2, 1), (None, 1, 1)}
    with pytest.raises(ValueError, match="missing"):
        sinks.partition_contract(df, ["missing"], ["k"])
