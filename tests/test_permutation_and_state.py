"""The keyed permutation against its properties, and the stateful slices against a count by hand."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hostscope.operators import forest
from hostscope.operators.permutation import feistel, permuted, sides
from hostscope.streaming import sessions as st
from hostscope.streaming import stateful


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1009, 5000])
def test_places_are_a_bijection(spark, n):
    a, b = sides(n)
    assert n <= a * b <= n + a
    seen = {}
    for seed in (0, 1):
        got = [r[0] for r in spark.range(n).select(feistel(F.col("id"), n, seed)).collect()]
        assert sorted(got) == list(range(n))
        seen[seed] = got
    if n >= 1000:  # neither in place, nor in step, nor alike under another key
        p = np.array(seen[0])
        assert (p == np.arange(n)).mean() < 0.01 and (np.diff(p) == 1).mean() < 0.01 and (p == np.array(seen[1])).mean() < 0.01
        assert abs(np.corrcoef(p, np.arange(n))[0, 1]) < 0.1


def test_values_move_with_one_permutation(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("k"), (F.col("id") * 2).alias("a"), (F.col("id") * 3).alias("b"))
    out = permuted(df.repartition(7), ["k"], ["a", "b"]).collect()
    assert sorted(r._m_a for r in out) == sorted(r.a for r in out) and all(r._m_a * 3 == r._m_b * 2 for r in out)
    again = permuted(df.repartition(2), ["k"], ["a", "b"]).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert permuted(df.limit(0), ["k"], ["a"]).count() == 0 and permuted(df.limit(1), ["k"], ["a"]).first()._m_a == 0


def test_impact_of_a_model_that_is_known(spark):
    rng = np.random.default_rng(3)
    rows = [(f"r{i:05d}", float(rng.normal()), float(rng.normal()), 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double")
    out = {r.metric: r.impact for r in forest.permutation_impact(df, lambda p: 3 * p["a"] + p["b"], ["a", "b", "c"], "id").collect()}
    assert out["c"] == 0 and out["a"] == pytest.approx(3 * 2 / np.sqrt(np.pi), rel=0.08) and out["b"] == pytest.approx(2 / np.sqrt(np.pi), rel=0.08)


def test_slices_and_late_rows_are_all_rows(spark, tmp_path):
    """Shuffled arrivals in four runs of one checkpoint: each role's row is in a closed slice or late, by the watermark of the runs before."""
    stateful.keyed_state(spark)
    rng = np.random.default_rng(7)
    at = pd.Timestamp("2024-01-01 10:00:00")
    rows = [(i, "10.0.0.1" if i % 3 else "10.0.0.2", "172.16.0.1", 50_000, 443, float(i % 5), float(rng.integers(0, 240)), "drop" if i % 4 == 0 else "allow", int(rng.integers(0, 3))) for i in range(300)]
    schema = "session_id long, source_ip string, destination_ip string, source_port int, destination_port int, source_bytes double, minute double, event_action string, run int"
    df = spark.createDataFrame(rows, schema).select("*", (F.lit(str(at)).cast("timestamp") + F.make_dt_interval(mins=F.col("minute").cast("int"))).alias("event_start"))
    full = df.select("session_id", "source_ip", "destination_ip", "source_port", "destination_port", "event_start", F.col("event_start").alias("event_end"), "source_bytes", F.lit(0.0).alias("destination_bytes"), "event_action", F.lit("x").alias("event_reason"), F.lit("TRAFFIC").alias("event_name"), F.lit("TCP").alias("network_transport"), "run")
    base = f"file://{tmp_path}"

    def run():
        stream = spark.readStream.schema(full.drop("run").schema).parquet(f"{base}/in")
        st.drain(stateful.slices_and_late_rows(stream), f"{base}/out", f"{base}/check")

    for n in range(3):
        full.where(F.col("run") == n).drop("run").coalesce(1).write.mode("append").parquet(f"{base}/in")
        run()
    full.limit(1).drop("run").withColumns({c: F.lit("2025-01-01 00:00:00").cast("timestamp") for c in ("event_start", "event_end")}).write.mode("append").parquet(f"{base}/in")
    run()
    out = spark.read.parquet(f"{base}/out").toPandas()
    want_late, want = set(), {}
    seen = None
    for n in range(3):
        part = [r for r in rows if r[-1] == n]
        for r in part:
            start = at + pd.Timedelta(minutes=int(r[6] // 15) * 15)
            late = seen is not None and start + pd.Timedelta(minutes=15) <= seen - pd.Timedelta(minutes=10)
            for role, host, sent in (("outbound", r[1], r[5]), ("inbound", r[2], 0.0)):
                if late:
                    want_late.add((r[0], role, host, start))
                else:
                    k = want.setdefault((host, role, start), [0, 0.0, 0])
                    k[0], k[1], k[2] = k[0] + 1, k[1] + sent, k[2] + (r[7] == "drop")
        top = max(at + pd.Timedelta(minutes=int(r[6])) for r in part)
        seen = top if seen is None else max(seen, top)
    late = out[out.kind == "late"]
    assert {(int(r.session_id), r.role, r.host_ip, r.slice_start_ts) for r in late.itertuples()} == want_late and len(late) == len(want_late) > 50
    slices = {(r.host_ip, r.role, r.slice_start_ts): [r.sessions_cnt, r.bytes_sent_sum, r.drop_cnt] for r in out[out.kind == "slice"].itertuples()}
    assert slices == want and sum(v[0] for v in slices.values()) + len(late) == 600


def test_many_hosts_of_a_slice_cost_one_call_to_the_state():
    from unittest import mock

    held, handle, timers = mock.Mock(), mock.Mock(), mock.Mock()
    handle.getValueState.return_value = held
    timers.getCurrentWatermarkInMs.return_value = 0
    held.get.return_value = None
    p = stateful.SliceProcessor(15)
    p.init(handle)
    pdf = pd.DataFrame({"host_ip": [f"h{i % 50}" for i in range(200)], "role": "outbound", "session_id": range(200), "bytes_sent": [1.0, np.nan] * 100, "event_action": ["drop", "allow"] * 100})
    assert not list(p.handleInputRows((0, 1), iter([pdf[:120], pdf[120:]]), timers))
    assert (held.get.call_count, held.update.call_count, handle.registerTimer.call_count) == (1, 1, 1)
    held.get.return_value = held.update.call_args.args[0]
    assert not list(p.handleInputRows((0, 1), iter([pdf]), timers)) and handle.registerTimer.call_count == 1
    held.get.return_value = held.update.call_args.args[0]
    (out,) = p.handleExpiredTimer((0, 1), timers, None)
    assert len(out) == 50 and (out.kind == "slice").all() and (out.sessions_cnt == 8).all()
    assert out.bytes_sent_sum.tolist() == [8.0 if int(h[1:]) % 2 == 0 else 0.0 for h in out.host_ip] and out.drop_cnt.sum() == 200
    timers.getCurrentWatermarkInMs.return_value = 15 * 60_000
    (late,) = p.handleInputRows((0, 1), iter([pdf]), timers)
    assert (late.kind == "late").all() and late.session_id.tolist() == list(range(200)) and held.update.call_count == 2
