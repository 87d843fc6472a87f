"""What merges, moves on or is selected: sketches, exact quantiles, cross products, window items, day rings, packed metrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostscope.operators import baselines as bl
from hostscope.operators import deviation as dv
from hostscope.operators import gram
from hostscope.operators import item_windows as iw
from hostscope.operators import novelty as nov
from hostscope.operators import packed as pk
from hostscope.operators import prep, selection
from hostscope.operators import sketches as sk
from hostscope.plans.slice_queries import pair_table, role_rows

LEVELS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_selected_quantiles_are_exact(spark, accuracy):
    """Groups of every size, ties, null keys and values; a coarse sketch brackets wider and changes nothing."""
    rng = np.random.default_rng(1)
    groups = {"a": rng.normal(0, 1, 5000), "b": rng.integers(0, 4, 3000).astype(float), "one": [7.0], "two": [1.0, 2.0], "five": [5.0, 1.0, 1.0, 9.0, -3.0], None: rng.exponential(1, 101), "same": [2.5] * 400, "wide": [-np.inf, 0.0, 1.0, 2.0, np.inf]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("a", None), ("a", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, value double").repartition(5)
    out = {r.k: (r.q, r.rows) for r in selection.quantiles(df, ["k"], LEVELS, accuracy=accuracy).collect()}
    assert out.keys() == groups.keys()
    for k, vs in groups.items():
        ordered, n = np.sort(np.array(vs, float)), len(vs)
        for got, p in zip(out[k][0], LEVELS, strict=True):
            a = int(np.floor(p * (n - 1)))
            b, part = min(a + 1, n - 1), p * (n - 1) - a
            want = ordered[a] if part == 0 or ordered[a] == ordered[b] else ordered[a] + (ordered[b] - ordered[a]) * part
            assert got == pytest.approx(want, abs=1e-12, nan_ok=True), (k, p)
        assert out[k][1] == n


def test_no_exact_percentile_is_planned(spark, sf, capsys):
    line = spark.read.parquet(f"{sf}/lineitem.parquet")
    prep.fit_scaling(line, ["l_quantity", "l_tax"]).explain("formatted")
    prep.score_metrics(line, line, "l_tax").explain("formatted")
    said = capsys.readouterr().out
    assert "percentile(" not in said and "Aggregate" in said


def test_exact_weights_and_baselines(spark):
    rng = np.random.default_rng(2)
    rows = [(f"g{i % 3}", float(v)) for i, v in enumerate(rng.normal(0, 1, 300))] + [("g0", 50.0)]
    out = bl.anomaly_weights(spark.createDataFrame(rows, "g string, m double"), ["m"], keys=["g"], exact=True).collect()
    for r in out:
        x = np.array([v for g, v in rows if g == r.g])
        mad = np.median(abs(x - np.median(x)))
        assert r.max_abs_z == pytest.approx(abs(r.m - np.median(x)) / (mad + 1e-6)) and (r.anomaly_weight < 1) == (r.max_abs_z > 6)


def test_sketch_rank_error_and_merging(spark):
    """A group of 200,000 rows in 20 days: merged sketches stay within half a percent of rank; small groups are exact."""
    days = spark.range(200_000, numPartitions=8).select(F.lit("h").alias("host"), (F.pmod(F.col("id") * 7919, F.lit(200_003)) / 7).alias("m"), F.timestamp_seconds(1704067200 + (F.col("id") % 20) * 86400 + 60).alias("window_end_ts"))
    small = spark.createDataFrame([("s", float(i)) for i in range(1000)], "host string, m double").select("*", F.timestamp_seconds(F.lit(1704067200 + 86400)).alias("window_end_ts"))
    daily = sk.daily_sketches(days.unionByName(small), ["m"], ["host"])
    bounds = bl.horizon_bounds(spark, "2024-01-21 00:00:00", [bl.Horizon("20d", 20), bl.Horizon("5d", 5)])
    out = {(r.host, r.baseline_horizon): r for r in sk.sketched_baselines(daily, bounds, ["host"]).collect()}
    assert out["h", "20d"].support_count == 200_000 and out["h", "5d"].support_count == 50_000
    whole = np.sort([r[0] for r in days.select("m").collect()])
    for name, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95), ("p99", 0.99)):
        assert abs(np.searchsorted(whole, out["h", "20d"][name]) / len(whole) - p) < 0.005
        assert out["s", "20d"][name] == np.ceil(p * 1000) - 1
    assert ("s", "5d") not in out


def test_sketches_leave_weighted_rows_and_nulls_out(spark):
    df = spark.createDataFrame([("g", float(i), 1.0) for i in range(10)] + [("g", 1e9, 0.2), ("g", None, 1.0), ("n", None, 1.0), ("w", 5.0, 0.2)], "g string, m double, anomaly_weight double")
    out = {r.g: (r.q, r.support) for r in sk.metric_sketches(df, ["m"], ["g"]).withColumn("q", sk.quantile(F.col("sketch"), [0.5, 1.0])).collect()}
    assert out == {"g": ([4.0, 9.0], 11), "n": (None, 0), "w": (None, 1)}


def test_cross_products_of_many_features(spark):
    """150 features in three blocks, with nulls, NaNs, a constant and a large mean, against numpy pair by pair."""
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, (300, 4))
    x = np.column_stack([base[:, j % 4] * (1 + j % 3) + rng.normal(0, 1 + j / 50, 300) for j in range(150)])
    x[:, 7], x[:, 9] = 3.0, 1e9 + base[:, 1]
    gone = rng.random((300, 150)) < 0.05
    names = [f"f{j}" for j in range(150)]
    rows = [[None if g and k % 2 else float("nan") if g else float(v) for k, (v, g) in enumerate(zip(r, gr, strict=True))] for r, gr in zip(x, gone, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(7)
    out = {(r.i, r.j): (r.n, r.r) for r in gram.correlations(df, names).collect()}
    assert len(out) == 150 * 149 // 2
    for (i, j), (n, r) in out.items():
        both = ~gone[:, i] & ~gone[:, j]
        assert n == both.sum()
        if 7 in (i, j):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)
    few = gram.correlations(df.limit(0), names[:2]).collect()
    assert few == [] and prep.prune_correlated(spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 1.0), (3.0, 6.0, 4.0)], "a double, b double, c double"), ["a", "b", "c"]) == ["a", "c"]


def test_windows_move_on_as_they_are_rebuilt(spark, sf):
    items = iw.slice_items(role_rows(spark, sf, 60)).persist()
    windows = {"w_1h": 60, "w_24h": 1440, "w_7d": 10080}
    stops = ["2024-01-20 00:00:00", "2024-01-20 01:00:00", "2024-01-23 05:00:00", "2024-01-23 06:00:00"]
    state = iw.window_items(items, stops[0], windows)
    for a, b in zip(stops, stops[1:], strict=False):
        state = iw.advance(state, items, a, b, windows)
        rebuilt = iw.window_items(items, b, windows)
        assert sorted(map(str, state.select(*rebuilt.columns).collect())) == sorted(map(str, rebuilt.collect()))
    items.unpersist()


def test_shapes_of_a_small_window(spark):
    rows = [("h", "outbound", "w", "peer", v, n, b) for v, n, b in (("p1", 3, 10), ("p2", 1, 30))] + [("h", "outbound", "w", "port", "80", 4, 40), ("h", "outbound", "w", "segment", None, 4, 40)]
    r = iw.window_shapes(spark.createDataFrame(rows, "host_ip string, role string, window_label string, item string, value string, n long, bytes long")).first()
    assert (r.peer_nunique, r.port_nunique, r.segment_nunique) == (2, 1, 0)
    assert r.peer_entropy == pytest.approx(-(0.75 * np.log(0.75) + 0.25 * np.log(0.25))) and r.port_entropy == pytest.approx(0)
    assert (r.top1_peer_sessions_share, r.top1_peer_bytes_share, r.top1_port_sessions_share) == (0.75, 0.75, 1.0)


def test_estimated_distincts_are_near(spark, sf):
    rows = role_rows(spark, sf, 60)
    windows = {"w_7d": 10080}
    exact = {(r.host_ip, r.role): r for r in iw.window_shapes(iw.window_items(iw.slice_items(rows), "2024-01-30 12:00:00", windows)).collect()}
    near = iw.window_distincts(iw.slice_distincts(rows), "2024-01-30 12:00:00", windows).collect()
    assert len(near) == len(exact)
    for r in near:
        e = exact[r.host_ip, r.role]
        assert all(abs(r[k] - e[k]) <= 1 + 0.05 * e[k] for k in ("peer_nunique", "port_nunique", "segment_nunique"))


def test_rings_move_on_as_they_are_rebuilt(spark, sf):
    pairs = pair_table(spark, sf).persist()
    ring = nov.day_ring(pairs, "2024-01-01", 5)
    for day in range(6, 13):
        ring = nov.advance_ring(ring, pairs, f"2024-01-{day:02d}", 5)
        rebuilt = nov.day_ring(pairs, f"2024-01-{day - 4:02d}", 5)
        assert sorted(map(str, ring.collect())) == sorted(map(str, rebuilt.collect()))
        batch = nov.lookback(pairs, f"2024-01-{day - 4:02d} 00:00:00", f"2024-01-{day + 1:02d} 00:00:00")
        assert sorted(map(str, nov.ring_lookback(ring).drop("days_seen", "active_days").collect())) == sorted(map(str, batch.collect()))
    pairs.unpersist()
    with pytest.raises(ValueError, match="64"):
        nov.day_ring(pairs, "2024-01-01", 65)


def test_packed_transforms_equal_columns(spark):
    rng = np.random.default_rng(9)
    names = [f"m{j}" for j in range(6)]
    rows = [(f"h{i % 3}", *map(float, rng.integers(0, 50, 6))) for i in range(60)]
    df = spark.createDataFrame(rows, "host string, " + ", ".join(f"{n} double" for n in names)).withColumn("m5", F.lit(None).cast("double"))
    stats = bl.wide_baselines(bl.baselines(df, names, ["host"]), ["host"], names, ("median", "p95", "iqr", "mad"))
    wide = dv.transforms(df.join(stats, "host"), names)
    packed = pk.pack(df.withColumn("id", F.monotonically_increasing_id()), names)
    out = pk.transforms(packed.join(pk.packed_statistics(packed, ["host"], 6), "host"))
    cols = [c for f in dv.TRANSFORMS for c in pk.unpacked(out, names, names, f)]
    want = wide.select("host", *[f"{m}_{f}" for f in dv.TRANSFORMS for m in names])
    rounded = lambda d: sorted(str([None if v is None else round(v, 9) + 0.0 if isinstance(v, float) else v for v in r]) for r in d.collect())
    assert rounded(out.select("host", *cols)) == rounded(want)


def test_packed_plan_does_not_grow(spark):
    def size(width):
        rows = spark.range(3).select(F.lit("h").alias("host"), F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: k.cast("double")).alias("values"))
        out = pk.transforms(rows.join(pk.packed_statistics(rows, ["host"], width), "host"))
        return len(out._jdf.queryExecution().optimizedPlan().toString())

    assert size(440) < size(10) + 50


def _least(values, p: str):
    """The least value that holds a share p of the rows."""
    from fractions import Fraction

    ordered = np.sort(np.array(values, float))
    return ordered[max(1, -(-len(ordered) * Fraction(p).numerator // Fraction(p).denominator)) - 1]


SHARES = ("0.25", "0.5", "0.75", "0.95", "0.99")


def _large_and_small(seed: int) -> list[tuple[str, float]]:
    rng = np.random.default_rng(seed)
    return [("big", float(v)) for v in rng.exponential(1000, 25_000)] + [("ties", float(v)) for v in rng.integers(0, 40, 12_000)] + [("small", float(v)) for v in rng.normal(0, 1, 333)]


def test_weights_of_large_segments_are_exact(spark):
    rows = _large_and_small(11)
    out = bl.anomaly_weights(spark.createDataFrame(rows, "g string, m double").repartition(5), ["m"], keys=["g"]).collect()
    assert len(out) == len(rows)
    want = {}
    for g in {g for g, _ in rows}:
        x = np.array([v for k, v in rows if k == g])
        want[g] = _least(x, "0.5"), _least(abs(x - _least(x, "0.5")), "0.5")
    for r in out:
        assert r.max_abs_z == pytest.approx(abs((r.m - want[r.g][0]) / (want[r.g][1] + 1e-6)), rel=1e-12)


def test_baselines_of_large_groups_are_exact(spark):
    rows = [(g, v, 1.0) for g, v in _large_and_small(12)] + [("big", 1e12, 0.2), ("small", None, 1.0), (None, 4.0, 1.0), ("unclean", 5.0, 0.2)]
    df = spark.createDataFrame(rows, "g string, m double, anomaly_weight double").repartition(5)
    out = {r.g: r for r in bl.baselines(df, ["m"], ["g"]).collect()}
    assert out.keys() == {"big", "ties", "small", None, "unclean"} and out["unclean"].median is None and out["unclean"].support_count == 1
    for g in ("big", "ties", "small", None):
        x = [v for k, v, w in rows if k == g and v is not None and w >= 1]
        assert [out[g][c] for c in ("p25", "median", "p75", "p95", "p99")] == [_least(x, p) for p in SHARES]
    assert out["big"].support_count == 25_001 and out["small"].support_count == 333


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_discrete_quantiles_are_exact(spark, accuracy):
    rows = _large_and_small(13) + [("one", 7.0), ("none", None), ("none", float("nan"))]
    out = {r.k: (r.q, r.rows) for r in selection.discrete(spark.createDataFrame(rows, "k string, value double").repartition(3), ["k"], [float(p) for p in SHARES], accuracy=accuracy).collect()}
    assert out.pop("none") == (None, 0)
    for k, (q, n) in out.items():
        x = [v for g, v in rows if g == k]
        assert q == [_least(x, p) for p in SHARES] and n == len(x)


def test_a_rank_outside_of_its_bracket_is_found(spark):
    """Brackets that miss on either side, and one that holds its rank."""
    rows = spark.range(1000).select(F.struct(F.lit("a").alias("k")).alias("_key"), F.col("id").cast("double").alias("_v"))
    marks = spark.range(1).select(F.struct(F.lit("a").alias("k")).alias("_key"), F.array(*map(F.lit, (0.0, 0.0, 0.0))).alias("_q"), F.array(*map(F.lit, (600.0, 700.0, 10.0, 20.0, 740.0, 760.0))).alias("_b"), F.lit(1000).alias("_all"))
    assert selection.refined(marks, rows, [0.25, 0.5, 0.75], 100).first()._q == [249.0, 499.0, 749.0]


def test_sketched_baselines_of_large_groups_are_exact(spark):
    rows = _large_and_small(14)
    df = spark.createDataFrame([(g, v, i % 5) for i, (g, v) in enumerate(rows)], "host string, m double, d int").repartition(4).select("host", "m", F.timestamp_seconds(1704067200 + F.col("d") * 86400 + 60).alias("window_end_ts"))
    bounds = bl.horizon_bounds(spark, "2024-01-06 00:00:00", [bl.Horizon("5d", 5)])
    out = {r.host: r for r in sk.sketched_baselines(sk.daily_sketches(df, ["m"], ["host"]), bounds, ["host"], rows=bl.long_metrics(df, ["m"])).collect()}
    for g in ("big", "ties", "small"):
        x = [v for k, v in rows if k == g]
        assert [out[g][c] for c in ("p25", "median", "p75", "p95", "p99")] == [_least(x, p) for p in SHARES] and out[g].support_count == len(x)


def test_totals_turn_long_after_their_shuffle(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 3.0, 5.0), (2, None, None)], "k int, a double, b double")
    out = bl.long_totals(df, ["a", "b"], ["k"])
    assert {(r.k, r.metric): (r.n, r.total) for r in out.collect()} == {(1, "a"): (2, 5.0), (1, "b"): (1, 5.0), (2, "a"): (0, None), (2, "b"): (0, None)}
    from hostscope.plans import QUERIES

    plan = QUERIES["prj_split_columns"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate inline") < plan.index("HashAggregate")


def test_cross_products_with_and_without_gaps(monkeypatch):
    """Batches of which some features have gaps in some rows, all or none, against numpy; features in no batch have no pair."""
    import pyarrow as pa

    monkeypatch.setattr(gram.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    rng = np.random.default_rng(21)
    x = rng.normal(5, 2, (900, 70))
    x[:300, 3] = np.nan
    x[350:360, [4, 69]] = np.inf
    x[600:][rng.random((300, 70)) < 0.2] = np.nan
    cuts = [x[:300], x[300:600], x[600:600], x[600:]]
    sent = list(gram._products(70, np.where(np.isfinite(x[0]), x[0], 0.0))(pa.RecordBatch.from_arrays([pa.array(c[:, i]) for i in range(70)], [str(i) for i in range(70)]) for c in cuts))
    got = {(i, j): (n, r) for b in gram._pairs(70)(sent) for i, j, n, r in zip(*(b.column(c).to_pylist() for c in ("i", "j", "n", "r")), strict=True)}
    assert len(got) == 70 * 69 // 2
    for (i, j), (n, r) in got.items():
        both = np.isfinite(x[:, i]) & np.isfinite(x[:, j])
        assert n == both.sum() and r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
