"""One scan for many ranges, prefix tables, the index of key buckets, and the sampling law of forests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostscope.operators import baselines as bl
from hostscope.operators import forest
from hostscope.sources import readers
from hostscope.sources.bucketed_index import BucketedIndex, Conflict
from hostscope.sources.sinks import merge_batch_index
from hostscope.streaming import sessions as st


def test_ranges_share_one_pruned_scan(spark, tmp_path):
    rows = spark.range(400).select("id", F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("slice_end_ts")).withColumn("dt", F.date_format("slice_end_ts", "yyyy-MM-dd"))
    rows.write.partitionBy("dt").parquet(str(tmp_path / "s"))
    ranges = [("2024-01-09 00:00:00", "2024-01-09 03:00:00"), ("2024-01-02 12:00:00", "2024-01-03 00:00:00"), ("2024-01-02 20:00:00", "2024-01-03 02:00:00"), ("2030-01-01", "2030-01-02")]
    table = spark.read.schema("id long, slice_end_ts timestamp, dt string").parquet(str(tmp_path / "s"))
    out = readers.scan_ranges(table, ranges)
    want = sorted((a, i) for a, b in ranges for i, t in ((r.id, r.t) for r in rows.select("id", F.col("slice_end_ts").cast("string").alias("t")).collect()) if a <= t < b)
    assert sorted((r.range_start, r.id) for r in out.collect()) == want and len(want) == 3 + 12 + 6
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [((" in plan and "PushedFilters: [Or(" in plan
    assert len(out.select("dt").distinct().collect()) == 3


def test_ranges_of_a_warehouse(spark):
    """A database that comes with Spark: each range is one partition of the scan, and bounds are half open."""
    url = "jdbc:derby:memory:ranges;create=true"
    rows = spark.range(48).select(F.col("id").alias("ID"), F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("TS"))
    rows.write.jdbc(url, "SESSIONS", mode="overwrite", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    ranges = [("2024-01-02", "2024-01-02 05:00:00"), ("2024-01-01 03:00:00", "2024-01-01 06:00:00")]
    out = readers.read_ranges_jdbc(spark, url, "SESSIONS", "TS", ranges, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert out.rdd.getNumPartitions() == 2
    assert sorted(r.ID for r in out.collect()) == [3, 4, 5, 24, 25, 26, 27, 28]


def test_prefix_tables(spark, capsys):
    names = spark.createDataFrame([(i, f"Host{i:04d}-x") for i in range(2000)] + [(-1, None), (-2, ""), (-3, "h"), (7, "Host0007-x")], "id int, name string")
    prefixes = spark.createDataFrame([(f"hOST{i:04d}"[: 8 - i % 2],) for i in range(0, 20000, 2)] + [(None,), ("host0003-x and more",)], "prefix string")
    out = bl.with_any_prefix(names, "name", prefixes)
    want = {p[0].lower() for p in prefixes.collect() if p[0]}
    assert sorted(r.id for r in out.collect()) == sorted(r.id for r in names.collect() if r.name and any(r.name.lower()[:n] in want for n in range(1, 25)))
    out.explain("formatted")
    assert "NestedLoop" not in capsys.readouterr().out
    assert bl.with_any_prefix(names, "name", prefixes.limit(0)).count() == 0
    assert bl.with_any_prefix(names, "name", spark.createDataFrame([("",)], "prefix string")).count() == 2003


SCHEMA = "batch_id long, first_key long, status string, status_seq int"


def _index(spark, path, buckets=8):
    return BucketedIndex(spark, f"file://{path}", spark.createDataFrame([], SCHEMA).schema, ["batch_id"], buckets)


def _merge(a, b):
    return merge_batch_index(a, b, ["batch_id"], ["first_key"])


def test_an_upsert_rewrites_what_it_touches(spark, tmp_path):
    index = _index(spark, tmp_path)
    assert index.version() == 0 and index.read().count() == 0
    index.upsert(spark.createDataFrame([(i, i * 10, "NEW", 1) for i in range(100)], SCHEMA), _merge)
    before = index.manifest()
    touched = index.upsert(spark.createDataFrame([(3, 0, "DONE", 2), (500, 5, "NEW", 1)], SCHEMA), _merge)
    after = index.manifest()
    assert index.version() == 2 and 1 <= len(touched) <= 2
    assert {k for k in after if before.get(k) != after[k]} == set(touched)
    rows = {r.batch_id: tuple(r)[1:] for r in index.read().collect()}
    assert len(rows) == 101 and rows[3] == (30, "DONE", 2) and rows[4] == (40, "NEW", 1) and rows[500] == (5, "NEW", 1)
    assert {r.batch_id: r.status for r in index.read(1).collect()}[3] == "NEW"  # the version before is whole
    assert index.upsert(spark.createDataFrame([], SCHEMA), _merge) == [] and index.version() == 2


def test_of_two_writers_one_starts_again(spark, tmp_path):
    first, second = _index(spark, tmp_path), _index(spark, tmp_path)
    first.upsert(spark.createDataFrame([(i, i, "NEW", 1) for i in range(20)], SCHEMA), _merge)
    runs = []

    def race():
        """Between the first writer's files and its commit, the second one commits to the same buckets."""
        runs.append(1)
        if len(runs) == 1:
            second.upsert(spark.createDataFrame([(5, 0, "DONE", 2), (101, 1, "NEW", 1)], SCHEMA), _merge)

    first.upsert(spark.createDataFrame([(5, 0, "LATER", 3), (102, 2, "NEW", 1)], SCHEMA), _merge, before_commit=race)
    assert len(runs) == 2 and first.version() == 3
    rows = {r.batch_id: r.status for r in first.read().collect()}
    assert len(rows) == 22 and rows[5] == "LATER" and rows[101] == rows[102] == "NEW"
    with pytest.raises(Conflict):
        first.upsert(spark.createDataFrame([(5, 0, "X", 9)], SCHEMA), _merge, tries=1, before_commit=lambda: second.upsert(spark.createDataFrame([(6, 0, "Y", 9)], SCHEMA), _merge))
    assert {r.status for r in first.read().where("batch_id in (5, 6)").collect()} == {"LATER", "Y"}


@pytest.mark.parametrize(("n", "trees"), [(50, 20), (3000, 20), (3000, 3)])
def test_trees_draw_rows_by_one_law(spark, n, trees):
    """Each tree gets rate * n rows on average and pairs of trees overlap as independent draws do."""
    rate = min(1.0, 2.0 * 64 / n)
    rows = spark.range(n).select("id", forest._trees_of("id", rate, trees, 1).alias("t")).collect()
    drawn = np.zeros((n, trees), bool)
    for k, r in enumerate(rows):
        assert len(set(r.t)) == len(r.t) and all(0 <= t < trees for t in r.t)
        drawn[k, list(map(int, r.t))] = True
    assert abs(drawn.mean() - rate) < 4 * np.sqrt(rate * (1 - rate) / drawn.size) + 1e-12
    both = [(drawn[:, a] & drawn[:, b]).mean() for a in range(trees) for b in range(a)]
    assert abs(np.mean(both) - rate**2) < 0.01


def test_forests_of_small_and_large_tables_score_alike(spark):
    """Outliers stand out by the same score, whether a table is as small as a sample or much larger."""
    seen = {}
    for n in (400, 20_000):
        df = spark.range(n).select("id", F.randn(1).alias("a"), F.randn(2).alias("b"))
        score = forest.scorer(forest.fit(df, ["a", "b"], "id", trees=60, sample=128), ["a", "b"], 128)
        import pandas as pd

        seen[n] = score(pd.DataFrame({"a": [0.0, 6.0], "b": [0.0, -6.0]}))
        assert seen[n][1] > 0.6 > 0.5 > seen[n][0]
    assert np.allclose(seen[400], seen[20_000], atol=0.08)


def test_late_rows_are_told_by_the_last_batch(spark, tmp_path):
    schema = "event_start timestamp, n int"
    write = st.late_splitter(f"file://{tmp_path}")
    batches = [[("2024-01-01 10:00:00", 1)], [("2024-01-01 09:45:00", 2), ("2024-01-01 09:55:00", 3)], [], [("2024-01-01 09:30:00", 4), ("2024-01-01 12:00:00", 5)], [("2024-01-01 11:00:00", 6)]]
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "event_start string, n int").select(F.col("event_start").cast("timestamp"), "n") if rows else spark.createDataFrame([], schema)
        for _ in range(2 if n == 3 else 1):  # one is replayed
            write(frame, n)
    late = {r.n: r.late for r in spark.read.parquet(f"file://{tmp_path}/rows").collect()}
    assert late == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1}


def test_tables_of_equal_buckets_meet_without_a_shuffle(spark, sf):
    from hostscope.plans.baseline_queries import copartitioned

    out = copartitioned(spark, sf)
    assert out.count() > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and "Exchange" not in plan.replace("ReusedExchange", "Exchange")


def test_entries_come_in_pages(spark):
    from hostscope.operators.ranges import grouped_entries

    rows = [("a", f"b{i % 23:02d}", f"r{i % 2}", i % 5, i % 5 + 1) for i in range(100)] + [("b", "only", "r0", 1, 2), ("c", None, "r9", None, None), ("b", "only", "r0", 1, 2)]
    df = spark.createDataFrame(rows, "family string, batch_id string, reason string, start_ts int, end_ts int").repartition(5)
    out = {(r.family, r.page): r for r in grouped_entries(df, 10).collect()}
    assert sorted(out) == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0)]
    assert ",".join(out["a", k].batch_ids for k in range(3)) == ",".join(f"b{i:02d}" for i in range(23)) and out["a", 0].batch_ids.count(",") == 9
    assert (out["a", 1].reasons, out["a", 1].ranges, out["b", 0].ranges, out["b", 0].batch_ids) == ("r0,r1", 5, 1, "only")
    assert (out["c", 0].batch_ids, out["c", 0].reasons, out["c", 0].ranges) == ("", "r9", 0)
