"""Sharding, quality rules, mixing and exact deduplication against brute force and SQL."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hostscope.llm import dedup, mixing, quality, queries, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jump(key, n):
    key, b, j = key & (1 << 64) - 1, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_of_any_key(spark):
    from pyspark.sql import functions as F

    keys = [0, 1, -1, 2**63 - 1, -(2**63), 123456789, *range(2, 300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 200):
        assert [r[0] for r in df.select(sharding.jump_hash(F.col("k"), n)).collect()] == [jump(k, n) for k in keys]


def test_sharding(make, odd):
    out = sharding.shard(make(odd)).collect()
    assert len(out) == len(odd)
    for r in out:
        assert r.law == "key" and r.shard == jump(r.doc_id or 0, 8) and r.grown_shard == jump(r.doc_id or 0, 9)
        assert r.grown_shard in (r.shard, 8)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(make([])).count() == 0


def signals(text):
    w = WORD.findall(text or "")
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_signals(make, odd):
    extra = [(500, "a b c a b c"), (501, "a a a a"), (502, "l\nl\n \n \nl x\nl"), (503, "#*$ %& |<>é"), (504, "a b"), (505, "a b c d a b c")]
    rows = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.signals(make(odd + extra)).collect()}
    assert rows == {(i, *signals(t)) for i, t, *_ in odd + extra}


def test_binomial_tail(spark):
    from math import comb

    from pyspark.sql import functions as F

    cases = [(0, 10), (3, 400), (5, 1000), (0, 1), (40, 5000), (9, 10)]
    df = spark.createDataFrame(cases, "k long, n long")
    p = 0.0125
    for (k, n), r in zip(cases, df.select(quality.binomial_tail(F.col("k"), F.col("n"), p)).collect(), strict=True):
        want = 1.0 if k > n * p else sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert r[0] == pytest.approx(want, rel=1e-8)


def test_cutoffs_reject_little_of_the_good(spark, make):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 997}" for k in range(60)) + (" ###" * 40 if i % 4 == 0 else ""), "en") for i in range(4000)]
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(3600)], "doc_id long, quality int")
    out = quality.quality(make(rows), labels).collect()
    assert sum(not r.kept for r in out if r.doc_id % 4 == 0) == 1000
    assert sum(not r.kept for r in out if r.doc_id % 4) <= 0.05 * 3000
    few = quality.quality(make(rows), labels.where("doc_id < 200")).collect()
    assert all(r.kept != r.base_failed for r in few)  # too few labels to promise anything


def test_cutoffs_are_tolerance_bounds_of_the_holdout(spark):
    """The cutoff is the strictest that its own rejections allow by the exact tail, and rules without gain stay off."""
    from math import comb

    n, p, alpha = 3000, quality.RISK / 4, (1 - quality.CONFIDENCE) / 4
    most = max(k for k in range(60) if sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) <= alpha)
    rows = [("en", i, 100, 500, 10 * i if i < n else 29_400 + (i * 7) % 600, 0, 0, i < n) for i in range(n + 500)]
    rows += [("fr", i, 100, 500, i % 2, 0, 0, i % 5 > 0) for i in range(300)]
    df = spark.createDataFrame(rows, "stratum string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, good boolean")
    df = df.withColumn("word_chars", F.lit(30_000))
    out = {r.stratum: r for r in quality.cutoffs(df, confidence=1 - 2 * (1 - quality.CONFIDENCE)).collect()}  # two strata, so alpha as above
    assert out["en"].n_holdout == n and out["fr"].n_holdout == 240
    cut = out["en"].cut_symbols_per_char
    rejected = sum(r[7] and r[1] * 10 / 30_000 > cut for r in rows if r[0] == "en")
    step = n * p / quality.STEPS
    assert most - step - 1 <= rejected <= most  # bad ones lie among the greatest 60 of the good ones
    assert out["en"].cut_dup_lines_per_word is None and out["en"].cut_chars_per_word is None  # nothing to gain
    assert out["fr"].cut_symbols_per_char is None  # too few labels


def test_binding_cutoffs_equal_the_sql(spark, make, tmp_path):
    """Query and SQL on a table in which cutoffs reject documents of two languages."""
    import duckdb

    noise = lambda i, m: (i * 2654435761 >> 7) % m
    rows = [(i, " ".join(f"w{(i * 7 + k) % 997}" for k in range(60 + noise(i, 9))) + " #" * (noise(i, 12) + (9 if i % 5 == 0 else 0)), ("en", "fr", None)[(i % 7 > 3) + (i % 100 == 0)]) for i in range(5000)]
    make(rows).write.parquet(f"file://{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 0 if i % 5 == 0 else 1) for i in range(5000) if i % 11], "doc_id long, quality int")
    labels.write.parquet(f"file://{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(queries.oracle_sql()["op3_quality_rules"]).df().sort_values("doc_id").reset_index(drop=True)
    got = queries.queries()["op3_quality_rules"](spark, f"file://{tmp_path}").toPandas().sort_values("doc_id").reset_index(drop=True)[list(want.columns)]
    assert got.astype(want.dtypes.to_dict()).equals(want)
    lang = {r[0]: r[2] for r in rows}
    over = got[~got.base_failed & ~got.kept]
    assert {"en", "fr"} == {lang[i] for i in over.doc_id} and (over.doc_id % 5 == 0).mean() > 0.9


def test_quality_of_odd_rows(spark, make, odd):
    labels = spark.createDataFrame([(5, 1), (None, 1), (6, None), (777, 1)], "doc_id long, quality int")
    out = quality.quality(make(odd), labels)
    assert out.count() == len(odd)
    assert all(not r.kept for r in out.collect() if r.n_words < 50)
    assert quality.quality(make([]), labels.limit(0)).count() == 0


def fill(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        if not (over := [s for s in left if share[s] > 2 * sizes[s]]):
            return full | share
        full |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(make, odd):
    docs = make(odd)
    out = mixing.mix(docs).collect()
    assert len(out) == len(odd)
    sizes = Counter()
    for r in out:
        sizes[r.source] += r["size"]
    want = fill(sizes)
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[r.source]
    assert all(taken[s] == round(want[s]) for s in sizes)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert mixing.mix(make([])).count() == 0
    assert [r.taken for r in mixing.mix(make([(1, None), (2, "")])).collect()] == [0, 0]


@pytest.mark.parametrize("files", [1000, 1])
def test_exact_dedup(make, odd, files):
    docs = make(odd).repartition(3)
    groups = defaultdict(list)
    for i, t, *_ in odd:
        groups[t or ""].append(i)
    out = dedup.exact_dedup(docs, files_per_batch=files).collect()
    assert len(out) == len(odd)
    want = {}
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, hashlib.sha256(t.encode()).hexdigest()] = (keep, len(ids))
    for r in out:
        assert (r.keep_id, r.group_size) == want[r.doc_id, r.text_sha256] and (not r.kept or r.doc_id == r.keep_id)
    assert Counter(r.text_sha256 for r in out if r.kept) == {hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups}


def test_locators_lead_to_the_kept_text(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.unionByName(docs.where("doc_id < 20")).repartition(3).write.parquet(str(tmp_path / "d"))
    out = dedup.exact_dedup(spark.read.parquet(str(tmp_path / "d")))
    at = spark.read.parquet(str(tmp_path / "d")).select("doc_id", "text", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("keep_locator"))
    rows = out.join(at.withColumnRenamed("doc_id", "there"), "keep_locator").select("*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")).collect()
    assert len(rows) == out.count() == docs.count() + docs.where("doc_id < 20").count()
    assert all(r.there == r.keep_id and r.digest == r.text_sha256 for r in rows)
    assert len({r.text_sha256 for r in rows}) == sum(r.kept for r in rows)


def test_exact_dedup_of_nothing(make):
    assert dedup.exact_dedup(make([])).count() == 0


def test_digest_clash_is_told_apart(make, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(dedup.F, "sha2", lambda c, n: F.lit("same"))
    out = {r.doc_id: (r.keep_id, r.group_size) for r in dedup.exact_dedup(make([(1, "a"), (2, "a"), (3, "b")])).collect()}
    assert out == {1: (2, 2), 2: (2, 2), 3: (3, 1)}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(name, spark, sf, compare):
    rows = queries.table(spark, sf, "embeddings" if name.startswith("op12") else "documents").count()
    assert compare(queries.queries()[name], queries.oracle_sql()[name]) == rows > 0


def test_native_plans_run_no_python(spark, sf):
    """No plan that these queries run, on the way or in the end, holds Python."""
    store = spark._jsparkSession.sharedState().statusStore()
    for name in ("op1_sharding", "op3_quality_rules", "op5_mixing", "op9_exact_dedup"):
        before = store.executionsCount()
        queries.queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        ran = store.executionsList(before, 10_000)
        plans = [ran.apply(i).physicalPlanDescription() for i in range(ran.size())]
        assert plans and not [p for p in plans if re.search("Python|Pandas|ArrowEval|InArrow", p)]
