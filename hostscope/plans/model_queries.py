"""Queries on model inputs, feature preparation, scoring and publication of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostscope.functions import net
from hostscope.operators import baselines as bl
from hostscope.operators import forest
from hostscope.operators import gram
from hostscope.operators import prep
from hostscope.operators import quality as q
from hostscope.plans.base_sql import counters
from hostscope.plans.registry import query
from hostscope.plans.slice_queries import slice_table, t
from hostscope.sources.sessions import table

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_linenumber"]


def features(spark: SparkSession, d: str) -> DataFrame:
    """Line items as a feature table: a copy of the price makes one feature redundant, and one is constant."""
    return table(spark, d, "lineitem").select(*KEYS, "l_shipdate", "l_returnflag", *FEATURES, (F.col("l_extendedprice") * 2).alias("price_copy"), F.lit(1.0).alias("constant"))


@query("SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 6) AS quantity, round(sum(o_totalprice), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def jon_feature_inputs(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice", F.lit(0.0).alias("l_quantity"))
    out = prep.join_inputs([("lines", li, True), ("orders", o, True), ("nothing", o.limit(0), False)], ["k"])
    return out.groupBy(F.col("k").alias("l_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("WITH p AS (SELECT l_orderkey, l_linenumber, max(l_quantity) / 50 AS score, max(l_tax) AS l_tax FROM lineitem GROUP BY ALL), f AS (SELECT l_orderkey, l_linenumber, min(l_discount) AS l_discount FROM lineitem WHERE l_linenumber < 5 GROUP BY ALL) SELECT * FROM p JOIN f USING (l_orderkey, l_linenumber)")
def jon_predictions(spark, d):
    """Predictions joined with features on their keys, each key once; a prediction's own columns win over the features' of the same name."""
    f = features(spark, d)
    p = f.groupBy(*KEYS).agg((F.max("l_quantity") / 50).alias("score"), F.max("l_tax").alias("l_tax"))
    own = f.where("l_linenumber < 5").groupBy(*KEYS).agg(F.min("l_discount").alias("l_discount"), F.min("l_tax").alias("l_tax"))
    return prep.join_predictions(p, own, KEYS)


@query("WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_discount > 0.05) SELECT (SELECT count(*) FROM a)::BIGINT AS keys_a, (SELECT count(*) FROM b)::BIGINT AS keys_b, (SELECT count(*) FROM a JOIN b USING (k))::BIGINT AS keys_both, (SELECT count(*) FROM a JOIN b USING (k)) / (SELECT count(*) FROM a) AS coverage")
def jon_key_coverage(spark, d):
    return prep.key_coverage(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "lineitem").where("l_discount > 0.05").select(F.col("l_orderkey").alias("k")), ["k"])


def _scaling_sql() -> str:
    one = lambda f: f"SELECT '{f}' AS metric, quantile_cont({f}, 0.5) AS median, quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) AS iqr, (SELECT quantile_cont(abs({f} - (SELECT quantile_cont({f}, 0.5) FROM lineitem)), 0.5) FROM lineitem) AS mad FROM lineitem"
    return "sc AS (" + " UNION ALL ".join(map(one, FEATURES)) + ")"


@query(f"WITH {_scaling_sql()} SELECT metric, round(median, 6) AS median, round(iqr, 6) AS iqr, round(mad, 6) AS mad FROM sc")
def mlp_fit_scaling(spark, d):
    s = prep.fit_scaling(features(spark, d), FEATURES)
    return s.select("metric", *[F.round(c, 6).alias(c) for c in ("median", "iqr", "mad")])


@query(f"WITH {_scaling_sql()} SELECT l_orderkey, l_linenumber, {', '.join(f'''round(greatest(least(({f} - (SELECT median FROM sc WHERE metric = '{f}')) / ((SELECT CASE WHEN mad > 0 THEN mad WHEN iqr > 0 THEN iqr ELSE 1.0 END FROM sc WHERE metric = '{f}') + 1e-6), 6.0), -6.0), 5) AS {f}''' for f in FEATURES)} FROM lineitem")
def mlp_apply_scaling(spark, d):
    f = features(spark, d).select(*KEYS, *FEATURES)
    out = prep.apply_scaling(f, prep.fit_scaling(f, FEATURES), FEATURES)
    return out.select(*KEYS, *[F.round(c, 5).alias(c) for c in FEATURES])


@query("SELECT CASE WHEN l_shipdate < TIMESTAMP '2001-06-01' - INTERVAL 365 DAYS THEN 'train' ELSE 'valid' END AS part, count(*) AS n FROM lineitem GROUP BY ALL")
def mlp_time_split(spark, d):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    f = features(spark, d).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    a, b = prep.time_split(f, "2001-06-01 00:00:00", 365, "l_shipdate")
    return a.select(F.lit("train").alias("part")).unionByName(b.select(F.lit("valid").alias("part"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT metric, variance, keep FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS metric, round(var_pop({e}), 4) AS variance, CAST(var_pop({e}) > 1e-9 AS INTEGER) AS keep FROM lineitem" for f, e in [*[(x, x) for x in FEATURES], ("constant", "1.0::DOUBLE")]) + ")")
def mlp_varying_features(spark, d):
    return prep.varying_features(features(spark, d), [*FEATURES, "constant"]).select("metric", F.round("variance", 4).alias("variance"), "keep")


_C = [*FEATURES, "price_copy"]
_E = {f: f for f in FEATURES} | {"price_copy": "l_extendedprice * 2"}


@query(" UNION ALL ".join(f"SELECT '{_C[i]}' AS a, '{_C[j]}' AS b, round(corr({_E[_C[i]]}, {_E[_C[j]]}), 6) AS r FROM lineitem" for j in range(len(_C)) for i in range(j)))
def mlp_correlations(spark, d):
    return prep.correlations(features(spark, d), _C).select("a", "b", F.round("r", 6).alias("r"))


def _pruned_sql(most: float = 0.95) -> str:
    """Keeps feature after feature: one that no kept one before is too close to."""
    rs = " UNION ALL ".join(f"SELECT '{_C[i]}' AS a, '{_C[j]}' AS b, corr({_E[_C[i]]}, {_E[_C[j]]}) AS r FROM lineitem" for j in range(len(_C)) for i in range(j))
    steps = [f"k{j + 1} AS (SELECT CASE WHEN (SELECT count(*) FROM r, k{j} WHERE b = '{f}' AND list_contains(kept, a) AND abs(r) > {most}) > 0 THEN kept ELSE list_append(kept, '{f}') END AS kept FROM k{j})" for j, f in enumerate(_C)]
    return f"WITH r AS MATERIALIZED ({rs}), k0 AS (SELECT []::VARCHAR[] AS kept), {', '.join(steps)} SELECT l_returnflag, feature, count(*) AS n FROM lineitem, (SELECT unnest(kept) AS feature FROM k{len(_C)}) GROUP BY ALL"


@query(_pruned_sql())
def mlp_prune_correlated(spark, d):
    f = features(spark, d)
    kept = prep.prune_correlated(f, _C)
    return f.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).select("l_returnflag", F.explode(F.array(*map(F.lit, kept))).alias("feature"), "n")


#: Features of the wide table, as many as a full catalogue of metrics has; pairs with the first ones are compared with SQL.
WIDE, AGAINST = 440, 2
_W = [f"m{j:03d}" for j in range(WIDE)]


def _wide(j: int) -> str:
    """A feature that leans on one of four, by a share that falls with its number; the same text in both engines."""
    return f"{FEATURES[j % 4]} * {('2e-2', '2e-5', '1e1', '1e1')[j % 4]} + ((l_orderkey * {j + 7} + l_linenumber * 13) % {j + 11}) / {1 + (440 - j) // 20}e0"


@query(f"""WITH w AS (SELECT {', '.join(f'CAST({_wide(j)} AS DOUBLE) AS {m}' for j, m in enumerate(_W))} FROM lineitem), c AS (SELECT {', '.join(f'corr({_W[i]}, {_W[j]}) AS c{i}_{j}' for i in range(AGAINST) for j in range(i + 1, WIDE))} FROM w)
 SELECT CAST(split_part(substr(name, 2), '_', 1) AS INTEGER) AS i, CAST(split_part(name, '_', 2) AS INTEGER) AS j, round(r, 5) AS r FROM (UNPIVOT c ON COLUMNS(*) INTO NAME name VALUE r)""")
def mlp_wide_correlations(spark, d):
    """All pairs of 440 features from one pass; those with the first two features are returned."""
    f = table(spark, d, "lineitem").select(*[F.expr(f"CAST({_wide(j)} AS DOUBLE)").alias(m) for j, m in enumerate(_W)])
    return gram.correlations(f, _W).where(F.col("i") < AGAINST).select("i", "j", F.round("r", 5).alias("r"))


_DRAWN = f"""b AS (SELECT {', '.join(FEATURES)}, l_extendedprice / 1000 + l_quantity AS score, concat_ws('|', l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d')) AS id FROM lineitem),
 u AS (SELECT b.*, run, CAST('0x' || substr(md5(id || '|' || run), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM b, range(10) r(run)), w AS (SELECT *, CASE WHEN u >= 0.981012 THEN 4 WHEN u >= 0.919699 THEN 3 WHEN u >= 0.735759 THEN 2 WHEN u >= 0.367879 THEN 1 ELSE 0 END AS w FROM u)"""


def _stable_sql() -> str:
    one = lambda f: f"SELECT '{f}' AS metric, run, sum(w) AS n, sum(w * {f}) AS x, sum(w * score) AS y, sum(w * {f} * {f}) AS xx, sum(w * score * score) AS yy, sum(w * {f} * score) AS xy FROM w WHERE {f} IS NOT NULL GROUP BY run"
    return f"""WITH {_DRAWN}, s AS ({' UNION ALL '.join(map(one, FEATURES))}), r AS (SELECT metric, run, abs((xy - x * y / n) / sqrt((xx - x * x / n) * (yy - y * y / n))) AS r FROM s),
 k AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY r DESC, metric) AS k FROM r) SELECT metric, count(*) FILTER (k <= 2) / 10 AS picked, CAST(count(*) FILTER (k <= 2) / 10 >= 0.6 AS INTEGER) AS keep FROM k GROUP BY metric"""


@query(_stable_sql())
def mlp_stable_features(spark, d):
    key = F.concat_ws("|", *KEYS, F.date_format("l_shipdate", "yyyy-MM-dd"))
    f = features(spark, d).withColumn("score", F.col("l_extendedprice") / 1000 + F.col("l_quantity")).withColumn("id", key)
    return prep.stable_features(f, FEATURES, "score", "id")


@query("WITH v AS (" + " UNION ALL ".join(f"SELECT '{f}' AS metric, round(var_pop({f}), 4) AS importance FROM lineitem" for f in FEATURES) + ") SELECT metric, importance, CAST(row_number() OVER (ORDER BY importance DESC, metric) AS INTEGER) AS rank FROM v QUALIFY row_number() OVER (ORDER BY importance DESC, metric) <= 2")
def ord_top_half(spark, d):
    v = prep.varying_features(features(spark, d), FEATURES).select("metric", F.round("variance", 4).alias("importance"))
    return prep.top_half(v)


_SC = "s AS (SELECT l_shipdate < TIMESTAMP '1999-01-01' AS tr, l_extendedprice AS score FROM lineitem), th AS (SELECT quantile_cont(score, 0.95) AS x, quantile_cont(score, 0.5) AS m, stddev_pop(score) AS sd FROM s WHERE tr)"
_SM = f"{_SC}, m AS (SELECT abs((SELECT quantile_cont(score, 0.5) FROM s WHERE NOT tr) - m) / sd AS drift, x AS threshold, (SELECT avg(CASE WHEN score > x THEN 1.0 ELSE 0.0 END) FROM s WHERE NOT tr) AS alert_rate, (SELECT avg(CASE WHEN score > x THEN 1.0 ELSE 0.0 END) FROM s WHERE NOT tr) - (SELECT avg(CASE WHEN score > x THEN 1.0 ELSE 0.0 END) FROM s WHERE tr) AS alert_delta FROM th)"


def _metrics(spark, d):
    s = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts"), F.col("l_extendedprice").alias("score"))
    cut = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return prep.score_metrics(s.where(F.col("ts") < cut), s.where(F.col("ts") >= cut))


@query(f"WITH {_SM} SELECT round(drift, 6) AS drift, round(threshold, 6) AS threshold, round(alert_rate, 6) AS alert_rate, round(alert_delta, 6) AS alert_delta FROM m")
def mlp_score_metrics(spark, d):
    return _metrics(spark, d).select(*[F.round(c, 6).alias(c) for c in ("drift", "threshold", "alert_rate", "alert_delta")])


@query(f"WITH {_SM} SELECT metric, round(value, 6) AS value, most, CAST(abs(value) <= most AS INTEGER) AS passed FROM (SELECT 'drift' AS metric, drift AS value, 0.5::DOUBLE AS most FROM m UNION ALL SELECT 'alert_rate', alert_rate, 0.01 FROM m UNION ALL SELECT 'alert_delta', alert_delta, 0.02 FROM m)")
def mlp_promotion_gates(spark, d):
    return prep.gates(_metrics(spark, d), {"drift": 0.5, "alert_rate": 0.01, "alert_delta": 0.02}).withColumn("value", F.round("value", 6))


@query("SELECT count(*) AS \"rows\", count(DISTINCT (l_orderkey, l_linenumber)) AS keys, count(DISTINCT l_returnflag) AS windows, count(DISTINCT l_shipdate::DATE) AS days, round(count(*) / count(DISTINCT (l_orderkey, l_linenumber)), 6) AS rows_per_key, 1 AS enough_rows, 0 AS enough_days FROM lineitem")
def agg_input_profile(spark, d):
    return prep.input_profile(features(spark, d), KEYS, "l_shipdate", 1000, 1_000_000, "l_returnflag").withColumn("rows_per_key", F.round("rows_per_key", 6))


@query("WITH w AS (SELECT * FROM (VALUES (1, TIMESTAMP '1997-01-01', TIMESTAMP '1998-01-01'), (2, TIMESTAMP '1999-06-01', TIMESTAMP '1999-07-01'), (3, TIMESTAMP '2030-01-01', TIMESTAMP '2031-01-01')) v(window_id, s, e)) SELECT window_id, count(l_orderkey) AS records FROM w LEFT JOIN lineitem ON l_shipdate >= s AND l_shipdate < e GROUP BY ALL")
def agg_scored_in_windows(spark, d):
    w = spark.createDataFrame([(1, "1997-01-01", "1998-01-01"), (2, "1999-06-01", "1999-07-01"), (3, "2030-01-01", "2031-01-01")], "window_id int, a string, b string")
    w = w.select("window_id", F.col("a").cast("timestamp_ntz").alias("start_ts"), F.col("b").cast("timestamp_ntz").alias("end_ts"))
    return prep.scored_in_windows(w, features(spark, d), "l_shipdate")


@query(" UNION ALL ".join(f"SELECT l_orderkey, '{f}' AS feature, count({x}) AS n, round(sum({x}), 4) AS total FROM lineitem GROUP BY ALL" for f, x in (*((f, f) for f in FEATURES), ("price_copy", "l_extendedprice * 2"), ("constant", "1.0"))))
def prj_split_columns(spark, d):
    """The feature columns of every row in long form, by order; metadata columns stay out."""
    f = features(spark, d)
    _, feats = q.split_columns(f, KEYS)
    return bl.long_totals(f, feats, ["l_orderkey"]).select("l_orderkey", F.col("metric").alias("feature"), "n", F.round("total", 4).alias("total"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 0.0 WHEN 1 THEN event_id / 10 WHEN 2 THEN event_id / 10 ELSE event_id END::DOUBLE AS prediction FROM events")
def mlp_extract_prediction(spark, d):
    i = F.col("event_id")
    ten = (i / 10).cast("string")
    raw = F.when(i % 4 == 0, '{"score": 0}').when(i % 4 == 1, F.concat(F.lit('{"prediction": '), ten, F.lit("}"))).when(i % 4 == 2, F.concat(F.lit("["), ten, F.lit("]"))).otherwise(i.cast("string"))
    return table(spark, d, "events").select("event_id", net.extract_prediction(raw).alias("prediction"))


def hosts_features(spark, d):
    s = slice_table(spark, d, 1440)
    return s.withColumn("id", F.concat_ws("|", "host_ip", "role", F.date_format("slice_start_ts", "yyyy-MM-dd"))), ["sessions_cnt", "bytes_sent_sum", "bytes_recv_sum", "duration_sum"]


def _forest_sql(trees: int, sample: int, x: list[str], seed: int = 0, ask: str = "SELECT id, x FROM xs") -> str:
    """Tables of a forest in SQL, from rows f(id, and a column a feature) on: ``splits`` are its trees, ``scored`` the scores of the rows asked for."""
    places = range(1, len(x) + 1)
    bits = lambda name: f"CAST('0x' || substr(md5({name}), 1, 12) AS BIGINT)"
    u = lambda what: f"(({bits(f"tree || '|' || node || '|{what}|{seed}'")} + 0.5) / 281474976710656.0::DOUBLE)"
    step = lambda k: f"(CASE WHEN rate >= 1 THEN 0 ELSE CAST(floor(ln(({bits(f"id || '|' || {k} || '|{seed}'")} + 0.5) / 281474976710656.0::DOUBLE) / ln(1 - rate)) AS BIGINT) END)"
    bounds = lambda over: f"[{', '.join(f'min(x[{i}]) {over}' for i in places)}] AS lo, [{', '.join(f'max(x[{i}]) {over}' for i in places)}] AS hi"

    def split(rows: str, keep: str) -> str:
        some = f"SELECT *, [i FOR i IN {list(places)} IF hi[i] > lo[i]] AS v FROM ({rows})"
        one = f"SELECT *, v[1 + CAST(floor({u('feature')} * len(v)) AS BIGINT)] AS feature FROM ({some}) WHERE len(v) > 0 AND depth < lim"
        cut = f"SELECT *, lo[feature] + {u('cut')} * (hi[feature] - lo[feature]) AS c FROM ({one})"
        return f"SELECT {keep}, feature, CASE WHEN c > lo[feature] AND c <= hi[feature] THEN c ELSE hi[feature] END AS cut FROM ({cut})"

    mean = lambda n: f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1.0::DOUBLE) + 0.5772156649::DOUBLE) - 2 * ({n} - 1.0::DOUBLE) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    whole = "OVER (PARTITION BY tree, node)"
    return f"""xs AS (SELECT id, [{', '.join(f'coalesce({c}, 0)::DOUBLE' for c in x)}] AS x, least(1.0, {2.0 * sample}::DOUBLE / (count(*) OVER ())) AS rate FROM f),
 drawn AS (SELECT id, x, rate, 0 AS k, {step('0')} AS tree FROM xs UNION ALL SELECT id, x, rate, k + 1, tree + 1 + {step('(k + 1)')} FROM drawn WHERE tree < {trees}),
 sampled AS (SELECT id, x, tree FROM drawn WHERE tree < {trees} QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {bits(f"id || '|' || tree || '|{seed}|sample'")}, id) <= {sample}),
 grown AS (SELECT id, x, tree, 1::BIGINT AS node, 0 AS depth, CAST(ceil(log2(greatest(count(*) OVER (PARTITION BY tree), 2))) AS INTEGER) AS lim FROM sampled
 UNION ALL SELECT id, x, tree, CASE WHEN x[feature] < cut THEN 2 * node ELSE 2 * node + 1 END, depth + 1, lim FROM ({split(f'SELECT *, {bounds(whole)} FROM grown', 'id, x, tree, node, depth, lim')})),
 nodes AS (SELECT tree, node, depth, any_value(lim) AS lim, count(*) AS size, {bounds('')} FROM grown GROUP BY ALL), splits AS ({split('SELECT * FROM nodes', 'tree, node')}),
 walk AS (SELECT id, x, tree, 1::BIGINT AS node FROM ({ask}), (SELECT DISTINCT tree FROM nodes) UNION ALL SELECT id, x, w.tree, CASE WHEN x[feature] < cut THEN 2 * w.node ELSE 2 * w.node + 1 END FROM walk w JOIN splits s ON s.tree = w.tree AND s.node = w.node),
 leaves AS (SELECT w.id, depth + {mean('size')} AS path FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node ANTI JOIN splits s ON s.tree = w.tree AND s.node = w.node),
 root AS (SELECT {mean(f'least({sample}, size)')} AS expect FROM nodes WHERE node = 1 ORDER BY tree LIMIT 1),
 scored AS (SELECT id, power(2.0, -(sum(path) / (SELECT count(DISTINCT tree) FROM nodes)) / (SELECT greatest(expect, 1e-9) FROM root)) AS score FROM leaves GROUP BY id)"""


_HOST_FEATURES = ["sessions_cnt", "bytes_sent_sum", "bytes_recv_sum", "duration_sum"]
_HOST_ROWS = f"f AS (SELECT host_ip || '|' || role || '|' || strftime(slice_start_ts, '%Y-%m-%d') AS id, host_ip, role, {', '.join(_HOST_FEATURES)} FROM slices)"


@query(f"WITH RECURSIVE {counters(1440)}, {_HOST_ROWS}, {_forest_sql(32, 128, _HOST_FEATURES)} SELECT id, host_ip, role, round(score, 9) AS score, 'forest-v1' AS model_version FROM scored JOIN f USING (id)")
def mlp_isolation_forest(spark, d):
    """Scores of all host days by a forest whose draws SQL repeats: samples, splits and the way of each row."""
    s, f = hosts_features(spark, d)
    trees = forest.fit(s, f, "id", trees=32, sample=128)
    out = forest.score_batches(s, forest.scorer(trees, f, 128), ["id", "host_ip", "role"], f, "forest-v1")
    return out.withColumn("score", F.round("score", 9))


@query(f"WITH RECURSIVE {counters(1440)}, {_HOST_ROWS}, {_forest_sql(16, 64, _HOST_FEATURES)} SELECT tree::INTEGER AS tree_id, count(*) AS nodes, (sum(size) FILTER (node = 1))::BIGINT AS sampled, count(feature) AS splits, round(coalesce(sum(cut * feature), 0), 3) AS cuts FROM nodes LEFT JOIN splits USING (tree, node) GROUP BY tree")
def mlp_forest_trees(spark, d):
    """The trees themselves: their nodes, sampled rows and cuts."""
    s, f = hosts_features(spark, d)
    trees = forest.fit(s, f, "id", trees=16, sample=64)
    node = F.explode(F.arrays_zip("feature", "threshold", "size"))
    nodes = trees.select("tree_id", F.element_at("size", 1).cast("long").alias("sampled"), node.alias("n"))
    at_split = F.col("n.feature") >= 0
    return nodes.groupBy("tree_id", "sampled").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_if(at_split).alias("splits"), F.round(F.coalesce(F.sum(F.when(at_split, F.col("n.threshold") * (F.col("n.feature") + 1))), F.lit(0.0)), 3).alias("cuts"),
    )

def _feistel_sql(p: str, step: int) -> str:
    """One walk of the permutation over the grid (a, b) of table g, as nested subqueries of its four rounds."""
    noise = lambda v, r, most: f"CAST('0x' || substr(md5({v} || '|{r}|0'), 1, 12) AS BIGINT) % {most}"
    return f"""w{step} AS (SELECT place, CASE WHEN inside THEN p ELSE x * b + y END AS p FROM (SELECT place, p, inside, b, x, (y + {noise('x', 3, 'b')}) % b AS y FROM (SELECT place, p, inside, a, b, (x + {noise('y', 2, 'a')}) % a AS x, y FROM (SELECT place, p, inside, a, b, x, (y + {noise('x', 1, 'b')}) % b AS y
 FROM (SELECT place, p, inside, a, b, (x + {noise('y', 0, 'a')}) % a AS x, y FROM (SELECT place, p, {'false' if step == 0 else 'p < n'} AS inside, a, b, p // b AS x, p % b AS y FROM {p}, g))))))"""


_IMPACT = {"sessions_cnt": 0.5, "bytes_sent_sum": 0.001, "bytes_recv_sum": -0.002, "duration_sum": 0.01}
_STEPS = 8  # after some steps all places are inside, whatever the number of rows here


_MOVED = f"""n AS (SELECT count(*) AS n FROM f),
 g0 AS (SELECT n, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a FROM n), g AS (SELECT n, a, (n + a - 1) // a AS b FROM g0), w AS (SELECT place, place AS p FROM f), {_feistel_sql('w', 0)}, {', '.join(_feistel_sql(f'w{k - 1}', k) for k in range(1, _STEPS))},
 j AS (SELECT h.*, {', '.join(f'o.{c} AS o_{c}' for c in _IMPACT)} FROM w{_STEPS - 1} w JOIN f o ON o.place = w.place JOIN f h ON h.place = w.p)"""


@query(f"""WITH {counters(1440)}, f AS (SELECT {', '.join(_IMPACT)}, row_number() OVER (ORDER BY host_ip || '|' || role || '|' || strftime(slice_start_ts, '%Y-%m-%d')) - 1 AS place FROM slices), {_MOVED}
 {' UNION ALL '.join(f"SELECT '{c}' AS metric, round(avg(abs(({c} - o_{c}) * {k})), 6) AS impact FROM j" for c, k in _IMPACT.items())}""")
def mlp_linear_impact(spark, d):
    """Permutation impact of a model that is known in full, so that SQL can repeat the permutation and the scores."""
    s, f = hosts_features(spark, d)
    out = forest.permutation_impact(s, lambda p: sum(p[c].astype(float) * k for c, k in _IMPACT.items()), f, "id")
    return out.select("metric", F.round("impact", 6).alias("impact"))


_ASK = " UNION ALL ".join(f"SELECT '{m}#' || id AS id, [{', '.join(f'coalesce({("o_" if c == m else "") + c}, 0)::DOUBLE' for c in _HOST_FEATURES)}] AS x FROM j" for m in ("plain", *_HOST_FEATURES))


@query(f"""WITH RECURSIVE {counters(1440)}, {_HOST_ROWS.replace(' FROM slices', ", row_number() OVER (ORDER BY host_ip || '|' || role || '|' || strftime(slice_start_ts, '%Y-%m-%d')) - 1 AS place FROM slices")}, {_MOVED},
 {_forest_sql(16, 128, _HOST_FEATURES, ask=_ASK)}
 SELECT metric, round(avg(abs(m.score - p.score)), 9) AS impact FROM (SELECT split_part(id, '#', 1) AS metric, split_part(id, '#', 2) AS id, score FROM scored) m JOIN scored p ON p.id = 'plain#' || m.id WHERE metric <> 'plain' GROUP BY metric""")
def mlp_permutation_impact(spark, d):
    """How much a forest's scores move when a feature takes another row's value; SQL repeats the forest and the permutation."""
    s, f = hosts_features(spark, d)
    return forest.permutation_impact(s, forest.scorer(forest.fit(s, f, "id", trees=16, sample=128), f, 128), f, "id").withColumn("impact", F.round("impact", 9))


_LIN = "sessions_cnt * 0.5 + bytes_sent_sum / 1000"


@query(f"WITH {counters(1440)} SELECT host_ip, role, strftime(slice_start_ts, '%Y-%m-%d %H:%M:%S') AS slice_start, round({_LIN}, 6) AS score, 'linear-v1' AS model_version FROM slices")
def mlp_batch_scoring(spark, d):
    """A linear model passed in as a function of a batch; each row is scored once."""
    s = slice_table(spark, d, 1440).withColumn("slice_start", t("slice_start_ts"))
    out = forest.score_batches(s, lambda p: p["sessions_cnt"].astype(float) * 0.5 + p["bytes_sent_sum"] / 1000, ["host_ip", "role", "slice_start"], ["sessions_cnt", "bytes_sent_sum"], "linear-v1")
    return out.withColumn("score", F.round("score", 6))
