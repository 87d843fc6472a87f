"""Data work on model inputs: joins, robust scaling, splits, feature filters, checks and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostscope.operators import gram, selection
from hostscope.operators.baselines import long_metrics
from hostscope.sources.scratch import written


def join_inputs(inputs: Sequence[tuple[str, DataFrame, bool]], keys: Sequence[str]) -> DataFrame:
    """(name, table, required) inner-joined on keys; an empty optional input is left out, an empty required one raises.

    A column that an earlier input has is dropped from later ones, so no name is ambiguous.
    """
    used, seen = [], set(keys)
    for name, df, required in inputs:
        if df.isEmpty():
            if required:
                raise ValueError(f"the required input {name} has no rows")
            continue
        own = [c for c in df.columns if c not in seen]
        seen |= set(own)
        used.append(df.select(*keys, *own))
    return reduce(lambda a, b: a.join(b, list(keys)), used)


def join_predictions(predictions: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Predictions with the features that they do not have themselves."""
    return predictions.join(features.select(*keys, *[c for c in features.columns if c not in predictions.columns]), list(keys))


def key_coverage(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys of both inputs, those in both, and their share of the first's. One aggregate over a union."""
    u = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    per = u.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    out = per.agg(F.sum("_a").alias("keys_a"), F.sum("_b").alias("keys_b"), F.sum(F.col("_a") * F.col("_b")).alias("keys_both"))
    return out.withColumn("coverage", F.when(F.col("keys_a") > 0, F.col("keys_both") / F.col("keys_a")).otherwise(0.0))


def fit_scaling(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """metric, median, iqr, mad of every feature, exactly, in long form.

    Quantiles and the MAD are selected within brackets (see ``selection``), so no task holds a feature.
    """
    long = long_metrics(df.select(*features), features)
    middle = selection.quantiles(long, ["metric"], [0.25, 0.5, 0.75]).select("metric", F.get("q", F.lit(1)).alias("median"), (F.get("q", F.lit(2)) - F.get("q", F.lit(0))).alias("iqr"))
    middle = written(middle, "scaling")
    return middle.join(selection.median_deviation(long, ["metric"], middle), "metric")


def apply_scaling(df: DataFrame, scaling: DataFrame, features: Sequence[str], z_max: float = 6.0, impute: str = "none", constant: float = 0.0, eps: float = 1e-6) -> DataFrame:
    """Robust z of every feature, clipped, with NaN as null and imputation none, constant or median_scaled (0), in one select."""
    wide = scaling.groupBy().agg(*[F.max(F.when(F.col("metric") == f, F.col(s))).alias(f"__{s}_{f}") for f in features for s in ("median", "iqr", "mad")])

    def z(f: str) -> Column:
        x = F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double"))
        scale = F.when(F.col(f"__mad_{f}") > 0, F.col(f"__mad_{f}")).when(F.col(f"__iqr_{f}") > 0, F.col(f"__iqr_{f}")).otherwise(F.lit(1.0))
        out = F.greatest(F.least((x - F.col(f"__median_{f}")) / (scale + eps), F.lit(z_max)), F.lit(-z_max))
        out = F.when(x.isNotNull() & F.col(f"__median_{f}").isNotNull(), out)
        return out if impute == "none" else F.coalesce(out, F.lit(constant if impute == "constant" else 0.0))

    return df.crossJoin(F.broadcast(wide)).select(*[z(c).alias(c) if c in features else F.col(c) for c in df.columns])


def time_split(df: DataFrame, end: str, days: int = 30, ts: str = "window_end_ts") -> tuple[DataFrame, DataFrame]:
    """(train, validation): the last days before the end validate."""
    cut = F.timestamp_add("DAY", F.lit(-days), F.lit(end).cast("timestamp"))
    return df.where(F.col(ts) < cut), df.where(F.col(ts) >= cut)


def varying_features(df: DataFrame, features: Sequence[str], least: float = 1e-9) -> DataFrame:
    """metric, variance, keep: population variances of all features in one aggregate."""
    one = df.agg(*[F.var_pop(f).alias(f) for f in features])
    return long_metrics(one, features).select("metric", F.col("value").alias("variance"), (F.col("value") > least).cast("int").alias("keep"))


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(a, b, r) for all pairs of features in order, over the rows that have both; null where one doesn't vary."""
    names = F.array(*map(F.lit, features))
    pairs = gram.correlations(df, features)
    return pairs.select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), "r")


def prune_correlated(df: DataFrame, features: Sequence[str], most: float = 0.95) -> list[str]:
    """Keeps a feature if no kept one before it has a greater |r|; the driver gets the pairs beyond that only."""
    close = {(x["i"], x["j"]) for x in gram.correlations(df, features).where(F.abs("r") > most).select("i", "j").collect()}
    kept: list[int] = []
    for j in range(len(features)):
        if not any((i, j) in close for i in kept):
            kept.append(j)
    return [features[j] for j in kept]


def stable_features(df: DataFrame, features: Sequence[str], score: str, key: str, runs: int = 10, share: float = 0.6, top: float = 0.5) -> DataFrame:
    """(metric, picked, keep): features whose |r| with the score is in the top half of enough bootstrap runs.

    A run weighs each row by a Poisson draw from the MD5 of its key and the run, so runs repeat and the rows are read once.
    """
    def weight(run: int) -> Column:
        u = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key), F.lit(run))), 1, 8), 16, 10).cast("double") / float(1 << 32)
        return sum((F.when(u >= c, 1.0).otherwise(0.0) for c in (0.367879, 0.735759, 0.919699, 0.981012)), F.lit(0.0))

    drawn = df.select(score, *features, F.array(*[weight(run) for run in range(runs)]).alias("_w"))
    long = long_metrics(drawn, features).where("value is not null")
    per = []
    for run in range(runs):
        w, x, y = F.get("_w", F.lit(run)), F.col("value"), F.col(score)
        per.append(F.struct(F.lit(run).alias("run"), F.sum(w).alias("n"), F.sum(w * x).alias("x"), F.sum(w * y).alias("y"), F.sum(w * x * x).alias("xx"), F.sum(w * y * y).alias("yy"), F.sum(w * x * y).alias("xy")))
    sums = long.groupBy("metric").agg(F.array(*per).alias("_s")).select("metric", F.inline("_s"))
    spread = F.sqrt(F.greatest(F.col("xx") - F.col("x") * F.col("x") / F.col("n"), F.lit(0.0)) * F.greatest(F.col("yy") - F.col("y") * F.col("y") / F.col("n"), F.lit(0.0)))
    r = F.when(spread > 0, F.abs((F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / spread)).otherwise(0.0)
    rank = F.row_number().over(Window.partitionBy("run").orderBy(F.desc("_r"), "metric"))
    picked = sums.withColumn("_r", r).withColumn("_k", rank).groupBy("metric").agg((F.count_if(F.col("_k") <= max(1, int(len(features) * top))) / runs).alias("picked"))
    return picked.withColumn("keep", (F.col("picked") >= share).cast("int"))


def top_half(importance: DataFrame, score: str = "importance", name: str = "metric") -> DataFrame:
    """The better half of a feature table (its size is the number of features)."""
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(score), name))
    return importance.withColumn("rank", rank).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))).where(F.col("rank") <= F.floor((F.col("_n") + 1) / 2)).drop("_n")


def score_metrics(train: DataFrame, valid: DataFrame, score: str = "score", level: float = 0.95) -> DataFrame:
    """One row: median shift over spread ("drift"), the training threshold, alert rates and their difference.

    Quantiles are exact selections; spread and rates are one aggregate. A NaN counts as null: it is in the rates'
    denominators only.
    """
    x = F.col(score).cast("double")
    part = lambda df, k: df.select(F.lit(k).alias("part"), F.when(~F.isnan(x), x).alias("value"))
    both = part(train, "train").unionByName(part(valid, "valid"))
    of = lambda k, c: F.max(F.when(F.col("part") == k, c))
    q = selection.quantiles(both, ["part"], [0.5, level])
    marks = written(q.agg(of("train", F.get("q", F.lit(0))).alias("_mt"), of("valid", F.get("q", F.lit(0))).alias("_mv"), of("train", F.get("q", F.lit(1))).alias("threshold")), "marks")
    rate = lambda k: F.avg(F.when(F.col("part") == k, F.when(F.col("value") > F.col("threshold"), 1.0).otherwise(0.0)))
    own = F.stddev_pop(F.when(F.col("part") == "train", F.col("value")))
    sums = both.crossJoin(F.broadcast(marks)).agg(F.max("_mt").alias("_mt"), F.max("_mv").alias("_mv"), F.max("threshold").alias("threshold"), own.alias("_sd"), rate("valid").alias("alert_rate"), rate("train").alias("_train_rate"))
    drift = F.when(F.col("_sd") > 0, F.abs(F.col("_mv") - F.col("_mt")) / F.col("_sd")).otherwise(0.0)
    return sums.select(drift.alias("drift"), "threshold", "alert_rate", (F.col("alert_rate") - F.col("_train_rate")).alias("alert_delta"))


def gates(metrics: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """A verdict for each limit on |metric|, in long form."""
    long = long_metrics(metrics.select(*limits), list(limits))
    limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v)))])
    return long.select("metric", "value", F.element_at(limit, F.col("metric")).alias("most"), (F.abs("value") <= F.element_at(limit, F.col("metric"))).cast("int").alias("passed"))


def input_profile(df: DataFrame, keys: Sequence[str], ts: str, least_rows: int, least_days: int, window: str = "window_label") -> DataFrame:
    """One row: rows, distinct keys, rows per key, windows, days, and verdicts against thresholds."""
    out = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*keys).alias("keys"), F.count_distinct(window).alias("windows"), F.count_distinct(F.to_date(ts)).alias("days"))
    return out.withColumns({
        "rows_per_key": F.when(F.col("keys") > 0, F.col("rows") / F.col("keys")).otherwise(0.0), "enough_rows": (F.col("rows") >= least_rows).cast("int"), "enough_days": (F.col("days") >= least_days).cast("int"),
    })


def window_overlap(a: DataFrame, b: DataFrame, least_rows: int, window: str = "window_label") -> DataFrame:
    """Rows of each window in two inputs, whether both have it, and whether both have enough. One aggregate over a union."""
    u = a.select(window, F.lit(0).alias("_i")).unionByName(b.select(window, F.lit(1).alias("_i")))
    out = u.groupBy(window).agg(F.count_if(F.col("_i") == 0).alias("rows_a"), F.count_if(F.col("_i") == 1).alias("rows_b"))
    fewest = F.least("rows_a", "rows_b")
    return out.withColumns({"overlaps": (fewest > 0).cast("int"), "enough": (fewest >= least_rows).cast("int")})


def scored_in_windows(windows: DataFrame, predictions: DataFrame, ts: str = "window_end_ts") -> DataFrame:
    """Predictions in each evaluation window [start, end); windows without any count 0.

    Predictions are counted by time first. A window meets only the days that it spans, so neither side needs a broadcast.
    """
    by_time = predictions.groupBy(ts).agg(F.count(F.lit(1)).alias("_n")).withColumn("_day", F.to_date(ts))
    days = windows.where("start_ts < end_ts").withColumn("_day", F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts"))))
    hit = (F.col(ts) >= F.col("start_ts")) & (F.col(ts) < F.col("end_ts"))
    found = by_time.join(days, "_day").where(hit).groupBy("window_id").agg(F.sum("_n").alias("records"))
    return windows.join(found, "window_id", "left").select("window_id", F.coalesce("records", F.lit(0)).alias("records"))
