"""Time ranges, completeness and planning tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hostscope.functions.net import window_floor
from hostscope.sources.scratch import written


def merge_ranges(ranges: DataFrame, by: Sequence[str] = ("family",), start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """Touching and overlapping ranges of a family as one; empty and reversed ranges go.

    Distinct ranges are merged inside each family and day of start first, so a large family is spread over its days;
    only what is left of each day is merged over the family.
    """
    ok = ranges.where(F.col(start) < F.col(end)).select(*by, start, end).distinct()
    inside = _islands(ok.withColumn("_day", F.to_date(start)), [*by, "_day"], start, end).drop("_day")
    return _islands(inside, by, start, end)


def _islands(ok: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Gaps and islands: a range that begins after the greatest end so far begins an island."""
    order = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = ok.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0))
    islands = islands.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return islands.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def invalid_ranges(ranges: DataFrame, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    return ranges.where(F.coalesce(F.col(start) >= F.col(end), F.lit(True)))


def expected_slices(spark: SparkSession, start: str, end: str, minutes: int = 15) -> DataFrame:
    """The slice starts in [start, end)."""
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return spark.range(1).select(F.explode(F.sequence(a, F.timestamp_add("SECOND", F.lit(-1), b), F.expr(f"INTERVAL {minutes} MINUTES"))).alias("start_ts")).select("start_ts", F.timestamp_add("MINUTE", F.lit(minutes), F.col("start_ts")).alias("end_ts"))


def missing_slices(observed: DataFrame, start: str, end: str, minutes: int = 15, ts: str = "event_start") -> DataFrame:
    """Expected slices without an observation."""
    step = minutes * 60
    seen = observed.select(F.timestamp_seconds(F.floor(F.unix_seconds(ts) / step) * step).alias("start_ts")).distinct()
    return expected_slices(observed.sparkSession, start, end, minutes).join(seen, "start_ts", "left_anti")


def missing_days(observed: DataFrame, start: str, end: str, ts: str = "event_start") -> DataFrame:
    """Days in [start, end) without an observation."""
    spark = observed.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))).alias("day"))
    return days.join(observed.select(F.to_date(ts).alias("day")).distinct(), "day", "left_anti")


def lookup_range(index: DataFrame, start: str, end: str, branch: str | None = None, ts: str = "etl_ts") -> DataFrame:
    """Batches in [start, end) that serve a branch (or all, where a batch names none), in order."""
    out = index.where((F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp")))
    if branch is not None and "branches" in index.columns:
        out = out.where(F.col("branches").isNull() | F.array_contains("branches", branch))
    return out.orderBy(ts, "batch_id")


def lookup_batch(index: DataFrame, batch_id: str) -> DataFrame:
    return index.where(F.col("batch_id") == batch_id)


def lookup_day(index: DataFrame, day: str, ts: str = "etl_ts") -> DataFrame:
    return index.where(F.to_date(ts) == F.lit(day).cast("date")).orderBy(ts, "batch_id")


def backfill_units(index: DataFrame, minutes: Sequence[int] = (8, 23, 38, 53), ts: str = "etl_ts") -> DataFrame:
    """Window bounds of every batch: its time floored to a minute of the set, up to its time."""
    return index.select("batch_id", window_floor(F.col(ts), F.array(*map(F.lit, minutes))).alias("start_ts"), F.col(ts).alias("end_ts"))


def reference_days(units: DataFrame, end: str = "end_ts") -> DataFrame:
    """One [00:00:00, 23:59:59] range for each distinct day of the ends."""
    day = F.date_trunc("day", F.col(end))
    return units.select(day.alias("start_ts")).distinct().select("start_ts", F.timestamp_add("SECOND", F.lit(86399), F.col("start_ts")).alias("end_ts"))


def latest(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each group by the order columns; partial aggregation keeps one row a group and task."""
    rest = [c for c in df.columns if c not in by and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_m")
    return df.groupBy(*by).agg(best).select(*by, *[F.col(f"_m.{c}").alias(c) for c in [*order, *rest]])


def chunk_ranges(ranges: DataFrame, size: int, by: Sequence[str] = ("family",)) -> DataFrame:
    """Ranges of a family in order, in chunks of ``size``, each with its bounds and a digest (first 16 hex of SHA-1)."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("start_ts", "end_ts"))
    parts = ranges.withColumn("chunk", F.floor((nth - 1) / size).cast("int"))
    line = F.concat_ws("/", F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format("end_ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return parts.groupBy(*by, "chunk").agg(
        F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.count(F.lit(1)).alias("ranges"),
        F.substring(F.sha1(F.concat_ws("|", F.sort_array(F.collect_list(line))).cast("binary")), 1, 16).alias("digest"),
    )


def difference(prior: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of newly missing and resolved entries between two manifests, and whether anything changed."""
    a, b = (x.select(*keys).distinct() for x in (prior, current))
    both = a.withColumn("_p", F.lit(1)).join(b.withColumn("_c", F.lit(1)), list(keys), "full")
    return both.agg(F.count_if(F.col("_p").isNull()).alias("newly_missing"), F.count_if(F.col("_c").isNull()).alias("resolved")).withColumn("changed", (F.col("newly_missing") + F.col("resolved") > 0).cast("int"))


def family_plan(merged: DataFrame, dependencies: Mapping[str, Sequence[str]], requested: Sequence[str]) -> DataFrame:
    """For each family: its ranges, whether to rebuild it, and why: requested, a dependency of one requested, or not.

    dependencies: what each family needs; what is needed may need others in turn. Cycles do no harm.
    """
    needed, todo = set(), list(requested)
    while todo:
        new = [n for n in dependencies.get(todo.pop(), ()) if n not in needed]
        needed.update(new)
        todo.extend(new)
    family = F.col("family")
    reason = F.when(family.isin(*requested), "requested").when(family.isin(*needed), "dependency").otherwise("not_requested")
    counts = merged.groupBy("family").agg(F.count(F.lit(1)).alias("ranges"))
    return counts.withColumn("reason", reason).withColumn("execute", (F.col("reason") != "not_requested").cast("int"))


def latest_version(parameters: DataFrame, job: str, preferred: str | None = None) -> DataFrame:
    """(project_name, version): the preferred version where a project has it, else its last by (updated_at, name).

    parameters: (project_name, job_name_version "job#version", updated_at).
    """
    own = parameters.where(F.col("job_name_version").startswith(f"{job}#"))
    version = F.substring_index("job_name_version", "#", -1)
    first = (version == preferred if preferred else F.lit(False)).alias("_first")
    last = own.groupBy("project_name").agg(F.max(F.struct(first, "updated_at", "job_name_version")).alias("_m"))
    return last.select("project_name", F.substring_index("_m.job_name_version", "#", -1).alias("version"))


def numbered(df: DataFrame, order: Sequence[str], name: str = "place") -> DataFrame:
    """Rows with their place from 1 in an order: ranges of the order are written sorted, then counted and numbered apart."""
    parts = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    return parts.join(F.broadcast(sizes), "_part").withColumn(name, place).drop("_part", "_before")


def readiness(missing: DataFrame, families: Sequence[str]) -> DataFrame:
    """READY or MISSING_DEPENDENCIES for every required family, with the number of missing ranges."""
    want = missing.sparkSession.createDataFrame([(f,) for f in families], "family string")
    counts = missing.groupBy("family").agg(F.count(F.lit(1)).alias("_n"))
    return want.join(counts, "family", "left").select("family", F.coalesce("_n", F.lit(0)).alias("missing_ranges"), F.when(F.coalesce("_n", F.lit(0)) == 0, "READY").otherwise("MISSING_DEPENDENCIES").alias("verdict"))


def grouped_entries(entries: DataFrame, page: int = 10_000) -> DataFrame:
    """Missing entries by family: sorted distinct batch ids in pages of at most ``page``, joined by commas; the family's
    reasons, and its number of ranges.

    Ids are numbered in ranges of their order, so a family of any size is neither gathered nor sorted in one task; the
    reasons are a closed list. A family without batch ids has one page without any.
    """
    per = entries.groupBy("family").agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons"))
    spans = entries.where("start_ts is not null and end_ts is not null").select("family", "start_ts", "end_ts").distinct().groupBy("family").agg(F.count(F.lit(1)).alias("ranges"))
    ids = written(numbered(entries.where("batch_id is not null").select("family", "batch_id").distinct(), ["family", "batch_id"], "_place"), "entries")
    first = ids.groupBy("family").agg(F.min("_place").alias("_first"))
    pages = ids.join(first, "family").groupBy("family", F.floor((F.col("_place") - F.col("_first")) / page).cast("int").alias("page"))
    lines = pages.agg(F.array_join(F.sort_array(F.collect_list("batch_id")), ",").alias("batch_ids"))
    out = per.join(spans, "family", "left").join(lines, "family", "left")
    return out.select("family", F.coalesce("page", F.lit(0)).alias("page"), F.coalesce("batch_ids", F.lit("")).alias("batch_ids"), "reasons", F.coalesce("ranges", F.lit(0)).alias("ranges"))


def missing_manifest(slices: DataFrame, days: DataFrame, slice_families: Sequence[str], day_families: Sequence[str]) -> DataFrame:
    """(family, start_ts, end_ts, source): 15-minute and daily gaps fanned out to the families to rebuild, merged."""
    fan = lambda df, fs: df.select(F.explode(F.array(*map(F.lit, fs))).alias("family"), "start_ts", "end_ts", "source")
    a = fan(slices.select("start_ts", "end_ts", F.lit("slices").alias("source")), slice_families)
    day = days.select(F.col("day").cast("timestamp").alias("start_ts"), F.timestamp_add("DAY", F.lit(1), F.col("day").cast("timestamp")).alias("end_ts"), F.lit("days").alias("source"))
    return merge_ranges(a.unionByName(fan(day, day_families)), ("family", "source"))


def completion(requested: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: requested entries, those not done, and whether all are."""
    left = requested.join(done.select(*keys).distinct().withColumn("_done", F.lit(1)), list(keys), "left")
    return left.agg(F.count(F.lit(1)).alias("requested"), F.count_if(F.col("_done").isNull()).alias("unverified")).withColumn("complete", (F.col("unverified") == 0).cast("int"))


def training_window(executed: Column, lookback_months: int, gap_months: int) -> list[Column]:
    """[T - lookback, T - gap) in months, clamped to month ends."""
    at = lambda n: F.add_months(F.to_date(executed), -n).cast("timestamp")
    return [at(lookback_months).alias("train_start_ts"), at(gap_months).alias("train_end_ts")]


def history_envelope(windows: DataFrame, lookback_hours: int = 24, horizon_days: int = 44) -> DataFrame:
    """The history that training and evaluation windows need: their union, less the look-back and the longest horizon."""
    out = windows.agg(F.min("start_ts").alias("_a"), F.max("end_ts").alias("required_end_ts"))
    start = F.timestamp_add("HOUR", F.lit(-lookback_hours), F.col("_a"))
    return out.select(start.alias("required_start_ts"), "required_end_ts", F.timestamp_add("DAY", F.lit(-horizon_days), start).alias("baseline_start_ts"))


def overlapping_windows(windows: DataFrame) -> DataFrame:
    """Windows that are reversed or begin before the one before ends.

    The window before is sought inside the family and day; the first of a day follows the last of the days before, of
    which a family has few.
    """
    day = windows.withColumn("_day", F.to_date("start_ts"))
    last = day.groupBy("family", "_day").agg(F.max(F.struct("start_ts", "end_ts")).alias("_last"))
    last = last.select("family", "_day", F.lag("_last.end_ts").over(Window.partitionBy("family").orderBy("_day")).alias("_before"))
    before = F.lag("end_ts").over(Window.partitionBy("family", "_day").orderBy("start_ts", "end_ts"))
    out = day.withColumn("_prev", before).alias("w").join(last.alias("l"), F.col("w.family").eqNullSafe(F.col("l.family")) & F.col("w._day").eqNullSafe(F.col("l._day")))
    out = out.select("w.*", F.coalesce("_prev", "_before").alias("previous_end_ts")).drop("_day", "_prev")
    return out.where("start_ts >= end_ts or start_ts < previous_end_ts")
