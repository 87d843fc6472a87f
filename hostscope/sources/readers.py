"""Scans: explicit schemas, version and time scopes with partition pruning, ordered fallbacks, extraction by ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonlines(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """JSON Lines (gzip by suffix) under a fixed schema. A gzip file is one task, so rows are dealt out right after."""
    df = spark.read.schema(schema).json(path)
    df = df.select(*columns) if columns else df
    return df.repartition(partitions) if partitions else df


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of differing columns under their merged schema."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def scope_to_batch(df: DataFrame, version: str | None = None, batch_id: str | None = None, strict: bool = True) -> DataFrame:
    """Rows of one feature version and mini-batch; a missing column is an error when strict, else no filter."""
    for column, value in (("feature_spec_version", version), ("mini_batch_id", batch_id)):
        if value is None:
            continue
        if column in df.columns:
            df = df.where(F.col(column) == value)
        elif strict:
            raise ValueError(f"the input has no column {column}, so it can't be scoped to {value}")
    return df


def scope_to_range(df: DataFrame, start: str | Column, end: str | Column, ts: str = "slice_end_ts", day: str = "dt") -> DataFrame:
    """Rows in [start, end), with bounds on the day partition derived from it where there is one, so that pruning applies."""
    a, b = (F.lit(x).cast("timestamp") if isinstance(x, str) else x for x in (start, end))
    out = df.where((F.col(ts) >= a) & (F.col(ts) < b))
    if day in df.columns:
        if isinstance(start, str) and isinstance(end, str):
            out = out.where((F.col(day) >= start[:10]) & (F.col(day) <= end[:10]))
        else:
            out = out.where((F.col(day) >= F.date_format(a, "yyyy-MM-dd")) & (F.col(day) <= F.date_format(b, "yyyy-MM-dd")))
    return out


def read_first_available(spark: SparkSession, paths: Sequence[tuple[str, str]], schema: T.StructType | None = None) -> DataFrame:
    """The first (mode, path) that exists and has rows, stamped with source_mode and resolution_reason; an error if none."""
    reasons = []
    for mode, path in paths:
        try:
            df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
            if not df.isEmpty():
                reason = "; ".join([*reasons, f"{mode}: used"])
                return df.withColumns({"source_mode": F.lit(mode), "resolution_reason": F.lit(reason)})
            reasons.append(f"{mode}: empty")
        except AnalysisException:
            reasons.append(f"{mode}: missing")
    raise LookupError("no input source has rows: " + "; ".join(reasons))


def render_range_query(template: str, start: str, end: str) -> str:
    return template.replace("{{start_ts}}", start).replace("{{end_ts}}", end)


def read_ranges_jdbc(spark: SparkSession, url: str, table: str, ts: str, ranges: Sequence[tuple[str, str]], properties: dict[str, str]) -> DataFrame:
    """One extract a sorted half-open range from a warehouse, each a partition of the scan."""
    stamp = lambda x: f"{{ts '{x if len(x) > 10 else x + ' 00:00:00'}'}}"  # noqa: E731  as every JDBC driver reads it
    wheres = [f"{ts} >= {stamp(a)} AND {ts} < {stamp(b)}" for a, b in sorted(ranges)]
    return spark.read.jdbc(url, table, predicates=wheres, properties=properties)


def scan_ranges(df: DataFrame, ranges: Sequence[tuple[str, str]], ts: str = "slice_end_ts", day: str = "dt") -> DataFrame:
    """Rows of half-open ranges with range_start and range_end, from one scan; a row of overlapping ranges is there once for each.

    The filter that reaches the scan is a choice of time bounds over merged ranges, and of days where the table is
    partitioned by day, so that files outside of all ranges are not opened.
    """
    merged: list[list[str]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kind = df.schema[ts].dataType.simpleString()
    at = lambda x: F.lit(x).cast(kind)
    held = F.lit(False)
    for a, b in merged:
        one = (F.col(ts) >= at(a)) & (F.col(ts) < at(b))
        held = held | (one & (F.col(day) >= a[:10]) & (F.col(day) <= b[:10]) if day in df.columns else one)
    named = F.array(*[F.struct(F.lit(a).alias("range_start"), F.lit(b).alias("range_end")) for a, b in sorted(ranges)])
    hit = F.filter(named, lambda r: (F.col(ts) >= r["range_start"].cast(kind)) & (F.col(ts) < r["range_end"].cast(kind)))
    return df.where(held).select("*", F.inline(hit))


def extract_ranges(spark: SparkSession, template: str, ranges: Sequence[tuple[str, str]]) -> DataFrame:
    """The same through SQL over registered tables: one rendered query a sorted range, with the range in the rows."""
    parts = [
        spark.sql(render_range_query(template, a, b)).withColumns({"range_start": F.lit(a), "range_end": F.lit(b)}) for a, b in sorted(ranges)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def port_sets(spark: SparkSession, sets: dict[str, list[int]] | None = None, path: str | None = None) -> DataFrame:
    """(set_name, port) from a dict or a JSON file of one object: name -> list of ports."""
    if path:
        raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<int>>")).alias("set_name", "ports"))
        return raw.select("set_name", F.explode("ports").alias("port"))
    rows = [(name, port) for name, ports in (sets or {}).items() for port in ports]
    return spark.createDataFrame(rows, "set_name string, port int")


def batch_path_columns(path: Column) -> list[Column]:
    """project, org1, org2, batch day and batch id from .../project/org1/org2/YYYY/MM/dd/batch/file; nulls where it does not fit."""
    shape = r"([^/]+)/([^/]+)/([^/]+)/(\d{4})/(\d{2})/(\d{2})/([^/]+)/[^/]+$"
    part = lambda i: F.nullif(F.regexp_extract(path, shape, i), F.lit(""))
    return [part(1).alias("project"), part(2).alias("org1"), part(3).alias("org2"), F.concat_ws("-", part(4), part(5), part(6)).alias("batch_day"), part(7).alias("batch_id")]


def inventory_snapshot(machines: DataFrame, month: str, contract_version: str = "v1") -> DataFrame:
    """A monthly machine inventory: rows with an address, one each (address, name), stamped."""
    return machines.where(F.col("ip_address").isNotNull()).dropDuplicates(["ip_address", "machine_name"]).withColumns(
        {"snapshot_month": F.lit(month), "contract_version": F.lit(contract_version)}
    )
