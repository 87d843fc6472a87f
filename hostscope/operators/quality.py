"""Field mapping, quality rules and schema contracts on raw sessions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hostscope.functions.net import is_ipv4


def map_fields(df: DataFrame, mapping: Mapping[str, str], required: Sequence[str]) -> DataFrame:
    """Renames source to canonical columns in one projection; errors on missing sources, collisions and missing fields."""
    if missing := [s for s in mapping if s not in df.columns]:
        raise ValueError(f"the input lacks the mapped columns {', '.join(missing)}")
    names = [mapping.get(c, c) for c in df.columns]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"the mapping gives {', '.join(twice)} twice")
    if lacking := [r for r in required if r not in names]:
        raise ValueError(f"after mapping, {', '.join(lacking)} are missing")
    return df.withColumnsRenamed(dict(mapping))


def drop_empty(df: DataFrame, columns: Sequence[str] = ("source_bytes", "destination_bytes", "source_port", "destination_port")) -> DataFrame:
    """Drops rows in which all of these are null."""
    return df.where(F.coalesce(*[F.col(c).cast("double") for c in columns]).isNotNull())


def with_duration(df: DataFrame, start: str = "event_start", end: str = "event_end") -> DataFrame:
    """duration_sec: end - start in seconds; 0 if either is null or the end comes first."""
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000
    return df.withColumn("duration_sec", F.greatest(F.coalesce(seconds, F.lit(0.0)), F.lit(0.0)))


def null_negative(df: DataFrame, columns: Sequence[str] = ("source_bytes", "destination_bytes")) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in columns})


def in_slice(df: DataFrame, start: str, end: str, ts: str = "event_start") -> DataFrame:
    """Rows whose time is in [start, end)."""
    return df.where((F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp")))


def clean(df: DataFrame) -> DataFrame:
    """All quality rules."""
    return null_negative(with_duration(drop_empty(df)))


def drop_malformed_ips(df: DataFrame, columns: Sequence[str] = ("source_ip", "destination_ip")) -> DataFrame:
    ok = F.lit(True)
    for c in columns:
        ok = ok & is_ipv4(F.col(c))
    return df.where(ok)


def quality_metrics(df: DataFrame) -> DataFrame:
    """One row of counts: rows, and rows that each rule touches."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce("source_bytes", "destination_bytes", F.col("source_port").cast("double"), F.col("destination_port").cast("double")).isNull()).alias("empty"),
        F.count_if(F.col("source_bytes") < 0).alias("negative_source_bytes"),
        F.count_if(F.col("destination_bytes").isNull()).alias("null_destination_bytes"),
        F.count_if(~is_ipv4(F.col("source_ip")) | ~is_ipv4(F.col("destination_ip"))).alias("malformed_ip"),
    )


def enforce_schema(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Contract columns in contract types (a value that does not cast becomes null), then defaults; other columns stay."""
    if missing := [f.name for f in schema if f.name not in df.columns]:
        raise ValueError(f"the input lacks {', '.join(missing)}")
    defaults = defaults or {}
    own = {}
    for f in schema:
        c = F.col(f.name).try_cast(f.dataType)
        own[f.name] = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType)) if f.name in defaults else c
    return df.select(*[own.get(c, F.col(c)).alias(c) for c in df.columns])


def rejected_casts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: how many values of each contract column do not cast."""
    return df.agg(*[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in schema])


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables united by column name; a column that one lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def rename_legacy(df: DataFrame, shims: Mapping[str, str]) -> DataFrame:
    """Renames old columns whose new name is not there yet."""
    return df.withColumnsRenamed({a: b for a, b in shims.items() if a in df.columns and b not in df.columns})


def invalid_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """The distinct values outside an enumeration, with their rows."""
    return df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which a required value is null or blank, with the first such column as ``violation``."""
    bad = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c)) for c in columns]
    return df.withColumn("violation", F.coalesce(*bad)).where("violation is not null")


def split_columns(df: DataFrame, metadata: Sequence[str]) -> tuple[list[str], list[str]]:
    """(metadata, features): features are the numeric columns that are not metadata."""
    kinds = (T.NumericType,)
    features = [f.name for f in df.schema if f.name not in metadata and isinstance(f.dataType, kinds)]
    return [c for c in df.columns if c not in features], features
