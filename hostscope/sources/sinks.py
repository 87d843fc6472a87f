"""Sinks: partitioned Parquet with idempotent replacement, contracts, publication of several tables, batch index upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hostscope.sources.scratch import written


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite", dynamic: bool = True, files_per_partition: int | None = None, records_per_file: int = 5_000_000) -> int:
    """Writes Parquet, replacing only the partitions present (dynamic overwrite), and returns the rows written.

    Rows are dealt out by the partition columns and a salt as wide as the largest partition needs, so one large day is
    not one task; files are bounded in rows. Unless files_per_partition says how wide, the rows are written as they come
    first and counted there, so that they are computed once.
    """
    check_columns(df, by)
    if by and files_per_partition is None:
        df = written(df, "unsorted")
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n"))
    if by:
        if files_per_partition is None:
            most = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
            files_per_partition = max(1, -(-most // records_per_file))
        salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by] or [F.lit(0)]), F.lit(files_per_partition))
        out = out.repartition(*by, salt).sortWithinPartitions(*by)
    writer = out.write.mode(mode).option("maxRecordsPerFile", records_per_file).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return seen.get["n"]


def check_columns(df: DataFrame, required: Sequence[str]) -> None:
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"the output lacks {', '.join(missing)}")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that break a publication contract: any key is null."""
    check_columns(df, keys)
    broken = F.lit(False)
    for k in keys:
        broken = broken | F.col(k).isNull()
    return df.where(broken)


def partition_contract(df: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows of each partition and those with a null partition column or key; raises if a column is missing at all."""
    check_columns(df, [*by, *keys])
    broken = F.lit(False)
    for c in [*by, *keys]:
        broken = broken | F.col(c).isNull()
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("broken"))


def layout_columns(ts: Column, run: Column) -> list[Column]:
    """Partition columns of a batch output: dt, hh, run_no (quarter of the hour) and batch_id."""
    return [F.date_format(ts, "yyyy-MM-dd").alias("dt"), F.date_format(ts, "HH").alias("hh"), (F.floor(F.minute(ts) / 15) + 1).cast("int").alias("run_no"), run.alias("batch_id")]


def publish(tables: dict[str, DataFrame], base: str, by: Sequence[str], metadata: DataFrame | None = None) -> dict[str, int]:
    """Several tables of one publication, each under its own name with the same partitions.

    Metadata is written last, so a reader that finds it finds whole tables.
    """
    counts = {name: write_partitioned(df, f"{base}/{name}", by) for name, df in tables.items()}
    return counts if metadata is None else counts | {"metadata": write_partitioned(metadata, f"{base}/metadata")}


def publication_metadata(bounds: DataFrame, mode: str, reference: str) -> DataFrame:
    """Bounds of a publication with its run mode, and a creation time that is the reference time."""
    return bounds.withColumns({"run_mode": F.lit(mode), "created_ts": F.lit(reference).cast("timestamp")})


def run_provenance(spark: SparkSession, batch_id: str, mode: str, reason: str, start: str, end: str, path: str) -> DataFrame:
    """One row on where a batch's input came from; mode and reason must be given."""
    if not mode.strip() or not reason.strip():
        raise ValueError("source_mode and resolution_reason are mandatory")
    return spark.createDataFrame([(batch_id, mode, reason, start, end, path)], "batch_id string, source_mode string, resolution_reason string, start_ts string, end_ts string, input_path string")


def merge_batch_index(old: DataFrame, new: DataFrame, keys: Sequence[str], immutable: Sequence[str], status: str = "status", seq: str = "status_seq") -> DataFrame:
    """Upsert: immutable fields keep their first value, the status with the greater sequence number wins."""
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    later = F.coalesce(F.col(f"n.{seq}"), F.lit(-1)) > F.coalesce(F.col(f"o.{seq}"), F.lit(-1))
    return o.join(n, on, "full").select(
        *[F.coalesce(f"o.{c}", f"n.{c}").alias(c) for c in [*keys, *immutable]],
        F.when(later, F.col(f"n.{status}")).otherwise(F.col(f"o.{status}")).alias(status),
        F.greatest(f"o.{seq}", f"n.{seq}").alias(seq),
    )


def schema_hash(df: DataFrame) -> str:
    import hashlib

    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def snapshot_with_manifest(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Writes a snapshot, checks that all rows arrived and returns its manifest row."""
    spark = df.sparkSession
    n = write_partitioned(df, path, by)
    there = spark.read.parquet(path).join(df.select(*by).distinct(), list(by), "left_semi").count()
    if n != there:
        raise ValueError(f"{n} rows were sent and {there} are there")
    return spark.createDataFrame([(n, there, schema_hash(df))], "source_rows long, written_rows long, schema_hash string")
