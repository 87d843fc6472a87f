"""Exact deduplication by a stateful stream over content digests, in DataFrame operations only."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.llm.common import new_dir, with_small

#: Disk-backed state, bounded in memory, kept without expiry.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: no space is allocated ahead, and commits write changes only.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
FILES_PER_BATCH = 2000


def _locator(docs: DataFrame) -> Column:
    """Where a row's content lies: file and row number of a Parquet table, else the row's number in this run's digests."""
    place = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")
    try:
        if "_metadata" not in docs.columns:
            docs.select(place).schema  # noqa: B018
            return place
    except AnalysisException:
        pass
    return F.monotonically_increasing_id().cast("string")


def _held(digests: DataFrame, path: str, files_per_batch: int) -> DataFrame:
    """Streams the written digests through keyed state; a row for each digest with what its state holds at the end."""
    spark, out = digests.sparkSession, new_dir(digests.sparkSession, "dedup-state")
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        seen = (
            spark.readStream.schema(digests.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
            .groupBy("text_sha256")
            .agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        )

        def keep(batch: DataFrame, n: int) -> None:  # a replayed batch replaces its own rows
            batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

        seen.writeStream.outputMode("update").option("checkpointLocation", new_dir(spark, "dedup-stream")).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    empty = digests.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size")).withColumn("batch", F.lit(0))
    states = empty if digests.isEmpty() else spark.read.schema(empty.schema).parquet(out)
    if states.select("batch").distinct().count() > 1:
        last = states.groupBy("text_sha256").agg(F.max(F.struct("batch", "group_size", "keep")).alias("_last"))
        states = last.select("text_sha256", "_last.keep", "_last.group_size")
    return states.select("text_sha256", F.col("keep.doc_id").alias("keep_id"), F.col("keep.locator").alias("keep_locator"), "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Groups rows whose texts are equal byte for byte; the row with the largest id stays.

    Returns doc_id, keep_id, group_size, kept, text_sha256, keep_locator for every row. A stream keeps, for each digest
    and without expiry, the largest id, its locator (file and row number) and the count in RocksDB state. Digests met twice are hits:
    the whole texts of the hits are read again and compared through their least and greatest text, which partial
    aggregation merges before the shuffle, so a group with a third of all rows moves one row a task. Should a digest
    hold different texts, its rows are grouped by text instead. Null text counts as empty; null ids lose to any id;
    of rows equal in id and text, the one of the greatest locator is kept; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"), _locator(docs).alias("locator"))
    read = read.withColumn("text_sha256", F.sha2(F.col("_text"), 256))
    path = new_dir(spark, "dedup-digests")
    (narrow := read.select("doc_id", "text_sha256", "locator")).write.parquet(path)
    digests = spark.read.schema(narrow.schema).parquet(path)
    groups = _held(digests, path, files_per_batch)
    hits = groups.where("group_size > 1").select("text_sha256", "keep_id", "group_size", "keep_locator")
    n = hits.count()
    checked = with_small(read.select("text_sha256", "_text"), hits.select("text_sha256"), "text_sha256", "left_semi", 150, n)
    differ = checked.groupBy("text_sha256").agg(F.min("_text").alias("_a"), F.max("_text").alias("_b")).where("_a <> _b").select("text_sha256")
    out = with_small(digests, hits, "text_sha256", "left", 250, n)
    if n and not differ.isEmpty():  # never seen for SHA-256
        few = read.join(differ, "text_sha256", "left_semi")
        own = few.groupBy("text_sha256", "_text").agg(F.max(F.struct("doc_id", "locator")).alias("_k"), F.count(F.lit(1)).alias("group_size"))
        again = few.select("doc_id", "locator", "text_sha256", "_text").join(own, ["text_sha256", "_text"])
        again = again.select("text_sha256", "doc_id", "locator", F.col("_k.doc_id").alias("keep_id"), "group_size", F.col("_k.locator").alias("keep_locator"))
        out = out.join(differ, "text_sha256", "left_anti").unionByName(again)
    single = F.col("group_size").isNull()
    first = F.col("locator").eqNullSafe(F.col("keep_locator"))
    keep_id = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | F.col("doc_id").eqNullSafe(keep_id) & first).alias("kept"), "text_sha256",
        F.when(single, F.col("locator")).otherwise(F.col("keep_locator")).alias("keep_locator"),
    )
