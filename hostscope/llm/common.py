"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostscope.llm.arrays import worker_memo

#: White space that separates words; a word is a run of anything else.
SPACE = " \t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"
GAP_RE = r"[\x20\x09-\x0D]+"

#: A side is broadcast only if its measured size is below this many bytes.
BROADCAST_BYTES = 48 << 20

_own_dir: dict[str, str] = {}

def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a temporary one if all runs in one process (tests), else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = _own_dir.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="spark-"))
    return named.rstrip("/")


def new_dir(spark: SparkSession, what: str) -> str:
    """A fresh subfolder of the shared folder; it is left to the cluster to clear."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_dir(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluates value once and hands it to body, also where body uses it in a nested lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null, empty or blank text."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(F.coalesce(trimmed, F.lit(""))) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP_RE))


def n_words(text: Column) -> Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def with_small(df: DataFrame, other: DataFrame, on, how: str, row_bytes: int, rows: int | None = None) -> DataFrame:
    """Joins other, broadcast if its counted rows fit BROADCAST_BYTES and by an ordinary (skew-split) join beyond."""
    n = other.count() if rows is None else rows
    return df.join(F.broadcast(other) if n * row_bytes <= BROADCAST_BYTES else other, on, how)


def holdout(doc_id: Column) -> Column:
    """True for the fifth of the ids whose labels must not be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def ship(spark: SparkSession, model) -> tuple[str, Broadcast]:
    """Broadcasts a fitted model, its class by value; its size must not depend on the documents."""
    return uuid.uuid4().hex, spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shipped(model: tuple[str, Broadcast]):
    """The model, loaded once in each worker; the one that the worker had before goes."""
    held = worker_memo("model")
    key, sent = model
    if key not in held:
        held.clear()
        held[key] = cloudpickle.loads(sent.value)
    return held[key]
