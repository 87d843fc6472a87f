"""Scratch folders for queries that write and read back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder under spark.checkpoint.dir, which all executors share.

    Where that is unset: under a temporary folder if all runs in one process, else an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{shared.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """The table, written to a fresh shared folder and read back: computed once, and its lineage ends there."""
    path = scratch_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
