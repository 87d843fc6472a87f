"""Tables in hash buckets of their join keys: what is joined and grouped by these keys later is not shuffled again."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.sources.scratch import scratch_dir


def bucketed(df: DataFrame, keys: Sequence[str], what: str, buckets: int | None = None) -> DataFrame:
    """The table written in buckets of its keys (one file each, sorted by them) and read back as such.

    Rows are shuffled once, here. Buckets default to the session's shuffle partitions, so that tables of one session
    meet. A key with most of the rows makes one large bucket: use keys that spread.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{what}_{uuid.uuid4().hex}".replace("-", "_")
    dealt = df.repartition(n, *[F.col(k) for k in keys])
    dealt.write.bucketBy(n, *keys).sortBy(*keys).option("path", scratch_dir(spark, what)).saveAsTable(name)
    return spark.table(name)


def meet(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join of two tables of equal buckets, bucket by bucket."""
    return left.join(right.hint("merge"), list(keys), how)
