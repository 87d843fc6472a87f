"""A keyed permutation of all rows of a table: places by ranges, a Feistel bijection of places, one join."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.operators.ranges import numbered
from hostscope.sources.scratch import written

ROUNDS = 4
#: A step leaves the table's places with a chance below 1 / sqrt(rows); it is then taken again, so often at most.
WALKS = 16


def sides(n: int) -> tuple[int, int]:
    """A grid a * b of at least n places, of hardly more."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _noise(value: Column, round_: int, seed: int, most: int) -> Column:
    """A value below ``most`` from the MD5 of a half, the round and the seed."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", value, F.lit(round_), F.lit(seed))), 1, 12), 16, 10).cast("long") % most


def feistel(place: Column, n: int, seed: int) -> Column:
    """A keyed bijection of the places 0 to n - 1, as one expression.

    A place is a cell of a grid; rounds shift its row by a hash of its column and its column by a hash of its row, which
    can all be undone. Cells beyond n are mapped on until they are inside.
    """
    a, b = sides(n)

    def once(p: Column) -> Column:
        def rounds(s: Column, r: int) -> Column:
            if r == ROUNDS:
                return s
            x, y = s["x"], s["y"]
            moved = F.struct(((x + _noise(y, r, seed, a)) % a).alias("x"), y.alias("y")) if r % 2 == 0 else F.struct(x.alias("x"), ((y + _noise(x, r, seed, b)) % b).alias("y"))
            return F.element_at(F.transform(F.array(moved), lambda m: rounds(m, r + 1)), 1)

        start = F.struct(F.floor(p / b).alias("x"), (p % b).alias("y"))
        out = F.element_at(F.transform(F.array(start), lambda s: rounds(s, 0)), 1)
        return out["x"] * b + out["y"]

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once(place.cast("long")), lambda p, _: F.when(p < n, p).otherwise(once(p)))


def permuted(df: DataFrame, order: Sequence[str], columns: Sequence[str], seed: int = 0, prefix: str = "_m_") -> DataFrame:
    """Each row with the columns of the row that the permutation puts in its place, under prefixed names.

    Rows are numbered in the order (which has to be total, for the same result each time) by range partitions, and both
    sides of the join are spread evenly, as places are distinct. The whole table is permuted, without buckets.
    """
    rows = written(numbered(df, order, "_place").withColumn("_place", F.col("_place") - 1), "places")
    n = rows.count()
    if not n:
        return df.select("*", *[F.col(c).alias(prefix + c) for c in columns])
    goes = rows.select(feistel(F.col("_place"), n, seed).alias("_place"), *[F.col(c).alias(prefix + c) for c in columns])
    return rows.join(goes, "_place").drop("_place")
