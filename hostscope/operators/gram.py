"""Correlations of all pairs of features from blocks of cross products, in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Features in a block, and lanes of partial sums that are merged before the last step.
BLOCK = 64
LANES = 32

_SENT = "block int, lane int, sums binary"


def _products(k: int, shift: np.ndarray):
    """Sums over a task's rows for every pair of features, as one row a pair of blocks.

    For features i and j: rows that have both, the sums of x_i and x_j, of their squares, and of x_i * x_j over those
    rows, all less a shift, so that large means don't drown small spreads.
    """

    def run(batches):
        n, s, q, c = (np.zeros((k, k)) for _ in range(4))
        seen = False
        for batch in batches:
            if not len(batch):
                continue
            x = np.empty((k, len(batch)))
            for i in range(k):
                x[i] = batch.column(i).to_numpy(zero_copy_only=False)
            has = np.isfinite(x)
            gaps = np.flatnonzero(~has.all(axis=1))
            x -= shift[:, None]
            x[gaps] = np.where(has[gaps], x[gaps], 0.0)
            c += x @ x.T
            # a partner without gaps takes no rows away, so only those with gaps need products
            square, whole = x * x, np.setdiff1d(np.arange(k), gaps)
            n[:, whole] += has.sum(axis=1)[:, None]
            s[:, whole] += x.sum(axis=1)[:, None]
            q[:, whole] += square.sum(axis=1)[:, None]
            if len(gaps):
                m = has[gaps].T.astype(float)
                n[:, gaps] += has.astype(float) @ m
                s[:, gaps] += x @ m
                q[:, gaps] += square @ m
            seen = True
        if not seen:
            return
        blocks, lane = -(-k // BLOCK), TaskContext.get().partitionId() % LANES
        for a in range(blocks):
            for b in range(a, blocks):
                i, j = slice(a * BLOCK, (a + 1) * BLOCK), slice(b * BLOCK, (b + 1) * BLOCK)
                sums = np.stack([n[i, j], s[i, j], s[j, i].T, q[i, j], q[j, i].T, c[i, j]])
                yield pa.RecordBatch.from_arrays([pa.array([a * blocks + b], pa.int32()), pa.array([lane], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["block", "lane", "sums"])

    return run


def _added(batches) -> dict[tuple[int, int], np.ndarray]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for block, lane, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "lane", "sums")), strict=True):
            part = np.frombuffer(raw)
            total[block, lane] = total[block, lane] + part if (block, lane) in total else part
    return total


def _merged(batches):
    for (block, lane), sums in _added(batches).items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([lane], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["block", "lane", "sums"])


def _pairs(k: int):
    """(i, j, n, r) of a block's pairs, i < j; r is null where a feature doesn't vary over the pair's rows."""

    def run(batches):
        blocks = -(-k // BLOCK)
        whole: dict[int, np.ndarray] = {}
        for (block, _), sums in _added(batches).items():
            whole[block] = whole.get(block, 0.0) + sums
        for block, sums in whole.items():
            a, b = divmod(block, blocks)
            rows, cols = min(BLOCK, k - a * BLOCK), min(BLOCK, k - b * BLOCK)
            n, x, y, xx, yy, xy = sums.reshape(6, rows, cols)
            with np.errstate(all="ignore"):
                vx, vy = xx - x * x / n, yy - y * y / n
                r = np.clip((xy - x * y / n) / np.sqrt(vx * vy), -1, 1)
                # what rounding leaves of a constant's spread is no spread
                r = np.where((n > 1) & (vx > 1e-12 * xx) & (vy > 1e-12 * yy) & np.isfinite(r), r, np.nan)
            i, j = np.meshgrid(np.arange(rows) + a * BLOCK, np.arange(cols) + b * BLOCK, indexing="ij")
            up = i < j
            yield pa.RecordBatch.from_arrays([pa.array(i[up], pa.int32()), pa.array(j[up], pa.int32()), pa.array(n[up].astype(np.int64)), pa.array(r[up], mask=np.isnan(r[up]))], ["i", "j", "n", "r"])

    return run


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(i, j, n, r) for all pairs of features by their places, i < j, over the n rows that have both.

    Each task multiplies its Arrow batches into one matrix of sums and sends it in blocks; blocks are merged lane by
    lane, then whole, so that neither a task nor the plan grows with pairs times rows. Nulls, NaNs and infinities are
    missing.
    """
    rows = df.select(*[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)])
    first = rows.first()
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in first], float) if first else np.zeros(len(features))
    sent = rows.mapInArrow(_products(len(features), shift), _SENT)
    lanes = sent.repartition("block", "lane").mapInArrow(_merged, _SENT)
    return lanes.repartition("block").mapInArrow(_pairs(len(features)), "i int, j int, n long, r double")
