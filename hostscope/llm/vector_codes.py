"""Product codes of vectors: nearest codebook entries by slicing sorted coordinates and intersecting bit masks."""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.llm.arrays import bounded_batches, tidy
from hostscope.llm.common import with_small, written

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components are held to this range on either side, so that squared distances fit 64 bits.
LARGEST = 1 << 26

_SLICE_ROWS = 1 << 14


class SlicedEntries:
    """The entries of one part, with each dimension's coordinates sorted and a mask of entries before every place.

    The entries within a range of a dimension are the difference of two prefix masks; ANDed over all dimensions they are
    exactly the entries in a box around a point. A box of half-width r holds every entry at distance r or less.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        k, width = entries.shape
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, order, axis=0)
        self.before = np.zeros((k + 1, width), np.uint64)
        for j in range(k):
            self.before[j + 1] = self.before[j] | np.uint64(1) << order[j].astype(np.uint64)
        apart = ((self.entries[:, None] - self.entries[None]) ** 2).sum(2)
        near = np.where(np.eye(k, dtype=bool), np.iinfo(np.int64).max, apart).min(1)
        #: The radius to begin with: the usual distance of an entry to the next one.
        self.radius = max(1, int(np.sqrt(np.median(near.astype(float))))) if k > 1 else 1

    def in_box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A mask of the entries in the box around each point."""
        found = np.full(len(points), self.before[-1, 0] if self.entries.shape[1] else (1 << len(self.entries)) - 1, np.uint64)
        for d in range(self.entries.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + radius, "right")
            found &= self.before[high, d] & ~self.before[low, d]
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point (ties to the lower index) and its squared distance.

        A point's box grows until it holds an entry; the best one is final if the box reaches as far as that entry, else
        the box is drawn once more at its distance.
        """
        code, best = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        radius, open_ = np.full(len(points), self.radius, np.int64), np.arange(len(points))
        while len(open_):
            boxes = self.in_box(points[open_], radius[open_])
            best[open_] = np.iinfo(np.int64).max
            for e in range(len(self.entries)):
                rows = open_[(boxes >> np.uint64(e) & np.uint64(1)).astype(bool)]
                apart = ((points[rows] - self.entries[e]) ** 2).sum(1)
                less = apart < best[rows]
                best[rows[less]], code[rows[less]] = apart[less], e
            empty = boxes == 0
            far = ~empty & (best[open_] > radius[open_] ** 2)
            reach = np.sqrt(best[open_][far].astype(float)).astype(np.int64) + 2  # at least the distance
            radius[open_[empty]] *= 2
            radius[open_[far]] = reach
            open_ = open_[empty | far]
        return code, best


def _cuts(width: int, parts: int) -> list[tuple[int, int]]:
    return [(p * width // parts, (p + 1) * width // parts) for p in range(parts)]


def _integers(scale: int):
    """Vectors (vec_id, label, vec) whose components are all finite, as packed 32-bit integers floor(scale * x)."""

    def run(batches):
        for batch in batches:
            vec = batch.column("vec")
            at = np.asarray(vec.offsets)
            flat = vec.values.cast(pa.float64()).slice(int(at[0]), int(at[-1] - at[0]))
            x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            at = at - at[0]
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
            keep = (bad[at[1:]] == bad[at[:-1]]) & vec.is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.clip(np.nan_to_num(np.floor(scale * x)), -LARGEST, LARGEST).astype("<i4")
            rows = np.flatnonzero(keep)
            packed = pa.array([whole[at[k] : at[k + 1]].tobytes() for k in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows)) for c in ("vec_id", "label")), packed], ["vec_id", "label", "vec"])

    return run


def _points(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch whose vectors have the width, and these as a matrix."""
    raw = column.to_pylist()
    rows = np.array([k for k, v in enumerate(raw) if len(v) == 4 * width], np.int64)
    return rows, np.frombuffer(b"".join(raw[k] for k in rows), "<i4").reshape(len(rows), width).astype(np.int64)


def _sums(books: list[np.ndarray], width: int):
    """Sums of the components, and counts, of the parts that each entry is nearest to; one table a task."""

    def run(batches):
        cuts = _cuts(width, len(books))
        index = [SlicedEntries(b) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for k in range(0, len(batch), _SLICE_ROWS):
                _, points = _points(batch.column("vec").slice(k, _SLICE_ROWS), width)
                for p, (a, b) in enumerate(cuts):
                    code, _ = index[p].nearest(points[:, a:b])
                    np.add.at(total[p], code, points[:, a:b])
                    count[p] += np.bincount(code, minlength=len(count[p]))
        rows = [(p, e, d, int(total[p][e, d]), int(count[p][e])) for p in range(len(books)) for e in np.flatnonzero(count[p]).tolist() for d in range(total[p].shape[1])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["part", "entry", "place", "total", "many"])

    return run


def _codes(books: list[np.ndarray], width: int):
    """Each vector's code and error."""

    def run(batches):
        cuts = _cuts(width, len(books))
        index = [SlicedEntries(b) for b in books]
        for batch in batches:
            for k in range(0, len(batch), _SLICE_ROWS):
                part = batch.slice(k, _SLICE_ROWS)
                rows, points = _points(part.column("vec"), width)
                found = [index[p].nearest(points[:, a:b]) for p, (a, b) in enumerate(cuts)]
                code, error = [None] * len(part), [None] * len(part)
                digits = np.stack([c for c, _ in found], 1).astype(np.uint8)
                for at, d, e in zip(rows.tolist(), digits, sum(e for _, e in found).tolist(), strict=True):
                    code[at], error[at] = d.tobytes().hex(), e
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def train(kept: DataFrame, width: int, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """One codebook a part, from written vectors (vec_id, vec): the parts of the least ids at first, then as many rounds
    of assigning all vectors and taking floored means as asked for. Each round is one aggregate; the driver holds
    codebooks only."""
    first = kept.where(F.length("vec") == 4 * width).orderBy(F.asc_nulls_last("vec_id"), "vec").select("vec").limit(entries).collect()
    start = np.array([np.frombuffer(r[0], "<i4") for r in first], np.int64).reshape(len(first), width)
    books = [start[:, a:b].copy() for a, b in _cuts(width, parts)]
    for _ in range(rounds):
        sums = kept.select("vec").mapInArrow(tidy(_sums(books, width)), "part long, entry long, place long, total long, many long")
        whole = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("many").alias("many"))
        for r in whole.collect():
            books[r.part][r.entry, r.place] = int(r.total) // r.many
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b.tolist() for x in e).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error, label_error) of every vector, and the codebooks (up to 64 entries each).

    Components are floor(scale * x); a vector is cut into equal consecutive parts (where its width isn't a multiple of
    their number, some have one component more), and each part is coded by its nearest entry, in two hex digits. error
    is the squared distance summed over parts, label_error the errors summed over the rows of a label.

    Vectors that are null or have null or non-finite components go. The width is that of the least id's vector; vectors
    of other widths stay with null code and error. Components beyond 2**26 after scaling count as that bound. Null ids
    come last, rows of one id in the order of their bytes; repeated rows are coded alike; null labels are one group;
    an empty table gives an empty result and empty codebooks; other columns are ignored.
    """
    if not 1 <= entries <= 64:
        raise ValueError("a mask holds 1 to 64 entries")
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    kind = rows.schema["label"].dataType.simpleString()
    kept = written(rows.mapInArrow(tidy(_integers(scale)), f"vec_id long, label {kind}, vec binary"), "codes-vectors")
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vec").select((F.length("vec") / 4).cast("int")).first()
    width = first[0] if first else 0
    books = train(kept, width, entries, parts, rounds) if first else []
    if not first:
        return kept.selectExpr("vec_id", "label", "string(null) code", "bigint(null) error", "bigint(null) label_error"), books
    coded = written(kept.mapInArrow(tidy(_codes(books, width)), f"vec_id long, label {kind}, code string, error long"), "codes")
    most = F.lit(Decimal((1 << 63) - 1))
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    total = coded.groupBy(F.col("label").alias("_label")).agg(F.when(whole > most, most).otherwise(whole).cast("long").alias("label_error"))
    total = written(total, "codes-labels")
    return with_small(coded, total, F.col("label").eqNullSafe(F.col("_label")), "left", 64).drop("_label"), books
