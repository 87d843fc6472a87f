"""Words and word hashes of Arrow text batches, in numpy."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.int64)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240131)
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = _rng.integers(1 << 62, 1 << 63, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)

#: Bytes of an Arrow batch sent to Python, and of a slice worked on at once (one longer text is a slice of its own).
BATCH_BYTES = 8 << 20
SLICE_BYTES = 1 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session by bytes as well as rows, for tables with very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def worker_memo(name: str) -> dict:
    """A dict that outlives a task in its Python worker; its users bound it."""
    return vars(sys.modules.setdefault("_hostscope_memo", types.ModuleType("_hostscope_memo"))).setdefault(name, {})


def tidy(run):
    """A mapInArrow function that gives its freed memory back when a task ends; workers live on between tasks."""
    def tidied(batches):
        import ctypes

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return tidied


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 2 * len(_powers)), BASE, np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers


def text_slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of a batch; a null text is empty."""
    text = batch.column(column)
    if text.null_count:
        text = text.fill_null("")
    wide = pa.types.is_large_string(text.type)
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64) if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and for each text the place of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACES[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; lower: A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = BYTE_VALUES[LOWER] if lower else BYTE_VALUES
    lengths = ends - starts
    flat = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(int(lengths.sum()))
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(flat)) - np.repeat(first, lengths)
    return mix64(np.add.reduceat(values[data[flat]] * powers(int(lengths.max()) + 1)[place], first))
