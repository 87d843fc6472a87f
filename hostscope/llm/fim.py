"""Fill-in-the-middle transformation: units of a text by one repeated capture, two hash-drawn cuts, marks that restore."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.llm.arrays import bounded_batches, tidy

#: A unit of text: a line with its end, or the last line without one.
UNIT = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Percent of documents that are transformed, and of these in suffix-prefix-middle order.
RATE, SPM = 100, 50

_KINDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, suffix_chars long, output string"


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """h1 to h4: the first four 8-digit groups of sha256("seed:doc_id"); a null id counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def _transform(unit: str, seed: int, rate: int, spm: int):
    """Documents (doc_id, text) with their form, the lengths of the three pieces and the output."""

    def one(units, doc_id, text: str) -> tuple:
        h1, h2, h3, h4 = draws(doc_id, seed)
        ends = units.fullmatch(text).ends(1)  # every repetition that the one group captured
        n = len(ends)
        if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
            return doc_id, n, "plain", None, None, None, text
        at = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (ends[k - 1] if k else 0 for k in at)
        sizes = (a, b - a, len(text) - b)
        if h4 % 100 < spm:
            return doc_id, n, "spm", *sizes, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
        return doc_id, n, "psm", *sizes, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"

    def run(batches):
        units = regex.compile(f"({unit})*+")  # possessive: captures stay, nothing is kept for going back
        names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "suffix_chars", "output")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            rows, held = [], 0
            for k in range(len(ids)):
                rows.append(one(units, ids[k].as_py(), texts[k].as_py() or ""))
                held += len(rows[-1][-1])
                if held >= 1 << 20 or k + 1 == len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))
                    rows, held = [], 0

    return run


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = UNIT, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """One row a document: doc_id, n (units), form, prefix_chars, middle_chars, suffix_chars (code points) and output.

    One full match of (unit)* keeps every repetition of its group; its ends give n and both cut offsets. The cuts follow
    from the seed and the id alone: prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units, middle after
    the larger. psm is ``<P>``prefix``<S>``suffix``<M>``middle, spm is ``<S>``suffix``<P>``prefix``<M>``middle.

    A null text is empty; empty texts, texts with a mark in them and those beyond the rate stay as they are (form
    plain, null lengths); blank texts and texts of one unit have empty pieces; a null id draws as the empty id; rows
    of one id and text fare alike; an empty table stays empty; other columns are ignored. Each document is worked on
    by itself, so a text has to fit a task, and nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(_transform(unit, seed, rate, spm)), _KINDS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; marks part its pieces, as no transformed text holds one."""
    p = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "psm", F.concat(p[1], p[3], p[2])).when(form == "spm", F.concat(p[2], p[3], p[1])).otherwise(output)
