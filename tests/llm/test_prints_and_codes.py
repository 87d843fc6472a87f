"""SimHash, vector codes and fill-in-the-middle against brute force, SQL and exact round trips."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hostscope.llm import fim, queries, simhash, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def classes(prints):
    """The least member of each value's class, links being three bits or fewer."""
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for k, a in enumerate(values):
        for b in values[:k]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprints_of_any_text(make, odd):
    texts = [*odd, (900, "A b C"), (901, "a B"), (902, "a  b\tc \n d a b c"), (903, "Ä Z z")]
    got = {(r.doc_id, r.fingerprint) for r in simhash.near_duplicates(make(texts)).collect()}
    assert got == {(i, f"{fingerprint(t):016x}") for i, t, *_ in texts}


def test_components_of_documents(make, odd):
    texts = [*odd, *[(2000 + k, odd[3][1].replace("a", "b", k)) for k in range(6)]]
    out = simhash.near_duplicates(make(texts)).collect()
    assert len(out) == len(texts)
    prints = {t: fingerprint(t) for _, t, *_ in texts}
    root = classes(prints.values())
    least = {}
    for i, t, *_ in texts:
        if i is not None:
            least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    held = {int(r.fingerprint, 16): r.component_id for r in out}
    assert all(held[p] == least.get(root[p]) for p in prints.values())
    assert {r.component_id for r in out if r.fingerprint == "0" * 16} == {1}  # null, empty and blank texts
    assert simhash.near_duplicates(make([])).count() == 0


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def clusters(rng):
    """Balls of near fingerprints, chains three bits a step, pairs at three and four bits, the extremes."""
    out = {0, (1 << 64) - 1, 1, 1 << 63, 7}
    for _ in range(6):
        c = int(rng.integers(0, 1 << 63)) << 1
        out |= {c ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False)) for _ in range(60)}
        at = c
        for _ in range(10):
            at ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            out.add(at)
    return sorted(out)


@pytest.mark.parametrize("dense", [2, 5, 1000])
def test_links_connect_what_brute_force_does(spark, dense):
    values = clusters(np.random.default_rng(3))
    got = simhash.links(spark.createDataFrame([(signed(v),) for v in values], "print long"), dense).collect()
    pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in got}
    assert all((a ^ b).bit_count() <= 3 and a != b for a, b in pairs)
    if dense == 1000:
        assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for k, a in enumerate(values) for b in values[:k] if (a ^ b).bit_count() <= 3}
    root = {v: v for v in values}
    for _ in values:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert root == classes(values)


def test_dense_cells_are_not_expanded(spark):
    """A ball of all fingerprints two bits from a centre is connected by a small share of its links."""
    values = [0, *(1 << i for i in range(40)), *((1 << i) | (1 << j) for i in range(40) for j in range(i))]
    frame = spark.createDataFrame([(v,) for v in values], "print long")
    few = simhash.links(frame, 16)
    assert few.count() * 4 < simhash.links(frame, 10**6).count()
    assert len({r.root for r in simhash.components(few).collect()}) == 1


def test_unary_counts_bound_the_distance(spark):
    rng = np.random.default_rng(8)
    rows = [(int(a), int(b)) for a, b in rng.integers(-(1 << 63), 1 << 63, (200, 2))]
    df = spark.createDataFrame(rows, "x long, y long")
    got = df.select(simhash.bits_apart(simhash.counts_in_unary(F.col("x")), simhash.counts_in_unary(F.col("y"))), simhash.bits_apart(F.col("x"), F.col("y"))).collect()
    for (x, y), (low, exact) in zip(rows, got, strict=True):
        counts = lambda v: [(v >> 2 * j & 3).bit_count() for j in range(32)]
        assert low == sum(abs(a - b) for a, b in zip(counts(x), counts(y), strict=True)) <= exact == ((x ^ y) & (1 << 64) - 1).bit_count()


@pytest.mark.parametrize("spread", [1, 5, 3000])
def test_nearest_entries_by_masks(spread):
    rng = np.random.default_rng(spread)
    for k, width in ((1, 3), (16, 8), (64, 2), (7, 0)):
        entries, points = rng.integers(-spread, spread + 1, (k, width)), rng.integers(-2 * spread, 2 * spread + 1, (300, width))
        code, best = vector_codes.SlicedEntries(entries).nearest(points)
        apart = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (code == apart.argmin(1)).all() and (best == apart.min(1)).all()
        box = vector_codes.SlicedEntries(entries).in_box(points, np.full(300, spread))
        inside = (abs(points[:, None] - entries[None]) <= spread).all(2)
        assert (box == (inside * (np.uint64(1) << np.arange(k, dtype=np.uint64))).sum(1, dtype=np.uint64)).all()


def brute_codes(rows, entries=16, parts=8, rounds=6):
    from math import floor

    vecs = sorted((i is None, i or 0, np.array([floor(4096 * x) for x in v], "<i4").tobytes(), lab) for i, v, lab in rows)
    q = np.array([np.frombuffer(v, "<i4") for *_, v, _ in vecs], np.int64)
    w = q.shape[1] // parts
    cut = q.reshape(len(q), parts, w)
    books = [cut[:entries, p].copy() for p in range(parts)]
    for r in range(rounds + 1):
        apart = [((cut[:, p, None] - books[p][None]) ** 2).sum(2) for p in range(parts)]
        code = [a.argmin(1) for a in apart]
        if r < rounds:
            for p in range(parts):
                for e in set(code[p].tolist()):
                    books[p][e] = cut[code[p] == e, p].sum(0) // (code[p] == e).sum()
    error = sum(a.min(1) for a in apart)
    total = {}
    for (*_, lab), e in zip(vecs, error.tolist(), strict=True):
        total[lab] = total.get(lab, 0) + e
    out = [(None if no else i, "".join(f"{int(c[k]):02x}" for c in code), int(error[k]), total[lab]) for k, (no, i, _, lab) in enumerate(vecs)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b.tolist() for x in e).encode()).hexdigest()


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 16)], int(i % 3) if i % 7 else None) for i in range(120)]
    rows += [rows[5], (6, rows[7][1], 1), (None, rows[8][1], 2), (500, [0.0] * 16, None), (501, [-0.00001] * 16, 0)]
    bad = [(-1, None, 1), (-2, [None] + [0.1] * 15, 1), (-3, [float("nan")] + [0.1] * 15, 1), (-4, [float("inf")] * 16, None), (-5, [float("-inf")] * 16, None)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows + bad], "vec_id long, embedding array<float>, label int, code string, error string").repartition(3)
    coded, books = vector_codes.compress(frame)
    want, digest = brute_codes(rows)
    assert sorted(map(str, ((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()))) == sorted(map(str, want))
    assert vector_codes.codebooks_digest(books) == digest


def test_few_other_and_no_vectors(spark):
    kind = "vec_id long, embedding array<double>, label string"
    coded, books = vector_codes.compress(spark.createDataFrame([(1, [0.5] * 8, "a"), (2, [0.25] * 8, "a"), (3, [0.1] * 5, "b"), (4, [1e300] * 8, "c")], kind))
    out = {r.vec_id: r for r in coded.collect()}
    assert out[1].error == out[2].error == 0 and out[3].code is None and out[3].error is None and out[3].label_error is None and out[4].error == 0
    assert [len(b) for b in books] == [3] * 8
    coded, books = vector_codes.compress(spark.createDataFrame([], kind))
    assert coded.count() == 0 and books == [] and coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert vector_codes.compress(spark.createDataFrame([(1, [], "a")], kind))[0].collect()[0].code == "00" * 8


def test_fill_in_middle(make, odd):
    texts = [*odd, (800, "a\nb\n\nc"), (801, "\n"), (802, "\n\n\n"), (803, "has <S> in it\nx"), (804, "ends <P\n<M\nS>\n"), (805, "l\n" * 5000), (806, "no end"), (807, "\r\n\x0b x\n"), (808, "<\n<P\nP>\n")]
    out = fim.transform(make(texts)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(texts)
    seen = set()
    by = {(i, t or ""): t or "" for i, t, *_ in texts}
    for r in out:
        text = by[r.doc_id, r.back]  # restored exactly
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        h = hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, _, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) else "spm" if h4 % 100 < 50 else "psm"
        want = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert (r.n, r.form, r.output) == (len(units), form, want)
        assert (r.prefix_chars, r.middle_chars, r.suffix_chars) == ((None,) * 3 if form == "plain" else (len(p), len(m), len(s)))
        seen.add(form)
    assert seen == {"plain", "psm", "spm"}
    assert fim.transform(make([])).count() == 0
    assert {r.form for r in fim.transform(make(texts), rate=0).collect()} == {"plain"}


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_fill_in_middle"])
def test_query_against_sql(name, compare):
    assert compare(queries.queries()[name], queries.oracle_sql()[name]) > 0


def test_simhash_query_against_brute_force(spark, sf):
    docs = {r.doc_id: fingerprint(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    root, least = classes(docs.values()), {}
    for i, p in docs.items():
        least[root[p]] = min(i, least.get(root[p], i))
    out = queries.op11_simhash(spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in out} == {(i, f"{p:016x}", least[root[p]]) for i, p in docs.items()} and len(out) == len(docs)
