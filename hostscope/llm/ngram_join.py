"""Similarity join of documents on word shingles: token-combination prefixes, then verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostscope.llm.arrays import bounded_batches, mix64, text_slices, tidy, word_hashes, word_spans
from hostscope.llm.common import written
from hostscope.llm.components import components

SHINGLE = 5
PERCENT = 75
#: Tokens are the top 48 bits of a shingle's hash.
TOKEN_BITS = 48
#: A token of so many documents is frequent: it is indexed in pairs, and a task that meets so many sends them past the counters.
FREQUENT = 64
#: Tokens that a map task sorts and sends at once, and tokens counted by one task.
FLUSH_TOKENS = 2_000_000
COUNTER_TOKENS = 1_500_000
#: Shared tokens are counted in so many classes, to bound overlaps.
CLASSES = 32
#: Two sets link if they differ in at most this share of the sum of their sizes: _NARROW / _WIDE.
_WIDE, _NARROW = 100 + PERCENT, 100 - PERCENT

_MULT = [mix64(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(SHINGLE + 1)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends, lower=True)
    if len(h) >= SHINGLE:
        n = len(h) - SHINGLE + 1
        grams = mix64(sum((h[k : k + n] * _MULT[k] for k in range(1, SHINGLE)), h[:n] * _MULT[0]))
    else:
        grams = np.zeros(0, np.uint64)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE:
            yield np.unique(grams[a : b - SHINGLE + 1])
        elif b > a:
            few = np.array([b - a], np.uint64)
            for x in h[a:b]:
                few = mix64(few * _MULT[SHINGLE] + x)
            yield few
        else:
            yield np.zeros(0, np.uint64)


#: Fixed values that make the two halves of a set's name differ.
_HALVES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def set_id(s: np.ndarray) -> bytes:
    """A 128-bit name of a set; equal sets share it."""
    halves = [mix64(np.add.reduce(mix64(s ^ salt), keepdims=True) + np.array([len(s)], np.uint64)) for salt in _HALVES]
    return np.concatenate(halves).tobytes()


def _documents(batches):
    for batch in batches:
        n, ref = [], []
        for *_, data, offsets in text_slices(batch):
            for s in shingle_sets(data, offsets):
                n.append(len(s))
                ref.append(set_id(s))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ref, pa.binary())], ["doc_id", "n_shingles", "ref"])


_BLOB = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("payload", pa.binary())])
_BLOB_SQL = "to long, kind int, part long, payload binary"
TOKENS, FREQUENT_TOKENS, HEADER = 0, 1, 2


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_BLOB)], schema=_BLOB)


def _pack(sorted_values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences of 32 bits where they fit."""
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    small = not len(gaps) or gaps.max() < 1 << 32
    return (b"\x04" if small else b"\x08") + gaps.astype(np.uint32 if small else np.uint64).tobytes()


def _unpack(raw: bytes, n: int) -> tuple[np.ndarray, int]:
    width = raw[0]
    return np.cumsum(np.frombuffer(raw, np.uint32 if width == 4 else np.uint64, n, 1).astype(np.uint64)), 1 + n * width


def _pairs_blob(tokens: np.ndarray, places: np.ndarray) -> bytes:
    return np.uint32(len(tokens)).tobytes() + _pack(tokens) + places.astype(np.uint16).tobytes()


def _read_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    tokens, used = _unpack(raw[4:], n)
    return tokens, np.frombuffer(raw, np.uint16, n, 4 + used)


def _send_tokens(bits: int):
    """Map side: a flush of documents becomes one blob of (token, document) for each of 2**bits counters."""

    def flush(part: int, sets: list[np.ndarray], heads: list[tuple], names: list[bytes]) -> pa.RecordBatch:
        tokens = np.concatenate(sets)
        places = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        tokens, places = tokens[order], places[order]
        new = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        many = np.diff(np.append(new, len(tokens)))
        frequent = np.repeat(many >= FREQUENT, many)
        rows = [(part, HEADER, part, np.array(heads, np.int64).tobytes() + b"".join(names))]
        if frequent.any():
            rows.append((part, FREQUENT_TOKENS, part, _pairs_blob(tokens[frequent], places[frequent])))
        # Counters hear of a frequent token once, so that its documents elsewhere are told the same.
        hot = tokens[new[many >= FREQUENT]]
        tokens, places = tokens[~frequent], places[~frequent]
        shift = np.uint64(TOKEN_BITS - bits)
        low = np.uint64((1 << (TOKEN_BITS - bits)) - 1)
        counters = np.union1d(tokens >> shift, hot >> shift)  # those that this flush has something for
        a, b = np.searchsorted(tokens, counters << shift), np.searchsorted(hot, counters << shift)
        a, b = np.append(a, len(tokens)), np.append(b, len(hot))
        for i, k in enumerate(counters.tolist()):
            own = hot[b[i] : b[i + 1]] & low
            rows.append((k, TOKENS, part, np.uint32(len(own)).tobytes() + own.tobytes() + _pairs_blob(tokens[a[i] : a[i + 1]] & low, places[a[i] : a[i + 1]])))
        return _blobs(rows)

    def run(batches):
        part, sets, heads, names, known, held = TaskContext.get().partitionId() << 24, [], [], [], set(), 0
        for batch in batches:
            for *_, data, offsets in text_slices(batch):
                for s in shingle_sets(data, offsets):
                    if len(s) < 3 or (ref := set_id(s)) in known:
                        continue
                    own = np.unique(s >> np.uint64(64 - TOKEN_BITS))
                    known.add(ref)
                    sets.append(own)
                    names.append(ref)
                    heads.append((len(s), len(own) - len(s) * (100 - PERCENT) // 100 - 1))
                    held += len(own)
                    if held >= FLUSH_TOKENS or len(sets) == 65_535:
                        yield flush(part, sets, heads, names)
                        part, sets, heads, names, known, held = part + 1, [], [], [], set(), 0
        if sets:
            yield flush(part, sets, heads, names)

    return run


def _count_tokens(bits: int):
    """Counter side: tells each flush which of its tokens other documents have, and how many documents that is."""

    def one(k: int, blobs: list[tuple[int, bytes]]) -> list[tuple]:
        tokens, places, parts, hot = [], [], [], []
        for part, raw in blobs:
            m = int(np.frombuffer(raw, np.uint32, 1)[0])
            hot.append(np.frombuffer(raw, np.uint64, m, 4))
            t, p = _read_pairs(raw[4 + 8 * m :])
            tokens.append(t)
            places.append(p)
            parts.append(np.full(len(t), part))
        tokens, places, parts, hot = map(np.concatenate, (tokens, places, parts, hot))
        order = np.argsort(tokens, kind="stable")
        tokens, places, parts = tokens[order], places[order], parts[order]
        if not len(tokens):
            return []
        new = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        many = np.diff(np.append(new, len(tokens)))
        count = np.repeat(np.where(np.isin(tokens[new], hot), FREQUENT, np.minimum(many, FREQUENT)), many)
        shared = count > 1
        if not shared.any():
            return []
        tokens, places, parts, count = tokens[shared], places[shared], parts[shared], count[shared]
        order = np.argsort(parts, kind="stable")
        tokens, places, parts, count = tokens[order], places[order], parts[order], count[order]
        out = []
        ids, at = np.unique(parts, return_index=True)
        for part, x, y in zip(ids, at, [*at[1:], len(parts)], strict=True):
            full = tokens[x:y] | np.uint64(k) << np.uint64(TOKEN_BITS - bits)
            out.append((int(part), TOKENS, int(part), _pairs_blob(full, places[x:y]) + count[x:y].astype(np.uint8).tobytes()))
        return out

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            past = batch.filter(pc.not_equal(batch.column("kind"), TOKENS))
            if len(past):
                yield past.select(["to", "kind", "part", "payload"]).cast(_BLOB)
            for to, kind, part, raw in zip(*(batch.column(c).to_pylist() for c in ("to", "kind", "part", "payload")), strict=True):
                if kind == TOKENS:
                    held.setdefault(to, []).append((part, raw))
        for k in list(held):
            if rows := one(k, held.pop(k)):
                yield _blobs(rows)

    return run


def signatures(tokens: np.ndarray, count: np.ndarray, spare: int, n: int) -> np.ndarray:
    """Signatures of a document from its shared tokens (sorted by count class, then token).

    spare tokens that no other document has come first in the order. The plain prefix ends where a document without a
    match there would miss more tokens than the threshold lets it. Rare tokens sign alone. Frequent ones sign in pairs
    within subclasses; the prefix is extended until the tokens beyond the first of each subclass make up the rest.
    A document signs in the length band of its own size and, if another, of the least size it may match.
    """
    need = len(tokens) - spare
    rare = int(np.searchsorted(count, FREQUENT))
    out = [mix64(tokens[: min(rare, need)])]
    if need > rare:
        heavy = tokens[rare:]
        for band in {_band(n), _band(-(-n * PERCENT // 100))}:
            classes = max(1, 4**band // 8)
            sub = (mix64(heavy + np.uint64(band)) % np.uint64(classes)).astype(np.int64)
            _, first = np.unique(sub, return_index=True)
            beyond = np.ones(len(heavy), bool)
            beyond[first] = False
            end = int(np.searchsorted(np.cumsum(beyond), need - rare)) + 1
            order = np.argsort(sub[:end], kind="stable")
            t, s = heavy[:end][order], sub[:end][order]
            for step in range(1, end):
                same = s[step:] == s[:-step]
                if not same.any():
                    break
                out.append(mix64(mix64(t[:-step][same] + np.uint64(band)) * _MULT[1] + t[step:][same]))
    return np.unique(np.concatenate(out))


def _band(n: int) -> int:
    return (max(n, 1).bit_length() - 1) // 2


def _six(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _survivors(batches):
    """Document side: documents whose prefix holds a shared token, with their shared tokens and signatures."""
    heads, got = {}, {}
    for batch in batches:
        for kind, part, raw in zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "payload")), strict=True):
            if kind == HEADER:
                heads[part] = np.frombuffer(raw[: len(raw) // 2], np.int64).reshape(-1, 2), raw[len(raw) // 2 :]
            else:
                t, p = _read_pairs(raw)
                c = np.full(len(t), FREQUENT, np.uint8) if kind == FREQUENT_TOKENS else np.frombuffer(raw[-len(t) :], np.uint8)
                got.setdefault(part, []).append((t, p, c))
    for part in list(got):
        tokens, places, count = map(np.concatenate, zip(*got.pop(part), strict=True))
        order = np.lexsort((tokens, count, places))
        tokens, places, count = tokens[order], places[order], count[order]
        ids, at = np.unique(places, return_index=True)
        rows = []
        for i, a, b in zip(ids, at, [*at[1:], len(places)], strict=True):
            n, spare = heads[part][0][i]
            if b - a > spare:
                ref = heads[part][1][16 * int(i) : 16 * int(i) + 16]
                own = np.sort(tokens[a:b])
                counts = np.bincount((own % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)
                central = float(count[a:b].sum()) / float(n)
                rows.append((ref, int(n), b - a, central, counts.tolist(), _six(own), signatures(tokens[a:b], count[a:b], int(spare), int(n)).view(np.int64)))
        for x in range(0, len(rows), 512):
            some = rows[x : x + 512]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in some], kind) for i, kind in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64())))],
                ["ref", "n", "m", "central", "counts", "tokens", "signs"],
            )


def _verify(batches):
    for batch in batches:
        keep = []
        for na, ta, nb, tb in zip(*(batch.column(c).to_pylist() for c in ("na", "ta", "nb", "tb")), strict=True):
            both = len(np.intersect1d(_from_six(ta), _from_six(tb), assume_unique=True))
            keep.append(100 * both >= PERCENT * (na + nb - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], ["a", "b", "linked"])


def _most(ca: str, cb: str) -> Column:
    """The most tokens that two sets can share, from their counts by class."""
    return sum((F.least(F.get(ca, F.lit(k)), F.get(cb, F.lit(k))) for k in range(1, CLASSES)), F.least(F.get(ca, F.lit(0)), F.get(cb, F.lit(0))))


def _linked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that pass the exact test, written. Counts by class of token exclude most others before tokens are read."""
    narrow = docs.select("ref", "n", "counts")
    a = narrow.select(F.col("ref").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    b = narrow.select(F.col("ref").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))
    able = pairs.join(a, "a").join(b, "b").where(_most("ca", "cb") * (100 + PERCENT) >= (F.col("na") + F.col("nb")) * PERCENT).select("a", "b", "na", "nb")
    able = able.join(docs.select(F.col("ref").alias("a"), F.col("tokens").alias("ta")), "a").join(docs.select(F.col("ref").alias("b"), F.col("tokens").alias("tb")), "b")
    return written(able.mapInArrow(tidy(_verify), "a binary, b binary, linked boolean").where("linked").select("a", "b"), "links")


def _distance(batches):
    """How far a set is from its group's centre: the size of their difference."""
    for batch in batches:
        d = []
        for n, t, c in zip(*(batch.column(k).to_pylist() for k in ("n", "tokens", "center_tokens")), strict=True):
            d.append(n + len(c) // 6 - 2 * len(np.intersect1d(_from_six(t), _from_six(c), assume_unique=True)))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("center", "ref", "n")), pa.array(d, pa.int64())], ["center", "ref", "n", "d"])


def _differences(batches):
    """The tokens in which a set differs from its group's centre, as far as its prefix goes; at: how many follow, itself included.

    Tokens beyond the centre come before tokens of the centre that the set lacks, each by value; tokens that no other
    set has would come first and are left out.
    """
    for batch in batches:
        out = {k: [] for k in ("center", "ref", "n", "v", "outer", "root", "token", "at")}
        columns = ("center", "ref", "n", "v", "outer", "root", "m", "d", "least", "tokens", "center_tokens")
        for center, ref, n, v, outer, root, m, d, least, t, c in zip(*(batch.column(k).to_pylist() for k in columns), strict=True):
            t, c = _from_six(t), _from_six(c)
            both = np.concatenate((np.setdiff1d(t, c, assume_unique=True), np.setdiff1d(c, t, assume_unique=True)))
            prefix = both[: max(0, d - max(1, least) + 1 - (n - m))]
            for k, x in zip(("center", "ref", "n", "v", "outer", "root"), (center, ref, n, v, outer, root), strict=True):
                out[k] += [x] * len(prefix)
            out["token"] += prefix.tolist()
            out["at"] += range(len(both), len(both) - len(prefix), -1)
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out.values(), kinds, strict=True)], list(out))


def _with_tokens(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows (center, ref) with the shared tokens of both."""
    own = held.select("ref", "m", "tokens")
    return rows.join(own, "ref").join(held.select(F.col("ref").alias("center"), F.col("tokens").alias("center_tokens")), "center")


def links(docs: DataFrame, tokens: int, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, components) between sets: enough links to connect each component, and (ref, root) of the linked sets.

    Sets of one signature have its most common set C as centre (the tokens of C that any other set has). With d(A) the
    size of A's difference from C, sets A and B differ in d(A) + d(B) - 2 s tokens, s being how many of these
    differences they share, and link if that is at most (|A| + |B|) / 7 (for 75 %). With v(A) = 7 d(A) - |A| this reads
    v(A) + v(B) <= 14 s. So
    * pairs with v(A) + v(B) <= 0 link; all of a centre's are connected by links to its set of least v, made at once;
    * any other pair shares at least (v(A) + v(B)) / 14 differences, and one of the two has no link to the set of least
      v: such pairs are sought by (centre, token of the difference) within prefixes of the differences, and tested.
    Groups whose sets all have one component already are not looked at again. No pair is left out.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // COUNTER_TOKENS))
    bits = min(26, max(8, (4 * parts - 1).bit_length()))
    flushes = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // FLUSH_TOKENS))
    sent = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(_send_tokens(bits)), _BLOB_SQL)
    told = sent.repartition(parts, F.col("to")).mapInArrow(tidy(_count_tokens(bits)), _BLOB_SQL)
    found = told.repartition(flushes, F.col("to")).mapInArrow(tidy(_survivors), "ref binary, n long, m long, central double, counts array<int>, tokens binary, signs array<long>")
    held = written(found.dropDuplicates(["ref"]), "ngram-docs")
    posts = held.select("ref", "n", "central", F.explode("signs").alias("sign"))
    groups = posts.groupBy("sign").agg(F.max(F.struct("central", "ref")).alias("c"), F.count(F.lit(1)).alias("many")).where("many > 1").select("sign", F.col("c.ref").alias("center"))
    members = posts.join(groups, "sign").select("center", "ref", "n").distinct()
    near = _with_tokens(members, held).mapInArrow(tidy(_distance), "center binary, ref binary, n long, d long")
    near = written(near.withColumn("v", _WIDE * F.col("d") - _NARROW * F.col("n")), "ngram-members")
    least = near.groupBy("center").agg(F.min(F.struct("v", "ref")).alias("z")).select("center", F.col("z.v").alias("z_v"), F.col("z.ref").alias("z_ref"))
    near = near.join(written(least, "ngram-least"), "center")  # written, so that a hot centre's rows can be split in the join
    found = written(near.where((F.col("v") + F.col("z_v") <= 0) & (F.col("ref") != F.col("z_ref"))).select(F.least("ref", "z_ref").alias("a"), F.greatest("ref", "z_ref").alias("b")).distinct(), "links")
    roots = components(found)
    near = near.join(roots, "ref", "left").select("center", "ref", "n", "d", "v", "z_v", F.coalesce("root", "ref").alias("root"), (F.col("v") + F.col("z_v") > 0).alias("outer"))
    # The least v of a set that a centre's least set doesn't link with bounds what any pair of the group must share.
    open_ = near.groupBy("center").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.min(F.when(F.col("outer"), F.col("v"))).alias("o_v")).where("r <> s")
    share = F.ceil((F.col("v") + F.when(F.col("outer"), F.col("z_v")).otherwise(F.col("o_v"))) / (2 * _WIDE))
    left = near.join(written(open_.select("center", "o_v"), "ngram-open"), "center").where(F.col("outer") | (_WIDE * F.col("d") + _NARROW * F.col("n") >= F.col("o_v"))).withColumn("least", share)
    left = written(left.select("center", "ref", "n", "d", "v", "root", "outer", "least"), "ngram-left")
    kind = "center binary, ref binary, n long, v long, outer boolean, root binary, token long, at long"
    signed = written(_with_tokens(left, held).mapInArrow(tidy(_differences), kind), "ngram-differences")
    a, b = signed.where("outer").alias("a"), signed.alias("b")
    able = (F.col("a.root") != F.col("b.root")) & (~F.col("b.outer") | (F.col("a.ref") < F.col("b.ref"))) & (2 * _WIDE * F.least("a.at", "b.at") >= F.col("a.v") + F.col("b.v"))
    pairs = a.join(b, (F.col("a.center") == F.col("b.center")) & (F.col("a.token") == F.col("b.token")) & able)
    pairs = written(pairs.select(F.least("a.ref", "b.ref").alias("a"), F.greatest("a.ref", "b.ref").alias("b")).distinct(), "ngram-pairs")
    more = _linked(pairs, held)
    if not more.isEmpty():
        found = found.unionByName(more)
        roots = components(found)
    return found, roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (least id reachable by links, itself included), ref.

    Documents link when 100 * |A & B| >= 75 * |A | B| for their sets of distinct five-word shingles (A-Z lower-cased;
    fewer words form one shingle). Equal sets are collapsed to one ``ref``. The rest goes by token-combination
    prefixes: documents are told how many others share each of their tokens, those whose prefix has no shared token
    drop out, and prefixes are signed with single rare tokens or pairs of frequent ones. Documents with a common
    signature are compared with one central document first; what differs from it then extends the combination, so
    neither a group of near copies nor one hot passage is expanded into all its pairs (see ``links``).

    Null or blank text has an empty set, links with nothing and is its own component; null ids are ignored in the
    least id; rows with equal id and text are one document; an empty table gives an empty result; other columns are
    ignored. Sets and tokens are compared by hashes of 128 and 48 bits.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = written(rows.mapInArrow(tidy(_documents), "doc_id long, n_shingles long, ref binary"), "ngram-sets")
    tokens = table.agg(F.sum("n_shingles")).first()[0] or 0
    _, roots = links(rows, int(tokens))
    least = table.where("n_shingles > 0").groupBy("ref").agg(F.min("doc_id").alias("_id"))
    named = least.join(roots, "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    ids = named.groupBy("root").agg(F.min("_id").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    ids = named.join(ids, "root").select("ref", "component_id")
    out = table.join(ids, "ref", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "ref")
