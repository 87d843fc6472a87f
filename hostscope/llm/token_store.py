"""A content-addressed store of token ids: chunks by rolling hash, recipes by document, Merkle manifests."""

from __future__ import annotations

import hashlib
import math
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostscope.llm.arrays import bounded_batches, text_slices, tidy, word_hashes, worker_memo
from hostscope.llm.common import new_dir, with_small, written

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: A chunk ends where the low CUT_BITS bits of a hash of the last WINDOW ids are zero, or after LONGEST ids.
WINDOW, CUT_BITS, LONGEST = 8, 8, 1024
GEAR = np.random.default_rng(20240131).integers(0, 1 << 32, 1 << 16, dtype=np.uint32)
#: Memory of encoded words in a Python worker, and what a word takes there beside its bytes and its ids'.
CACHE_BYTES, WORD_BYTES = 224 << 20, 170
#: Bytes of texts encoded at once.
SLICE_BYTES = 4 << 20

#: Addresses that a task remembers to have sent; then it forgets them all and may send some again.
SENT_CHUNKS = 1 << 18
#: Addresses in a bucket of the manifest on average, and how many bits of a prefix one node folds.
LEAVES, LEVEL_BITS = 1 << 15, 12

POLY = np.uint64(0xEDB88320)


class Encoder:
    """Ids of whole texts by the tokenizers library, a word at a time where that gives the same ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.memo = memo = worker_memo(f"words {path}")
        self.cache = memo.setdefault("cache", {})
        self.tokenizer = memo.get("tokenizer") or memo.setdefault("tokenizer", Tokenizer.from_file(path))
        vocab = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if len(vocab) <= 1 << 16 else "<u4")
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of single words, encoded together and cut behind each word's last id."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._library(words)
        raw, ends = ids.tobytes(), (ends * self.kind.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of each text (UTF-8 bytes between offsets)."""
        data, starts, ends, first, plain = plain_words(data, offsets)
        raw = data.tobytes()
        one, back = same_words(data, starts, ends)
        keys = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)]
        new = [k for k in keys if k not in self.cache]
        found = {}
        for x in range(0, len(new), 20_000):
            some = new[x : x + 20_000]
            found.update(zip(some, self._words([k.decode() for k in some]), strict=True))
        room = CACHE_BYTES - self.memo.get("bytes", 0)
        cost = sum(map(len, found)) + sum(map(len, found.values())) + WORD_BYTES * len(found)
        if cost <= room:
            self.cache.update(found)
            self.memo["bytes"] = CACHE_BYTES - room + cost
            ids = [self.cache[k] for k in keys]
        else:  # a full memory holds what was frequent enough to be met early
            ids = [found[k] if k in found else self.cache[k] for k in keys]
        flat = np.frombuffer(b"".join(ids), self.kind)
        size = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        begin = (np.cumsum(size) - size)[back]
        many = size[back]
        after = np.cumsum(many)
        tokens = flat[np.arange(int(after[-1]) if len(after) else 0) + np.repeat(begin - (after - many), many)].tobytes()
        cuts = np.concatenate(([0], after))[first] * self.kind.itemsize
        out = [tokens[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        odd = np.flatnonzero(~plain).tolist()
        for i, got in zip(odd, self._library([raw_text(data, offsets, i) for i in odd]), strict=True):
            out[i] = got
        return out


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one place of each distinct word, each word's number among them).

    Words meet by a 64-bit hash and are then compared byte for byte with the one that stands for them; a word that
    differs from it (two words of one hash) is a distinct word of its own.
    """
    _, one, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    if not len(starts):
        return one, back
    size = ends - starts
    other = size != size[one][back]
    size = np.where(other, 0, size)
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum()), dtype=np.int32)
    here = step + np.repeat((starts - first).astype(np.int32), size)
    there = step + np.repeat((starts[one][back] - first).astype(np.int32), size)
    wrong = np.flatnonzero(data[here] != data[there])
    other[np.searchsorted(first + size, wrong, "right")] = True
    odd = np.flatnonzero(other)
    if len(odd):
        back[odd] = len(one) + np.arange(len(odd))
        one = np.concatenate([one, odd])
    return one, back


_LETTER, _DIGIT, _OTHER = 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[32, *range(9, 14)]] = 0
#: Bytes that a plain text does not hold: controls, the apostrophe, and leads of characters beyond U+00FF or of U+0080 to U+00BF.
_ODD = np.zeros(256, bool)
_ODD[[*range(9), *range(14, 32), 39, 127, 192, 193, 194, *range(196, 256)]] = True


def raw_text(data: np.ndarray, offsets: np.ndarray, i: int) -> str:
    return data[offsets[i] : offsets[i + 1]].tobytes().decode()


def plain_words(data: np.ndarray, offsets: np.ndarray):
    """(data in lower case, starts, ends, each text's first word, plain): the tokenizer's words of plain texts.

    In a text of ASCII and of letters up to U+00FF, without apostrophes, words are runs of letters, single digits and
    runs of other marks. Texts with anything else, or with what may be a special token, are not plain and get no words.
    """
    n = len(offsets) - 1
    if not len(data):
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64), np.ones(n, bool)
    after = np.append(data[1:], np.uint8(0))
    odd = _ODD[data]
    odd |= (data == 60) & (after == 124)
    odd |= (data == 195) & ((after == 0x97) | (after == 0xB7))
    at = np.flatnonzero(odd)
    plain = np.ones(n, bool)
    plain[np.searchsorted(offsets, at, "right") - 1] = False
    upper = np.zeros(len(data), bool)
    upper[1:] = (data[:-1] == 195) & (data[1:] < 0x9F)
    kind = _CLASS[data]
    low = np.where(upper | (data >= 65) & (data <= 90), data + np.uint8(32), data)
    if not plain.all():
        keep = np.repeat(plain, np.diff(offsets))
        kind = np.where(keep, kind, 0)
        low = np.where(keep, low, data)
    turn = np.ones(len(data) + 1, bool)
    turn[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    turn[offsets] = True
    inside = kind != 0
    starts = np.flatnonzero(inside & turn[:-1])
    ends = np.flatnonzero(inside & turn[1:]) + 1
    return low, starts, ends, np.searchsorted(starts, offsets), plain


def chunk_ends(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ends of all chunks of consecutive documents (starts: of each document, none empty)."""
    g = GEAR[ids & 0xFFFF]
    h = g.copy()
    for k in range(1, WINDOW):
        h[k:] += g[:-k] << np.uint32(k)
    # The window must lie in the document, so that equal documents are cut alike.
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    cut = ((h >> np.uint32(WINDOW)) & np.uint32((1 << CUT_BITS) - 1) == 0) & (place >= WINDOW - 1)
    cut[np.append(starts[1:], len(ids)) - 1] = True
    ends = np.flatnonzero(cut) + 1
    begins = np.concatenate(([0], ends[:-1]))
    if (ends - begins).max(initial=0) > LONGEST:
        more = [np.arange(b + LONGEST, e, LONGEST) for b, e in zip(begins, ends, strict=True) if e - b > LONGEST]
        ends = np.sort(np.concatenate([ends, *more]))
    return ends


def address(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """The root of a binary tree of SHA-256 over the leaves, in their order; an odd node moves up."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


_ROWS = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("address", pa.binary()), ("n_tokens", pa.int64()), ("payload", pa.binary()), ("root", pa.binary())])
_ROWS_SQL = "kind string, doc_id long, address binary, n_tokens long, payload binary, root binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ROWS)], schema=_ROWS)


def _encode(path: str):
    """Chunk rows (each once a task, as far as SENT_CHUNKS remembers) and recipe rows; a recipe's address is that of its addresses and id, to spread them."""

    def run(batches):
        encoder, sent = Encoder(path), set()
        wide = encoder.kind.itemsize
        end_id = np.array([END_ID], encoder.kind).tobytes()
        for batch in batches:
            for at, end, data, offsets in text_slices(batch, size=SLICE_BYTES):
                some = batch.slice(at, end - at)
                raw = [r + end_id for r in encoder.encode(data, offsets)]
                sizes = np.array([len(r) // wide for r in raw])
                blob = b"".join(raw)
                ids = np.frombuffer(blob, encoder.kind)
                ends = chunk_ends(ids, np.cumsum(sizes) - sizes)
                begins = np.concatenate(([0], ends[:-1]))
                chunks = [blob[a * wide : b * wide] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                names = [address(c) for c in chunks]
                own = dict(zip(names, chunks, strict=True))
                rows = [("chunk", None, k, len(c) // wide, c, None) for k, c in own.items() if k not in sent]
                if len(sent) > SENT_CHUNKS:
                    sent.clear()
                sent.update(own)
                first = np.searchsorted(begins, np.cumsum(sizes) - sizes)
                for i, (a, b, doc) in enumerate(zip(first, [*first[1:], len(begins)], some.column("doc_id").to_pylist(), strict=True)):
                    recipe = b"".join(names[a:b])
                    rows.append(("recipe", doc, address(recipe + str(doc).encode()), int(sizes[i]), recipe, merkle_root(names[a:b])))
                yield _rows(rows)

    return run


def _roots(batches):
    """Roots of groups of (name, node) pairs, in the order of names: bucket, n and root."""
    for batch in batches:
        roots = [merkle_root([m["node"] for m in sorted(g, key=lambda m: m["name"])]) for g in batch.column("members").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("n"), pa.array(roots, pa.binary())], ["bucket", "n", "root"])


def _folded(nodes: DataFrame, n: Column) -> DataFrame:
    """The Merkle roots of nodes (bucket, name, node) by bucket."""
    groups = nodes.groupBy("bucket").agg(n.alias("n"), F.collect_list(F.struct("name", "node")).alias("members"))
    return groups.mapInArrow(tidy(_roots), "bucket long, n long, root binary")


def _bucket(name: Column, bits: int) -> Column:
    """The first bits (48 at most) of an address."""
    return F.shiftright(F.conv(F.substring(F.hex(name), 1, 12), 16, 10).cast("long"), 48 - bits)


def manifest(chunks: DataFrame, n: int) -> DataFrame:
    """A tree of Merkle roots over all chunk addresses (bits, bucket, n, root): a row a bucket, up to one root for all.

    The lowest buckets are prefixes of the addresses, which are hashes, so that a bucket has LEAVES of n addresses on
    average; LEVEL_BITS of a prefix go at each level. No task sees more than a bucket.
    """
    bits = max(0, math.ceil(math.log2(max(n, 1) / LEAVES)))
    level = written(_folded(chunks.select(_bucket(F.col("address"), bits).alias("bucket"), F.col("address").alias("name"), F.col("address").alias("node")), F.count(F.lit(1))), "manifest")
    out = level.select(F.lit(bits).alias("bits"), "*")
    while bits:
        drop = min(bits, LEVEL_BITS)
        bits -= drop
        nodes = level.select(F.shiftright("bucket", drop).alias("bucket"), F.col("bucket").alias("name"), F.col("root").alias("node"), "n")
        level = written(_folded(nodes, F.sum("n")), "manifest")
        out = out.unionByName(level.select(F.lit(bits).alias("bits"), "*"))
    return out


def write(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", store: str | None = None) -> str:
    """Encodes whole texts and writes chunks, recipes and manifests; returns the store's folder.

    chunk: each distinct chunk once, by content address. recipe: for each row, in ascending id order over the files,
    its chunk addresses, count of ids and Merkle root. manifest: a tree of Merkle roots over the chunks' addresses.
    Chunks meet by address in a shuffle, and one of each is kept after a sort that spills; parts are as many as
    spark.sql.shuffle.partitions, of any size.
    """
    import public_tokenizers

    spark = docs.sparkSession
    bounded_batches(spark)
    store = store or new_dir(spark, "token-store")
    path = path or public_tokenizers.path(TOKENIZER)
    if os.path.basename(path) != TOKENIZER:
        raise ValueError(f"words are split as {TOKENIZER} does; no other vocabulary file is known here")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    encoded = rows.mapInArrow(tidy(_encode(path)), _ROWS_SQL).repartition(parts, "address")
    nth = F.row_number().over(Window.partitionBy("address", "kind").orderBy("kind"))
    encoded.withColumn("_nth", nth).where("kind = 'recipe' or _nth = 1").drop("_nth").write.option("compression", "zstd").partitionBy("kind").parquet(f"{store}/raw")
    raw = spark.read.schema(_ROWS_SQL).parquet(f"{store}/raw")
    chunks = raw.where("kind = 'chunk'").select("address")
    manifest(chunks, chunks.count()).write.parquet(f"{store}/manifest")
    recipes = raw.where("kind = 'recipe'").select("doc_id", "n_tokens", "payload", "root")
    ordered = recipes.repartitionByRange(parts, F.asc_nulls_first("doc_id"), "root").sortWithinPartitions(F.asc_nulls_first("doc_id"), "root")
    ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("nth")).write.option("compression", "zstd").parquet(f"{store}/recipes")
    return store


def crc_times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo the CRC-32 polynomial (bit-reflected)."""
    out = np.zeros(np.broadcast(a, b).shape, np.uint64)
    b = np.broadcast_to(b, out.shape).copy()
    for k in range(31, -1, -1):
        out ^= np.where(a >> np.uint64(k) & np.uint64(1), b, np.uint64(0))
        b = np.where(b & np.uint64(1), b >> np.uint64(1) ^ POLY, b >> np.uint64(1))
    return out


def _shifts(most: int) -> np.ndarray:
    """For n = 0, 1, ..: the factor that appends n 32-bit words to a checksum."""
    x = np.array([1 << 30], np.uint64)
    for _ in range(5):  # x, squared five times: x**32
        x = crc_times(x, x)
    out = np.empty(most + 1, np.uint64)
    out[0] = 1 << 31
    for n in range(1, most + 1):
        out[n] = crc_times(out[n - 1 : n], x)[0]
    return out


def _checked(wide: str):
    def run(batches):
        import zlib

        for batch in batches:
            crc = []
            for name, raw in zip(batch.column("address").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                if address(raw) != name:
                    raise ValueError("a stored chunk does not have its content's address")
                crc.append(zlib.crc32(np.frombuffer(raw, wide).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("address"), batch.column("n_tokens"), pa.array(crc, pa.int64())], ["address", "n_chunk", "crc"])

    return run


def _rebuilt(shifts: np.ndarray):
    """Checksums of whole documents from those of their chunks, after checking each recipe's root and length."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            crc = np.zeros(len(rows), np.uint64)
            parts = [sorted((c["i"], c["n_chunk"], c["crc"], c["address"]) for c in r["chunks"]) for r in rows]
            for r, p in zip(rows, parts, strict=True):
                if merkle_root([c[3] for c in p]) != r["root"] or sum(c[1] for c in p) != r["n_tokens"]:
                    raise ValueError(f"document {r['doc_id']} can't be rebuilt from its chunks")
            many = np.array([len(p) for p in parts], np.int64)
            first, by_length = np.cumsum(many) - many, np.argsort(-many, kind="stable")
            n, own = (np.array([c[k] for p in parts for c in p], kind) for k, kind in ((1, np.int64), (2, np.uint64)))
            for j in range(int(many.max()) if len(many) else 0):
                on = by_length[: np.searchsorted(-many[by_length], -j)]  # those with more than j chunks
                at = first[on] + j
                crc[on] = crc_times(shifts[n[at]], crc[on]) ^ own[at]
            yield pa.RecordBatch.from_arrays([pa.array([r["nth"] for r in rows], pa.int64()), pa.array(crc.astype(np.int64), pa.int64())], ["nth", "ids_crc32"])

    return run


def read(spark, store: str, wide: str = "<u2") -> DataFrame:
    """Reads a store back: doc_id, start, n_tokens, ids_crc32 for every recipe; raises if anything does not fit."""
    raw = spark.read.schema(_ROWS_SQL).parquet(f"{store}/raw")
    chunks = raw.where("kind = 'chunk'").select("address", "n_tokens", "payload").mapInArrow(tidy(_checked(wide)), "address binary, n_chunk long, crc long")
    checked = f"{store}/checked-{os.urandom(8).hex()}"
    chunks.write.parquet(checked)  # without payloads; used twice below
    chunks = spark.read.schema("address binary, n_chunk long, crc long").parquet(checked)
    kept = spark.read.schema("bits int, bucket long, n long, root binary").parquet(f"{store}/manifest")
    found = manifest(chunks, chunks.count()).select("bits", "bucket", F.col("n").alias("_n"), F.col("root").alias("_root"))
    if not kept.join(found, ["bits", "bucket"], "full").where("not (n <=> _n and root <=> _root)").isEmpty():
        raise ValueError("the store's chunks do not have its manifest's roots")
    recipes = spark.read.schema("doc_id long, n_tokens long, payload binary, root binary, part int, nth long").parquet(f"{store}/recipes")
    n = (F.octet_length("payload") / 16).cast("int")
    lines = recipes.select("nth", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("payload"), i * 16 + 1, F.lit(16)))).alias("i", "address"))
    joined = lines.join(chunks, "address", "left")
    by_doc = joined.groupBy("nth").agg(F.collect_list(F.struct("i", F.coalesce("n_chunk", F.lit(-1)).alias("n_chunk"), F.coalesce("crc", F.lit(0)).alias("crc"), "address")).alias("chunks"))
    sums = by_doc.join(recipes.select("nth", "doc_id", "n_tokens", "root"), "nth").mapInArrow(tidy(_rebuilt(_shifts(LONGEST))), "nth long, ids_crc32 long")
    totals = recipes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = totals.select("part", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = recipes.select("nth", "part", "doc_id", "n_tokens", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_in"))
    placed = with_small(placed, before, "part", "inner", 32)
    return placed.join(sums, "nth").select("doc_id", (F.col("_start") + F.col("_in")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the store of a table's token ids and reads it back: doc_id, start, n_tokens, ids_crc32.

    Each text is encoded whole and ends with id 1. Chunks are cut where a rolling hash of the last ids says so, so
    copies and shared passages share chunks, and each distinct chunk is stored once whatever its number of uses.
    Reading checks every chunk against its address, all addresses against the manifest and every recipe against its root;
    a document's checksum is combined from its chunks' (the checksum of joined strings follows from those of the
    parts), so payloads are not moved to the documents. Null or empty text has the end id alone; null ids come first;
    rows with equal ids stand side by side, ordered by content; an empty table gives an empty result; other columns
    are ignored.
    """
    return read(docs.sparkSession, write(docs, path, id_col, text_col))
