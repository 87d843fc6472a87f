"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces, with byte fallback."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.llm.arrays import bounded_batches, tidy
from hostscope.llm.common import ship, shipped

MODEL = "piece_bpe_32k.model"
#: Fixed value: an unknown character scores so much below the worst piece.
UNKNOWN_PENALTY = 10.0
MARK = "▁"
#: A chunk is a run of spaces and the word after it; pieces hold the space mark only at their start, so none crosses.
CHUNK = re.compile(rb" *[^ ]+| +")
#: Bytes of chunks and ids that a task remembers; what it meets beyond that is encoded again.
CACHE_BYTES = 12 << 20


class DoubleArray:
    """A trie of byte strings in two arrays: from state s, byte c leads to t = base[s] + c if check[t] = s."""

    def __init__(self, keys: dict[bytes, int]):
        root: dict = {}
        for key, value in keys.items():
            node = root
            for c in key:
                node = node.setdefault(c, {})
            node[-1] = value
        n = 4096
        base, check, value, free = np.zeros(n, np.int32), np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.ones(n, bool)
        free[0], low, wide, todo = False, 1, 1, [(root, 0)]
        while todo:
            node, state = todo.pop()
            value[state] = node.get(-1, -1)
            children = np.array(sorted(c for c in node if c >= 0))
            if not len(children):
                continue
            while not free[low]:
                low += 1
            at, reach, begin = -1, 256, low if len(children) == 1 else max(low, wide)
            while at < 0:  # the first place where all children fall on free slots; several search past the dense part
                while begin + reach + 512 > len(free):
                    n = len(free)
                    base, check, value, free = np.append(base, np.zeros(n, np.int32)), np.append(check, np.full(n, -1, np.int32)), np.append(value, np.full(n, -1, np.int32)), np.append(free, np.ones(n, bool))
                slots = begin + np.flatnonzero(free[begin : begin + reach]) - children[0]
                slots = slots[slots >= 0]
                fits = free[slots[:, None] + children].all(axis=1)
                at = int(slots[fits.argmax()]) if fits.any() else -1
                reach *= 4
            if len(children) > 1 and reach > 2048:
                wide = at + int(children[0])
            base[state] = at
            free[at + children] = False
            check[at + children] = state
            todo += [(node[int(c)], at + int(c)) for c in children]
        size = int(np.flatnonzero(~free)[-1]) + 258
        self.base, self.check, self.value = (np.append(x, np.full(258, y, np.int32))[:size] for x, y in ((base, 0), (check, -1), (value, -1)))

    def matches(self, data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All keys that start at the given places and end by their ends: places, lengths, values."""
        where, state, found = np.arange(len(at)), np.zeros(len(at), np.int32), []
        k = 0
        while len(where):
            inside = at[where] + k < ends[where]
            where, state = where[inside], state[inside]
            to = self.base[state] + data[at[where] + k]
            ok = self.check[to] == state
            where, state = where[ok], to[ok]
            k += 1
            hit = self.value[state] >= 0
            found.append((at[where[hit]], np.full(int(hit.sum()), k), self.value[state[hit]]))
        return tuple(map(np.concatenate, zip(*found, strict=True))) if found else (np.zeros(0, np.int64),) * 3


class Pieces:
    """A piece vocabulary: (piece, score, kind) by id, kind one of normal, byte, unknown, control.

    Scores are taken as the log probabilities of a unigram model, as stored. A space is written as the mark in a piece.
    """

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.scores = np.array([p[1] for p in pieces], np.float32)
        normal = [i for i, p in enumerate(pieces) if p[2] == "normal"]
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.unknown_score = np.float32(self.scores[normal].min() - UNKNOWN_PENALTY)
        self.trie = DoubleArray({pieces[i][0].replace(MARK, " ").encode(): i for i in normal})
        self.byte_ids = np.full(256, self.unknown, np.int32)
        self.bytes_of = [b""] * len(pieces)
        for i, (piece, _, kind) in enumerate(pieces):
            if kind == "normal":
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
            elif kind == "byte":
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: "byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) or sp.is_unused(i) else "normal"
        return cls([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())])

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk (as int32 bytes) on its best path; all chunks advance together."""
        data = np.frombuffer(b"".join(chunks), np.uint8)
        ends = np.cumsum([len(c) for c in chunks])
        starts = ends - np.array([len(c) for c in chunks])
        owner = np.repeat(np.arange(len(chunks)), ends - starts)
        heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
        at, size, ids = self.trie.matches(data, heads, ends[owner[heads]])
        char_size = np.append(heads[1:], len(data)) - heads
        single = np.zeros(len(data), bool)
        one_char = size == np.append(char_size, 0)[np.searchsorted(heads, at)]
        single[at[one_char]] = True
        alone = ~single[heads]
        at = np.concatenate([at, heads[alone]]).astype(np.int64)
        size = np.concatenate([size, char_size[alone]]).astype(np.int64)
        ids = np.concatenate([ids, np.full(int(alone.sum()), self.unknown)]).astype(np.int32)
        score = np.where(ids == self.unknown, self.unknown_score, self.scores[ids])
        step = at - starts[owner[at]]
        order = np.lexsort((size, step))
        at, size, ids, score, step = at[order], size[order], ids[order], score[order], step[order]
        slot = at + owner[at]  # a slot before each byte and one after each chunk
        best = np.full(len(data) + len(chunks), -np.inf, np.float32)
        best[starts + np.arange(len(chunks))] = 0
        back = np.full(len(best), -1)
        edges = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1], [True]))) if len(step) else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):  # targets differ within a step
            new = best[slot[a:b]] + score[a:b]
            to = slot[a:b] + size[a:b]
            up = new > best[to]
            best[to[up]] = new[up]
            back[to[up]] = np.arange(a, b)[up]
        took, whose = [], np.arange(len(chunks))
        now = ends + whose
        while len(whose):
            m = back[now]
            took.append((whose, m))
            now = slot[m]
            on = now > starts[whose] + whose
            whose, now = whose[on], now[on]
        whose = np.concatenate([x[0] for x in took])
        m = np.concatenate([x[1] for x in took])
        order = np.lexsort((at[m], whose))
        whose, m = whose[order], m[order]
        wide = np.where(ids[m] == self.unknown, size[m], 1)
        flat = np.repeat(ids[m], wide)
        lost = flat == self.unknown
        if lost.any():
            place = np.arange(len(flat)) - np.repeat(np.cumsum(wide) - wide, wide) + np.repeat(at[m], wide)
            flat[lost] = self.byte_ids[data[place[lost]]]
        cuts = np.concatenate(([0], np.cumsum(np.bincount(whose, wide, len(chunks)).astype(np.int64)))) * 4
        raw = flat.astype("<i4").tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode(self, texts: list[str | None], cache: dict) -> list[np.ndarray]:
        split = [CHUNK.findall(b" " + t.encode()) if t else [] for t in texts]
        met = {c for chunks in split for c in chunks}
        new, found = list(met.difference(cache)), {}
        for x in range(0, len(new), 10_000):
            found.update(zip(new[x : x + 10_000], self.encode_chunks(new[x : x + 10_000]), strict=True))
        held = cache.setdefault(b"", 0) + sum(map(len, found)) + sum(map(len, found.values()))
        if held <= CACHE_BYTES:
            cache.update(found)
            cache[b""] = held  # no chunk is empty
            known = cache
        else:  # a full memory holds what was frequent enough to be met early
            known = {c: found[c] if c in found else cache[c] for c in met}
        return [np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<i4") for chunks in split]

    def decode(self, ids) -> str:
        """The text of ids; a leading space is the one that encoding put there."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


def _run(model):
    def run(batches):
        pieces, cache = shipped(model), {}
        for batch in batches:
            for x in range(0, len(batch), 256):
                some = batch.slice(x, 256)
                texts = some.column("text").to_pylist()
                ids = pieces.encode(texts, cache)
                whole = [pieces.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts, strict=True)]
                n = np.array([len(i) for i in ids], np.int64)
                flat = pa.array(np.concatenate(ids) if len(ids) else np.zeros(0, np.int32), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(n, pa.int64()), lists, pa.array(whole, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])

    return run


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: doc_id, n_tokens, ids, round_trip (decoding the ids gave the text again).

    The text gets a leading space and is cut into chunks (spaces and the word after them), which no piece crosses; each
    chunk's best path by summed log scores is found by Viterbi over the trie's matches. Characters without a piece,
    and any literal space mark, become byte pieces, so decoding gives back every text exactly. Null or empty text has
    no ids; ties go to the path found first, from the left; repeated rows get equal ids; an empty table gives an empty
    result; other columns are ignored. The vocabulary (a file on every machine) is read once and broadcast; its size
    does not depend on the documents.
    """
    import public_tokenizers

    spark = docs.sparkSession
    bounded_batches(spark)
    model = ship(spark, Pieces.from_file(path or public_tokenizers.path(MODEL)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(_run(model)), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
