"""Document scores by masked pseudo-likelihood: a bidirectional window network over classes, all words by count."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.llm.arrays import LOWER, SPACES, bounded_batches, text_slices, tidy, word_hashes, word_spans
from hostscope.llm.common import ship, shipped, written

#: Classes of tokens: one for the edge of a text, the most frequent words, and tails of all other words by hash.
HEAD, TAILS = 191, 64
CLASSES = 1 + HEAD + TAILS
#: A class is predicted in two steps: its group, then its place in the group.
GROUP = 16
GROUPS = CLASSES // GROUP
#: At most so many of the most frequent words are sent to all tasks with their counts; the others' are joined.
SENT_WORDS = 1 << 18
#: Words seen on each side, width of a word's vector and of the hidden layer.
SIDE, WIDTH, HIDDEN = 2, 12, 24
#: Each round trains on one in ROUNDS positions, other positions each time: all of them once in the end.
ROUNDS, STEP = 3, 1024
RATE = 0.05
#: Texts are dealt to shards of about so many words by their own hash; a shard is trained on in the order of the hash.
SHARD_WORDS = 1 << 20


class Vocabulary:
    """The HEAD most frequent words of the whole corpus, by rank, and its bytes' log-probabilities."""

    def __init__(self, ranked: list[int], byte_counts: np.ndarray):
        words = np.array(ranked, np.uint64)
        order = np.argsort(words)
        self.words, self.rank = words[order], order
        #: A word is spelt with its bytes (A-Z lower-cased) and an end; white space counts as the end.
        low = np.bincount(LOWER, byte_counts, 256) + 1
        end = low[SPACES].sum()
        low[SPACES] = 1
        self.spell, self.end = np.log(low / (low.sum() + end)), math.log(end / (low.sum() + end))

    def classes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token classes of all texts, each between SIDE edges; where each text's own tokens begin (with an end); words' hashes."""
        starts, ends, first = word_spans(data, offsets)
        h = word_hashes(data, starts, ends, lower=True)
        own = 1 + HEAD + (h % np.uint64(TAILS)).astype(np.int64)
        if len(self.words):
            place = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            own = np.where(self.words[place] == h, 1 + self.rank[place], own)
        n = np.diff(first)
        out = np.zeros(len(own) + 2 * SIDE * len(n), np.uint8)
        begin = first[:-1] + 2 * SIDE * np.arange(len(n)) + SIDE
        out[np.repeat(begin - first[:-1], n) + np.arange(len(own))] = own
        return out, np.append(begin, len(out) + SIDE), h

    def spelt(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The log-probability of each word as a string of bytes."""
        upto = np.concatenate(([0.0], np.cumsum(self.spell[LOWER[data]])))
        return upto[ends] - upto[starts] + self.end


def _counts(batches):
    for batch in batches:
        for *_, data, offsets in text_slices(batch):
            starts, ends, _ = word_spans(data, offsets)
            word, n = np.unique(word_hashes(data, starts, ends, lower=True), return_counts=True)
            letters = np.bincount(data, minlength=256)
            kind = np.repeat(np.array([0, 1], np.int8), [len(word), 256])
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int8()), pa.array(np.concatenate((word.view(np.int64), np.arange(256))), pa.int64()), pa.array(np.concatenate((n, letters)), pa.int64())], ["kind", "word", "n"])


def vocabulary(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """Head words and byte frequencies of the whole corpus; and the counts of all words: word, n."""
    both = written(docs.select("text").mapInArrow(tidy(_counts), "kind tinyint, word long, n long").groupBy("kind", "word").agg(F.sum("n").alias("n")), "lm-words")
    sums = both.where("kind = 0").select("word", "n")
    top = sums.orderBy(F.desc("n"), "word").limit(HEAD).collect()
    letters = np.zeros(256)
    for r in both.where("kind = 1").collect():
        letters[r.word] = r.n
    return Vocabulary([r[0] & (1 << 64) - 1 for r in top], letters), sums


def _tail(word):
    """The tail of a word's hash as Spark holds it (signed)."""
    return word.bitwiseAND(F.lit(TAILS - 1))


def within_tails(head: Vocabulary, sums: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What p(word | class) needs: distinct words and all tokens of each tail; the most frequent words and their counts.

    A head word is the only one of its class. In a tail of N tokens and T words (at least 1), a word of n tokens has
    n / (N + T), and all words that the corpus does not hold have T / (N + T) together, shared out by their spelling.
    """
    own = head.words.view(np.int64).tolist()
    rest = sums.where(~F.col("word").isin(own)) if own else sums
    kinds, tokens = np.ones(TAILS), np.zeros(TAILS)
    for r in rest.groupBy(_tail(F.col("word")).alias("tail")).agg(F.count("*").alias("kinds"), F.sum("n").alias("tokens")).collect():
        kinds[r.tail], tokens[r.tail] = r.kinds, r.tokens
    level = F.floor(F.log2("n") * 8)
    least, many = None, 0
    for r in sorted(rest.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect(), key=lambda r: -r.level):
        many += r.words
        if many > SENT_WORDS:
            break
        least = r.least
    if least is None:
        return kinds, tokens, np.zeros(0, np.uint64), np.zeros(0)
    sent = rest.where(F.col("n") >= least).toArrow()
    word, n = sent.column("word").to_numpy().view(np.uint64), sent.column("n").to_numpy().astype(np.float64)
    order = np.argsort(word)
    return kinds, tokens, word[order], n[order]


def start_weights(seed: int = 3) -> list[np.ndarray]:
    """Word vectors; hidden layer and its offsets; groups and their offsets; places in each group and their offsets."""
    rng = np.random.default_rng(seed)
    shapes = [(CLASSES, WIDTH), (2 * SIDE * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, GROUPS), (GROUPS,), (GROUPS, HIDDEN, GROUP), (GROUPS, GROUP)]
    return [(rng.normal(0, 0.1, s) if k in (0, 1, 3, 5) else np.zeros(s)).astype(np.float32) for k, s in enumerate(shapes)]


_AROUND = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])


def _hidden(w, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    around = tokens[at[:, None] + _AROUND]
    x = w[0][around].reshape(len(at), -1)
    return around, x, np.tanh(x @ w[1] + w[2])


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _by_group(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings tokens of one group together, and where each group begins (with an end)."""
    order = np.argsort(own // GROUP, kind="stable")
    return order, np.searchsorted(own[order] // GROUP, np.arange(GROUPS + 1))


def log_probabilities(w, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log p(class | words on both sides) at the given places."""
    out = np.empty(len(at), np.float32)
    for a in range(0, len(at), 16384):
        some = at[a : a + 16384]
        h = _hidden(w, tokens, some)[2]
        own = tokens[some]
        order, cut = _by_group(own)
        h, own = h[order], own[order]
        p = _softmax(h @ w[3] + w[4])[np.arange(len(own)), own // GROUP]
        for g in np.flatnonzero(np.diff(cut)):
            x, y = cut[g], cut[g + 1]
            p[x:y] *= _softmax(h[x:y] @ w[5][g] + w[6][g])[np.arange(y - x), own[x:y] % GROUP]
        out[a + order] = np.log(np.maximum(p, 1e-30))
    return out


def train_on(w: list[np.ndarray], sums: list[np.ndarray], tokens: np.ndarray, at: np.ndarray) -> None:
    """Adagrad steps over the given places, in place."""
    for a in range(0, len(at), STEP):
        some = at[a : a + STEP]
        own = tokens[some]
        order, cut = _by_group(own)
        some, own = some[order], own[order]
        around, x, h = _hidden(w, tokens, some)
        p = _softmax(h @ w[3] + w[4])
        p[np.arange(len(some)), own // GROUP] -= 1
        dh = p @ w[3].T
        inner, bias = np.zeros_like(w[5]), np.zeros_like(w[6])
        for g in np.flatnonzero(np.diff(cut)):
            b, e = cut[g], cut[g + 1]
            q = _softmax(h[b:e] @ w[5][g] + w[6][g])
            q[np.arange(e - b), own[b:e] % GROUP] -= 1
            dh[b:e] += q @ w[5][g].T
            inner[g], bias[g] = h[b:e].T @ q, q.sum(axis=0)
        dh *= 1 - h * h
        cells = (around.reshape(-1, 1).astype(np.int64) * WIDTH + np.arange(WIDTH)).ravel()
        vectors = np.bincount(cells, (dh @ w[1].T).ravel(), w[0].size).reshape(w[0].shape).astype(np.float32)
        for weight, total, g in zip(w, sums, [vectors, x.T @ dh, dh.sum(axis=0), h.T @ p, p.sum(axis=0), inner, bias], strict=True):
            g = g / len(some)
            total += g * g
            weight -= RATE * g / np.sqrt(total)


def _encoded(model):
    """The classes of each text, a byte a token, edges included."""

    def run(batches):
        head = shipped(model)
        for batch in batches:
            keys = batch.column("key")
            for at, end, data, offsets in text_slices(batch):
                tokens, begin, _ = head.classes(data, offsets)
                cut = begin - SIDE
                raw = [tokens[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([keys.slice(at, end - at), pa.array(raw, pa.binary())], ["key", "tokens"])

    return run


def _packed(batches):
    """One row a shard: the strings of its texts in the order they come, joined."""
    now, held = None, []
    row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([b"".join(held)], pa.binary())], ["shard", "tokens"])
    for batch in batches:
        for shard, raw in zip(batch.column("shard").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
            if shard != now and held:
                yield row()
                held = []
            now = shard
            held.append(raw)
    if held:
        yield row()


def _train(model, nth: int):
    """Each shard trains a copy of the weights."""

    def run(batches):
        weights = shipped(model)
        for batch in batches:
            for shard, raw in zip(batch.column("shard").to_pylist(), batch.column("tokens"), strict=True):
                tokens = np.frombuffer(raw.as_buffer(), np.uint8)
                at = np.flatnonzero(tokens)[nth::ROUNDS]
                if len(at):
                    w, sums = [x.copy() for x in weights], [np.full_like(x, 1e-3) for x in weights]
                    train_on(w, sums, tokens, at)
                    flat = np.concatenate([x.ravel() for x in w])
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(at)], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["shard", "seen", "weights"])

    return run


def _mean(batches):
    """The mean of the copies that this task gets, weighted by positions seen, in the order of their shards."""
    got = sorted((shard, n, raw) for batch in batches for shard, n, raw in zip(*(batch.column(c).to_pylist() for c in ("shard", "seen", "weights")), strict=True))
    if got:
        seen = sum(n for _, n, _ in got)
        total = sum(np.frombuffer(raw, np.float32).astype(np.float64) * n for _, n, raw in got)
        yield pa.RecordBatch.from_arrays([pa.array([got[0][0]], pa.int64()), pa.array([seen], pa.int64()), pa.array([(total / seen).tobytes()], pa.binary())], ["shard", "seen", "weights"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Vocabulary, list[np.ndarray], DataFrame]:
    """Head words, weights and the counts of all words.

    Trains on every position of every text once. Texts become strings of classes, a byte a word, which are dealt to
    shards by a hash of text and id; how many shards there are follows the words of the corpus, not its layout, so the
    same rows give the same model in any number of files or tasks. In each round every shard trains from the common
    weights, then all copies are averaged, first in about the square root of their number of tasks, so the driver
    gets few of them.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    (head, sums), weights = vocabulary(texts), start_weights()
    shards = -(-(sums.agg(F.sum("n")).first()[0] or 0) // SHARD_WORDS)
    if not shards:
        return head, weights, sums
    keyed = texts.select(F.xxhash64("text", "id").alias("key"), "text").mapInArrow(tidy(_encoded(ship(spark, head))), "key long, tokens binary")
    dealt = keyed.withColumn("shard", F.pmod("key", F.lit(shards)))
    ordered = dealt.repartition(F.col("shard")).sortWithinPartitions("shard", "key", "tokens")
    held = written(ordered.mapInArrow(tidy(_packed), "shard long, tokens binary"), "lm-shards")
    kind = "shard long, seen long, weights binary"
    groups = max(1, math.isqrt(shards))
    for nth in range(ROUNDS):
        copies = held.mapInArrow(tidy(_train(ship(spark, weights), nth)), kind)
        got = sorted(map(tuple, copies.repartition(groups, F.col("shard")).mapInArrow(tidy(_mean), kind).collect()))
        if not got:
            break
        flat = sum(np.frombuffer(r[2], np.float64) * r[1] for r in got) / sum(r[1] for r in got)
        cuts = np.cumsum([x.size for x in weights])[:-1]
        weights = [x.astype(np.float32).reshape(y.shape) for x, y in zip(np.split(flat, cuts), weights, strict=True)]
    return head, weights, sums


def _listed(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(values, kind))


def _scorer(model, inside_corpus: bool):
    """Sums of log p(class | both sides), and of log p(word | class) but for the counts of words that were not sent."""

    def run(batches):
        head, w, (kinds, tokens_of, sent, sent_n) = shipped(model)
        for batch in batches:
            ids = batch.column("doc_id")
            for at, end, data, offsets in text_slices(batch):
                tokens, begin, hashes = head.classes(data, offsets)
                inside = np.flatnonzero(tokens)
                logs = log_probabilities(w, tokens, inside).astype(np.float64)
                text = np.searchsorted(begin, inside, "right") - 1
                n = np.bincount(text, minlength=end - at)
                total = np.bincount(text, logs, end - at)
                starts, ends, _ = word_spans(data, offsets)
                tail = np.flatnonzero(tokens[inside] > HEAD)
                words, one, back = np.unique(hashes[tail], return_index=True, return_inverse=True)
                spell = head.spelt(data, starts[tail[one]], ends[tail[one]])
                pairs, times = np.unique(text[tail] * max(len(words), 1) + back, return_counts=True)
                owner, word = pairs // max(len(words), 1), pairs % max(len(words), 1)
                of = (words[word] % np.uint64(TAILS)).astype(np.int64)
                # The other words of a tail: those of the corpus without this text's own.
                cell = owner * TAILS + of
                own = np.bincount(cell, times, (end - at) * TAILS) if inside_corpus else np.zeros((end - at) * TAILS)
                total -= np.bincount(owner, times * np.log(tokens_of[of] - own[cell] + kinds[of]), end - at)
                fixed = np.zeros(len(word), bool)
                if len(sent):
                    place = np.minimum(np.searchsorted(sent, words), len(sent) - 1)[word]
                    fixed = sent[place] == words[word]
                    left = sent_n[place[fixed]] - (times[fixed] if inside_corpus else 0)
                    value = np.where(left > 0, np.log(np.maximum(left, 1)), np.log(kinds[of[fixed]]) + spell[word[fixed]])
                    total += np.bincount(owner[fixed], times[fixed] * value, end - at)
                open_ = ~fixed
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, end - at), pa.array(n, pa.int64()), pa.array(total, pa.float64()), _listed(words[word[open_]].view(np.int64), owner[open_], end - at, pa.int64()),
                        _listed(times[open_], owner[open_], end - at, pa.int64()), _listed(spell[word[open_]], owner[open_], end - at, pa.float64()),
                    ],
                    ["doc_id", "n_tokens", "log_prob", "word", "times", "spell"],
                )

    return run


def score(docs: DataFrame, model=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The masked pseudo-likelihood of every document: doc_id, n_tokens, log_prob (sum), mean_log_prob.

    Every word of the whole text is predicted from the two words on either side: its class by the network, the word in
    its class by the counts of all words of the corpus, and a word that the corpus does not hold by its spelling. With
    a model fitted on these documents, a document's own words are taken out of the counts before they predict it
    (deleted estimate), so what occurs nowhere else is told from what does. Null or blank text has no tokens, sum 0 and
    a null mean; repeated rows score alike; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = model is None
    head, weights, sums = model or fit(docs, id_col, text_col)
    kinds, *rest = within_tails(head, sums)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = "doc_id long, n_tokens long, log_prob double, word array<long>, times array<long>, spell array<double>"
    found = written(rows.mapInArrow(tidy(_scorer(ship(spark, (head, weights, (kinds, *rest))), own)), kind).withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    pairs = found.select("row", F.explode(F.arrays_zip("word", "times", "spell")).alias("pair")).select("row", "pair.word", "pair.times", "pair.spell")
    fresh = F.log(F.element_at(F.array(*[F.lit(float(k)) for k in kinds]), (_tail(F.col("word")) + 1).cast("int"))) + F.col("spell")
    left = F.coalesce("n", F.lit(0)) - (F.col("times") if own else F.lit(0))
    more = pairs.join(sums, "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.when(left > 0, F.log(left.cast("double"))).otherwise(fresh)).alias("more"))
    out = found.select("row", "doc_id", "n_tokens", "log_prob").join(more, "row", "left").select("doc_id", "n_tokens", (F.col("log_prob") + F.coalesce("more", F.lit(0.0))).alias("log_prob"))
    return out.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
