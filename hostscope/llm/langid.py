"""Language identification of words by a linear-chain conditional random field."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.llm.arrays import BYTE_VALUES, LOWER, bounded_batches, mix64, powers, text_slices, tidy, word_hashes, word_spans
from hostscope.llm.common import holdout, ship, shipped

#: Chains end with a text and after so many words.
CHAIN = 64
#: Weights are kept in a hashed table of 2**FEATURE_BITS rows.
FEATURE_BITS = 17
#: The classifier is fitted on at most so many chains of each language.
CHAINS_PER_LANG = 1500
CHAINS_PER_DOC = 8
EPOCHS = 4
UNKNOWN = "und"
NGRAMS = (2, 3)
AFFIXES = (1, 2, 3)

#: A text without any of these has no letter: ASCII letters, or any byte of a longer character (looked at closer below).
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for each word (flat, with the number of each word's rows).

    Lexicon: the word. Affixes: its first and last 1 to 3 bytes. N-grams: all its runs of 2 and 3 bytes. A-Z count as
    a-z; the bytes of UTF-8 serve as characters.
    """
    lengths = ends - starts
    n, v = len(starts), BYTE_VALUES[LOWER]
    word = np.arange(n)
    rows, owner = [word_hashes(data, starts, ends, lower=True)], [word]
    for k in AFFIXES:
        long = np.flatnonzero(lengths >= k)
        head, tail = (sum((v[data[at[long] + i]] * powers(8)[i] for i in range(k)), np.zeros(len(long), np.uint64)) for at in (starts, ends - k))
        rows += [mix64(head + np.uint64(1000 + k)), mix64(tail + np.uint64(2000 + k))]
        owner += [long, long]
    for k in NGRAMS:
        many = np.maximum(lengths - k + 1, 0)
        own = np.repeat(word, many)
        at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + starts[own]
        rows.append(mix64(sum((v[data[at + i]] * powers(8)[i] for i in range(k)), np.zeros(len(at), np.uint64)) + np.uint64(3000 + k)))
        owner.append(own)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(rows)[order] >> np.uint64(64 - FEATURE_BITS)).astype(np.int32), np.bincount(owner, minlength=n)


def _chains(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the chains of consecutive texts of so many words."""
    many = -(-n_words // CHAIN)
    text = np.repeat(np.arange(len(n_words)), many)
    nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    first = (np.cumsum(n_words) - n_words)[text] + nth * CHAIN
    return first, np.minimum(n_words[text] - nth * CHAIN, CHAIN)


def forward_backward(scores: np.ndarray, first: np.ndarray, length: np.ndarray, trans: np.ndarray, begin: np.ndarray, pairs: bool = False):
    """Marginals of every word's label (and, for training, expected transitions and first labels) over all chains.

    scores: words x labels. All chains advance together, longest first, so a step is one small matrix product.
    """
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    steps = int(length[0]) if len(length) else 0
    alive = [int(np.searchsorted(-length, -t, "left")) for t in range(steps)]  # chains longer than t
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(trans)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    for t in range(steps):
        at = first[: alive[t]] + t
        now = e[at] * (np.exp(begin) if t == 0 else alpha[at - 1] @ a)
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    expected = np.zeros_like(a)
    for t in range(steps - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        right = e[at + 1] * beta[at + 1]
        if pairs:
            joint_sum = ((alpha[at] @ a) * right).sum(axis=1, keepdims=True)
            expected += a * (alpha[at].T @ (right / joint_sum))
        now = right @ a.T
        beta[at] = now / now.sum(axis=1, keepdims=True)
    marginal = alpha * beta
    marginal /= marginal.sum(axis=1, keepdims=True)
    return (marginal, expected, marginal[first].sum(axis=0)) if pairs else marginal


def _emissions(rows: np.ndarray, many: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if not len(many):
        return np.zeros((0, weights.shape[1]), weights.dtype)
    return np.add.reduceat(weights[rows], np.cumsum(many) - many, axis=0)


def train(chains: list[tuple[list[bytes], list[int]]], n_labels: int, epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, transitions and first-label scores by Adagrad on the exact conditional log-likelihood.

    chains: words and labels. Chains of two texts are joined at random so that transitions between languages are learnt.
    """
    rng = np.random.default_rng(seed)
    weights = np.zeros((1 << FEATURE_BITS, n_labels), np.float32)
    trans, begin = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    sq_w, sq_t, sq_b = np.full_like(weights, 1e-2), np.full_like(trans, 1.0), np.full_like(begin, 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(chains))
        for x in range(0, len(order), 128):
            some = [chains[i] for i in order[x : x + 128]]
            for i in range(0, len(some) - 1, 4):  # one pair in four exchanges its second halves
                (w1, l1), (w2, l2) = some[i], some[i + 1]
                some[i], some[i + 1] = (w1[: len(w1) // 2] + w2[len(w2) // 2 :], l1[: len(l1) // 2] + l2[len(l2) // 2 :]), (w2[: len(w2) // 2] + w1[len(w1) // 2 :], l2[: len(l2) // 2] + l1[len(l1) // 2 :])
            some = [s for s in some if s[0]]
            flat = [w for s in some for w in s[0]]
            label = np.array([y for s in some for y in s[1]])
            size = np.array([len(s[0]) for s in some])
            data = np.frombuffer(b"".join(flat), np.uint8)
            ends = np.cumsum([len(w) for w in flat])
            starts = ends - np.array([len(w) for w in flat])
            rows, many = features(data, starts, ends)
            first = np.cumsum(size) - size
            marginal, pairs, firsts = forward_backward(_emissions(rows, many, weights).astype(np.float64), first, size, trans, begin, pairs=True)
            truth = np.eye(n_labels)[label]
            diff = truth - marginal
            inner = np.ones(len(label), bool)
            inner[first] = False
            gold = np.zeros_like(trans)
            np.add.at(gold, (label[:-1][inner[1:]], label[1:][inner[1:]]), 1)
            flat_diff = np.repeat(diff, many, axis=0) / len(some)
            used, back = np.unique(rows, return_inverse=True)
            g = np.stack([np.bincount(back, flat_diff[:, k], len(used)) for k in range(n_labels)], 1).astype(np.float32) - 1e-5 * weights[used]
            sq_w[used] += g * g
            weights[used] += 0.3 * g / np.sqrt(sq_w[used])
            g = (gold - pairs) / len(some)
            sq_t += g * g
            trans += 0.2 * g / np.sqrt(sq_t)
            g = (truth[first].sum(axis=0) - firsts) / len(some)
            sq_b += g * g
            begin += 0.2 * g / np.sqrt(sq_b)
    return weights, trans, begin


def _sample_chains(batches):
    """Up to CHAINS_PER_DOC chains of each text, chosen by hash: lang, order, words."""
    for batch in batches:
        langs, out = batch.column("lang").to_pylist(), ([], [], [])
        for at, end, data, offsets in text_slices(batch):
            starts, ends, first = word_spans(data, offsets)
            raw = data.tobytes()
            for i in range(at, end):
                a, b = first[i - at], first[i - at + 1]
                chains = [(int(mix64(np.array([c * 7919 + int(ends[b - 1])], np.uint64))[0] >> np.uint64(1)), c) for c in range(a, b, CHAIN)]
                for order, c in sorted(chains)[:CHAINS_PER_DOC]:
                    out[0].append(langs[i])
                    out[1].append(order)
                    out[2].append(raw[starts[c] : ends[min(c + CHAIN, b) - 1]])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["lang", "ord", "words"])


def _predictor(model):
    def run(batches):
        langs, weights, trans, begin = shipped(model)
        for batch in batches:
            pred, score = [], []
            for at, end, data, offsets in text_slices(batch):
                starts, ends, first = word_spans(data, offsets)
                n_words = np.diff(first)
                hashes = word_hashes(data, starts, ends, lower=True)
                _, one, back = np.unique(hashes, return_index=True, return_inverse=True)
                emitted = _emissions(*features(data, starts[one], ends[one]), weights)
                marginal = forward_backward(emitted[back], *_chains(n_words), trans, begin)
                # Words without a letter (ASCII, or part of a longer character) say nothing about the text.
                voice = np.add.reduceat(_ASCII_LETTER[data] | (data >= 128), starts) > 0 if len(starts) else np.zeros(0, bool)
                total = np.zeros((end - at, len(langs)))
                text = np.repeat(np.arange(end - at), n_words)
                for k in range(len(langs)):
                    total[:, k] = np.bincount(text[voice], marginal[voice, k], end - at)
                mass = total.sum(axis=1)
                best = total.argmax(axis=1)
                letters = np.add.reduceat(np.append(_ASCII_LETTER[data], False).astype(np.int64), np.minimum(offsets[:-1], len(data)))
                letters[np.diff(offsets) == 0] = 0
                for i in range(end - at):
                    if mass[i] > 0 and (letters[i] or has_letter(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))):
                        pred.append(langs[best[i]])
                        score.append(float(min(1.0, total[i, best[i]] / mass[i])))
                    else:
                        pred.append(UNKNOWN)
                        score.append(0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", chains_per_lang: int = CHAINS_PER_LANG):
    """Fits the field on at most chains_per_lang chains of each language of the learnable rows; None without any.

    Documents are chosen by a hash of id and text at a rate that gives about the wanted chains, so the sample stays the
    same size whatever the table and however many copies a text has; equal chains count once. The sample alone goes to
    the driver (chains of at most 64 words).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~holdout(F.col("doc_id")))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    rate = F.element_at(F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, chains_per_lang / (4 * n))))]), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < rate * 1_000_000)
    sample = chosen.select("lang", "text").mapInArrow(tidy(_sample_chains), "lang string, ord long, words binary").dropDuplicates(["lang", "words"])
    got: dict[str, list] = {}
    for lang, _, raw in sorted(map(tuple, sample.collect()), key=lambda r: (r[0], r[1], bytes(r[2]))):
        if len(held := got.setdefault(lang, [])) < chains_per_lang:
            held.append(bytes(raw).split())
    langs = sorted(counts)
    chains = [(w, [langs.index(lang)] * len(w)) for lang in langs for w in got.get(lang, [])]
    return (langs, *train(chains, len(langs)))


def identify(docs: DataFrame, model=None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The language of every document: doc_id, held_out, lang_pred, score.

    Every word of the whole text gets label probabilities by forward-backward over chains of up to 64 words; the
    document's language is the one with the greatest sum over words that hold a letter, its score that sum's share.
    Null, blank or letterless text is ``und`` with score 0; so is all if there is nothing to learn from; ties go to
    the first language in code-point order; repeated rows get equal answers; an empty table gives an empty result;
    other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    model = model or fit(docs, id_col, text_col, lang_col)
    held = holdout(F.col("doc_id"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", held.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    out = rows.mapInArrow(tidy(_predictor(ship(docs.sparkSession, model))), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
