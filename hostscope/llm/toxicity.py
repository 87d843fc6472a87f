"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max index of all their terms."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.llm.arrays import SPACES, bounded_batches, text_slices, tidy, word_hashes, word_spans
from hostscope.llm.common import holdout, ship, shipped, with_small, written

#: The classifier is fitted on at most about so many labelled rows of each class.
EXAMPLES_PER_CLASS = 4000
NEIGHBOURS = 32
#: Terms in more than this share of the examples are kept as a matrix with maxima by block, the others as postings.
DENSE_SHARE = 0.05
#: Examples in a block, and blocks that each text looks into before bounds decide.
BLOCK, FIRST_BLOCKS = 64, 3
#: Texts, and bytes of texts, searched at once (one longer text by itself): they bound the postings that are held.
AT_ONCE, AT_ONCE_BYTES = 256, 1 << 18
#: Pseudo-examples that draw a term's relevance to 1.
SMOOTH = 10.0
#: Votes of neighbours count by cosine to this power; the prior has the weight of one vote at PRIOR_COSINE.
POWER = 1.0
PRIOR_COSINE = 0.3

_EDGE = SPACES.copy()
_EDGE[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def counted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of some whole texts, sorted; and (text, place of the term, 1 + log count), once a text and term, by text.

    A term is a word (A-Z lower-cased, ASCII marks at both ends cut), named by a 64-bit hash.
    """
    starts, ends, first = word_spans(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    inner = np.append(np.flatnonzero(~_EDGE[data]), len(data))  # bytes that no word begins or ends without
    last = inner[np.searchsorted(inner, ends) - 1] + 1
    starts = inner[np.searchsorted(inner, starts)]
    ends = np.where(starts < ends, last, starts)
    on = starts < ends
    if not on.all():
        starts, ends, text = starts[on], ends[on], text[on]
    found, back = np.unique(word_hashes(data, starts, ends, lower=True), return_inverse=True)
    pairs, count = np.unique(text * max(len(found), 1) + back, return_counts=True)
    return found, pairs // max(len(found), 1), pairs % max(len(found), 1), 1 + np.log(np.maximum(count, 1))


def _lookup(vocabulary: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of terms in a sorted vocabulary, and which of them it holds."""
    place = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
    return place, vocabulary[place] == found


def _example_terms(batches):
    for batch in batches:
        ids, label = batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist()
        for at, end, data, offsets in text_slices(batch):
            found, doc, place, tf = counted(data, offsets)
            cuts = np.searchsorted(doc, np.arange(end - at + 1))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at:end], pa.int64()), pa.array(label[at:end], pa.int32()), pa.array([found[place[a:b]].tobytes() for a, b in spans], pa.binary()), pa.array([tf[a:b].astype(np.float32).tobytes() for a, b in spans], pa.binary())],
                ["doc_id", "toxic", "terms", "tf"],
            )


_COUNTED = "task long, n long, df binary, key long, term long, tf double"


def _text_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each whole text."""
    raw, cut = data.tobytes(), offsets.tolist()
    return np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], np.uint64).view(np.int64)


def _frequencies(model):
    """Documents of this task, and how many of them hold each term of the vocabulary; and, as rows of their own, the
    terms of each text that the vocabulary lacks (key, term, tf)."""

    def run(batches):
        vocabulary = shipped(model)
        df, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for *_, data, offsets in text_slices(batch):
                found, doc, place, tf = counted(data, offsets)
                at, known = _lookup(vocabulary, found)
                df[at[known]] += np.bincount(place, minlength=len(found))[known]
                other = np.flatnonzero(~known[place])
                if len(other):
                    key, term = _text_keys(data, offsets)[doc[other]], found[place[other]].view(np.int64)
                    none = pa.nulls(len(other), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(other), pa.binary()), pa.array(key), pa.array(term), pa.array(tf[other])], ["task", "n", "df", "key", "term", "tf"])
        if n:
            last = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary()), *last], ["task", "n", "df", "key", "term", "tf"])

    return run


def _other_norms(terms: DataFrame, n_all: int) -> DataFrame:
    """(key, other): of each text, the squared weights of the terms that no example holds; copies of a text are counted
    before they are sent, and a term's documents are counted over the whole table."""
    own = written(terms.groupBy("key", "term").agg(F.count(F.lit(1)).alias("copies"), F.max("tf").alias("tf")), "toxicity-terms")
    many = own.groupBy("term").agg(F.sum("copies").alias("df"))
    weight = F.col("tf") * (F.log(F.lit(1.0 + n_all) / (1 + F.col("df"))) + 1)
    return written(own.join(many, "term").groupBy("key").agg(F.sum(weight * weight).alias("other")), "toxicity-norms")


def _summed(batches):
    total, n = None, 0
    for batch in batches:
        for more, raw in zip(batch.column("n").to_pylist(), batch.column("df").to_pylist(), strict=True):
            df = np.frombuffer(raw, np.int64)
            total, n = df if total is None else total + df, n + more
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "n", "df"])


class BlockMaxIndex:
    """Weighted terms of the examples: postings of the rarer terms; a matrix of the frequent ones, with maxima by block.

    Examples with alike frequent terms stand in one block, so that the maxima of a block say much about its examples.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(vectors)
        example = np.repeat(np.arange(self.n), [len(v[0]) for v in vectors])
        term = np.concatenate([v[0] for v in vectors]).astype(np.int64) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([v[1] for v in vectors]).astype(np.float32) if vectors else np.zeros(0, np.float32)
        frequent = np.flatnonzero(np.bincount(term, minlength=n_terms) > max(DENSE_SHARE * self.n, 1))
        self.column = np.full(n_terms, -1, np.int32)
        self.column[frequent] = np.arange(len(frequent))
        strongest, most = np.zeros(self.n, np.int64), np.zeros(self.n, np.float32)
        dense = np.flatnonzero(self.column[term] >= 0)
        by_weight = dense[np.argsort(weight[dense], kind="stable")]
        strongest[example[by_weight]], most[example[by_weight]] = self.column[term[by_weight]], weight[by_weight]
        #: number: the example at each place of the index; place: the other way round.
        self.number = np.lexsort((most, strongest))
        self.place = np.empty(self.n, np.int64)
        self.place[self.number] = np.arange(self.n)
        order = np.lexsort((self.place[example], term))
        self.at, self.weight = self.place[example[order]].astype(np.int32), weight[order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))
        self._dense = self._most = None

    def __getstate__(self):
        return vars(self) | {"_dense": None, "_most": None}

    def _matrices(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the frequent terms by place, filled up to whole blocks; and the greatest of each block."""
        if self._dense is None:
            frequent = np.flatnonzero(self.column >= 0)
            blocks = -(-max(self.n, 1) // BLOCK)
            dense = np.zeros((len(frequent), blocks * BLOCK), np.float32)
            at, of = _spans(self.first[frequent], self.first[frequent + 1])
            dense[of, self.at[at]] = self.weight[at]
            self._most = dense.reshape(len(frequent), blocks, BLOCK).max(axis=2)
            self._dense = dense
        return self._dense, self._most

    def nearest_of(self, text: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, example, cosine) of the k examples of greatest cosine above 0 of each of n texts. Exact.

        Rarer terms are added up from their postings. A block's frequent terms are looked up only if their maxima and
        the block's best sum so far can still reach the k-th best cosine known, that is, after the FIRST_BLOCKS blocks of
        greatest bound. By text, greatest first; cosines are compared at 6 decimals, ties go to the lower number.
        skip: an example that each text does not see, or -1.
        """
        dense, most = self._matrices()
        width, blocks = dense.shape[1], most.shape[1]
        column = self.column[terms]
        on = column >= 0
        query = np.zeros((n, len(dense)), np.float32)
        query[text[on], column[on]] = weights[on]
        rare, own = terms[~on], text[~on]
        at, of = _spans(self.first[rare], self.first[rare + 1])
        cosine = np.bincount(own[of] * width + self.at[at], weights[~on][of] * self.weight[at], n * width).astype(np.float64, copy=False).reshape(n, blocks, BLOCK)
        bound = cosine.max(axis=2) + query @ most + 1e-5
        unseen = np.ones((n, blocks), bool)
        lead = np.argpartition(-bound, min(FIRST_BLOCKS, blocks) - 1, axis=1)[:, :FIRST_BLOCKS]

        def look(which: np.ndarray) -> None:
            for b in np.flatnonzero(which.any(axis=0)):
                some = np.flatnonzero(which[:, b])
                cosine[some, b] += query[some] @ dense[:, b * BLOCK : (b + 1) * BLOCK]
            unseen[which] = False

        chosen = np.zeros((n, blocks), bool)
        np.put_along_axis(chosen, lead, True, axis=1)
        look(chosen)
        flat = cosine.reshape(n, width)
        if skip is not None:
            some = np.flatnonzero(skip >= 0)
            flat[some, self.place[skip[some]]] = -1
        # Sums so far bound all cosines from below, so the k-th greatest of them bounds the k-th best cosine.
        least = np.partition(flat, -k, axis=1)[:, -k] if width > k else np.zeros(n)
        look(unseen & (bound >= np.maximum(least, 0)[:, None]))
        if skip is not None:
            flat[some, self.place[skip[some]]] = -1
        flat[np.repeat(unseen, BLOCK, axis=1)] = -1
        np.round(flat, 6, out=flat)
        least = np.partition(flat, -k, axis=1)[:, -k] if width > k else np.zeros(n)
        of, place = np.nonzero((flat >= least[:, None]) & (flat > 0))
        example, found = self.number[place], flat[of, place]
        order = np.lexsort((example, -found, of))
        of, example, found = of[order], example[order], found[order]
        best = np.arange(len(of)) - np.searchsorted(of, of) < k
        return of[best], example[best], found[best]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> list[tuple[float, int]]:
        """The same of one text: (cosine, example)."""
        _, example, cosine = self.nearest_of(np.zeros(len(terms), np.int64), np.asarray(terms), np.asarray(weights, np.float64), 1, k, np.array([skip]))
        return [(float(c), int(i)) for c, i in zip(cosine, example, strict=True)]


def _spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges [start, stop), and the range of each."""
    many = stop - start
    of = np.repeat(np.arange(len(many)), many)
    return np.arange(len(of)) + np.repeat(start - (np.cumsum(many) - many), many), of


def relevance(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """A weight of 1 or so for most terms, and more the likelier a term is in toxic than in clean examples (tf-idf-rf)."""
    p = n_toxic / (n_toxic + n_clean)
    return np.log2(1 + (toxic + SMOOTH * p) / n_toxic / ((clean + SMOOTH * (1 - p)) / n_clean))


def votes(text: np.ndarray, example: np.ndarray, cosine: np.ndarray, n: int, labels: np.ndarray, worth: np.ndarray, prior: float) -> np.ndarray:
    """Each text's share of toxic neighbours, each weighing its cosine to a power times its worth, with a prior vote."""
    own, w = PRIOR_COSINE**POWER, cosine**POWER * worth[example]
    return (np.bincount(text, w * labels[example], n) + own * prior) / (np.bincount(text, w, n) + own)


def calibrate(raw: np.ndarray, label: np.ndarray, worth: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the logit of raw votes, by Newton steps on weighted examples."""
    x = np.log(np.clip(raw, 1e-4, 1 - 1e-4) / (1 - np.clip(raw, 1e-4, 1 - 1e-4)))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        v = worth * p * (1 - p)
        g = np.array([np.sum(worth * (label - p) * x) - 1e-2 * (a - 1), np.sum(worth * (label - p)) - 1e-2 * b])
        h = np.array([[np.sum(v * x * x) + 1e-2, np.sum(v * x)], [np.sum(v * x), np.sum(v) + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(values, kind))


def _nearest(batch, model, number: dict[int, int]):
    """(ids, key of each text, norm of its known terms, squares of its others, text, example, cosine) of pieces of a
    batch: the nearest examples of each text, itself left out, by the cosine of its known terms."""
    vocabulary, weigh, index, _ = model
    docs = batch.column("doc_id").to_pylist()
    for at, end, data, offsets in text_slices(batch, size=AT_ONCE_BYTES):
        for a in range(0, end - at, AT_ONCE):
            b = min(a + AT_ONCE, end - at)
            piece, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            found, doc, place, tf = counted(piece, cuts)
            where, known = _lookup(vocabulary, found)
            on = known[place]
            text, term = doc[on], where[place[on]]
            weight = tf[on] * weigh[term]
            norm = np.sqrt(np.bincount(text, weight * weight, b - a))
            own = docs[at + a : at + b]
            not_seen = np.array([number.get(d, -1) for d in own], np.int64)
            near = index.nearest_of(text, term, weight / norm[text], b - a, NEIGHBOURS, not_seen)
            yield own, _text_keys(piece, cuts), norm, np.bincount(doc[~on], tf[~on] ** 2, b - a), *near


def _numbers(model) -> dict[int, int]:
    return {d: i for i, d in enumerate(model[3].tolist())}


def _left_out(model):
    """Of each example, the nearest other examples."""

    def run(batches):
        model_ = shipped(model)
        number = _numbers(model_)
        for batch in batches:
            for own, *_, text, example, cosine in _nearest(batch, model_, number):
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), _lists(example, text, len(own), pa.int32()), _lists(cosine, text, len(own), pa.float64())], ["doc_id", "near", "cosine"])

    return run


def _scored(model, judged):
    """Each document's votes for either side, by the cosine of its known terms, and what is needed to put its norm right."""

    def run(batches):
        model_, (labels, worth, *_) = shipped(model), judged
        ids, number = model_[3], _numbers(model_)
        names = ["doc_id", "key", "norm", "alone", "toxic", "all", "evidence", "cosines"]
        for batch in batches:
            for own, key, norm, alone, text, example, cosine in _nearest(batch, model_, number):
                n, w = len(own), cosine**POWER * worth[example]
                shown = np.arange(len(text)) - np.searchsorted(text, text) < 5
                sums = [pa.array(x, pa.float64()) for x in (norm, alone, np.bincount(text, w * labels[example], n), np.bincount(text, w, n))]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(key), *sums, _lists(ids[example[shown]], text[shown], n, pa.int64()), _lists(cosine[shown], text[shown], n, pa.float64())], names)

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = EXAMPLES_PER_CLASS):
    """Vocabulary, weights, index, labels and calibration from at most about per_class learnable rows of each class.

    Rows are chosen by a hash of their id at a rate from the class's count, so the sample does not grow with the table.
    The index holds all terms of these rows. A term weighs its idf, from document frequencies over all documents, times
    its relevance to the label (1 for terms of no example). The norms that terms of no example add to the documents are
    a table. None without both classes.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(~holdout(F.col("doc_id")))
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * 1_000_000
    chosen = known.where(pick)
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(chosen), "doc_id"), "toxicity-examples")
    parts = rows.mapInArrow(tidy(_example_terms), "doc_id long, toxic int, terms binary, tf binary").toLocalIterator()  # less at once than collect
    got = {r[0]: r[1:] for r in parts}  # rows of one id count once
    ids = np.array(sorted(got), np.int64)
    label = np.array([got[d][0] for d in ids.tolist()], np.float64)
    if not len(ids) or label.min() == label.max():
        return None
    hashes, tfs = [np.frombuffer(got[d][1], np.uint64) for d in ids.tolist()], [np.frombuffer(got[d][2], np.float32) for d in ids.tolist()]
    vocabulary = np.unique(np.concatenate(hashes))
    if not len(vocabulary):
        return None
    places = [np.searchsorted(vocabulary, h).astype(np.int32) for h in hashes]
    del got, hashes
    texts = docs.select(text.alias("text"))
    counts = written(texts.mapInArrow(tidy(_frequencies(ship(spark, vocabulary))), _COUNTED), "toxicity-counts")
    groups = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    parts = counts.where("task is not null").select("task", "n", "df")
    sums = parts.repartition(groups, F.col("task")).mapInArrow(tidy(_summed), parts.schema).toLocalIterator()
    n_all, df = 0, np.zeros(len(vocabulary), np.int64)
    for r in sums:
        n_all, df = n_all + r[1], df + np.frombuffer(r[2], np.int64)
    other = _other_norms(counts.where("term is not null").select("key", "term", "tf"), n_all)
    held = [np.bincount(np.concatenate([p for p, y in zip(places, label, strict=True) if y == side]), minlength=len(vocabulary)) for side in (1, 0)]
    weigh = (np.log((1 + n_all) / (1 + df)) + 1) * relevance(*held, int(label.sum()), int((1 - label).sum()))
    vectors = []
    for place, tf in zip(places, tfs, strict=True):
        w = tf * weigh[place]
        vectors.append((place, (w / np.sqrt(np.sum(w * w))).astype(np.float32)))
    index = BlockMaxIndex(vectors, len(vocabulary))
    del places, tfs, vectors
    searched = ship(spark, (vocabulary, weigh, index, ids))
    worth = np.where(label == 1, 1 / share[1], 1 / share[0])
    worth /= worth.mean()
    prior = float(np.sum(worth * label) / np.sum(worth))
    near = {r[0]: (r[1], r[2]) for r in rows.mapInArrow(tidy(_left_out(searched)), "doc_id long, near array<int>, cosine array<double>").toLocalIterator()}
    of = np.repeat(np.arange(len(ids)), [len(near[d][0]) for d in ids.tolist()])
    example, cosine = (np.concatenate([np.array(near[d][j], kind) for d in ids.tolist()]) for j, kind in ((0, np.int64), (1, np.float64)))
    raw = votes(of, example, cosine, len(ids), label, worth, prior)
    return searched, (label, worth, prior, calibrate(raw, label, worth)), other, n_all


def score(docs: DataFrame, labels: DataFrame, model=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The toxicity of every document: doc_id, held_out, score, predicted, evidence, cosines.

    Vectors are of whole texts and all their terms: those that no example holds can't match, but lengthen the text by
    their idf. A document that is an example itself is not among its own neighbours. The 32 nearest examples vote by
    their cosine, calibrated on examples that do not see themselves. evidence: ids of the five nearest labelled
    examples, nearest first, with their cosines. Null, blank and termless texts, and those without a term of any
    example, have no neighbours and get the calibrated prior; without learnable examples of both classes all scores
    are 0; of rows with one id and different texts one is the example; repeated rows score alike; ties go to the lower
    id; an empty table gives an empty result; other columns are ignored. Under a model of other documents, a term that
    neither they nor the examples hold counts as one of a single document.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = model or fit(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = holdout(F.col("doc_id"))
    if model is None:
        return rows.select("doc_id", held.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.array().cast("array<bigint>").alias("evidence"), F.array().cast("array<double>").alias("cosines"))
    searched, judged, other, n_all = model
    kind = "doc_id long, key long, norm double, alone double, toxic double, all double, evidence array<long>, cosines array<double>"
    found = with_small(written(rows.mapInArrow(tidy(_scored(searched, judged)), kind), "toxicity-votes"), other, "key", "left", 32)
    single = (math.log((1 + n_all) / 2) + 1) ** 2
    square = F.col("norm") * F.col("norm")
    share = F.when(square > 0, F.sqrt(square / (square + F.coalesce("other", F.col("alone") * single)))).otherwise(0.0)
    found = found.withColumn("share", share)
    _, _, prior, (slope, offset) = judged
    own, by = PRIOR_COSINE**POWER, F.pow("share", F.lit(POWER))
    raw = F.greatest(F.least((by * F.col("toxic") + own * prior) / (by * F.col("all") + own), F.lit(1 - 1e-4)), F.lit(1e-4))
    logit = F.greatest(F.least(slope * F.log(raw / (1 - raw)) + offset, F.lit(30.0)), F.lit(-30.0))
    out = found.withColumn("score", 1 / (1 + F.exp(-logit)))
    cosines = F.transform("cosines", lambda c: c * F.col("share"))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", cosines.alias("cosines"))
