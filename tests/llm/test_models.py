"""SentencePiece, n-gram join, token store, scoring and classifiers against brute force, round trips and held-out rows."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostscope.llm import arrays, common, components, langid, lm, ngram_join, pieces, queries, token_store, toxicity
from hostscope.llm.arrays import word_hashes, word_spans

PIECES = [("<unk>", 0.0, "unknown"), ("<s>", 0.0, "control"), *[(f"<0x{b:02X}>", -100.0, "byte") for b in range(256)], ("▁", -4.0, "normal"), ("▁▁", -5.0, "normal"), ("a", -3.0, "normal"), ("b", -3.5, "normal"), ("ab", -4.1, "normal"), ("▁a", -2.5, "normal"), ("abab", -7.0, "normal"), ("é", -6.0, "normal")]


def viterbi(model, text):
    """The best score of a text by plain dynamic programming over characters."""
    t = (" " + text) if text else ""
    scores = {p.replace("▁", " "): s for p, s, k in PIECES if k == "normal"} if model is None else model
    worst = min(scores.values()) - 10
    best = [0.0] + [-1e18] * len(t)
    for i in range(len(t)):
        for j in range(i + 1, min(len(t), i + 16) + 1):
            if t[i:j] in scores:
                best[j] = max(best[j], best[i] + scores[t[i:j]])
        if t[i] not in scores:
            best[i + 1] = max(best[i + 1], best[i] + worst)
    return best[-1]


def score_of(p, ids, text):
    """The score of ids: runs of byte pieces are unknown characters."""
    total, lost = 0.0, b""
    for i in ids:
        if i in set(p.byte_ids.tolist()):
            lost += p.bytes_of[i]
        else:
            total += float(p.scores[i])
    return total + len(lost.decode()) * float(p.unknown_score)


@pytest.mark.parametrize("text", ["", "a", "ab abab", "  a  b ", "zé▁ab", "漢 a🙂", "abababab" * 50, " ", "\n\t", "a\nb"])
def test_best_path_and_round_trip(text):
    p = pieces.Pieces(PIECES)
    ids = p.encode([text], {})[0].tolist()
    assert p.decode(ids) == text
    assert score_of(p, ids, text) == pytest.approx(viterbi(None, text), abs=1e-3)


def test_public_vocabulary(make, odd):
    out = pieces.encode_documents(make(odd))
    assert all(r.round_trip for r in out.select("round_trip").collect())
    import public_tokenizers

    p = pieces.Pieces.from_file(public_tokenizers.path(pieces.MODEL))
    scores = {p.bytes_of[i].decode(): float(p.scores[i]) for i in range(len(p.scores)) if p.trie.value.max() >= 0 and p.bytes_of[i] and i not in set(p.byte_ids.tolist())}
    for r in out.where("n_tokens < 400").collect():
        text = {i: t for i, t, *_ in odd}[r.doc_id]
        assert score_of(p, r.ids, text) == pytest.approx(viterbi(scores, text or ""), rel=1e-6)
    assert pieces.encode_documents(make([])).count() == 0


def test_double_array_holds_its_keys():
    keys = {bytes([i, j]): i * 7 + j for i in range(1, 60) for j in range(1, 9)} | {bytes([i]): 1000 + i for i in range(1, 60)}
    trie = pieces.DoubleArray(keys)
    for key, value in keys.items():
        data = np.frombuffer(key, np.uint8)
        at, size, found = trie.matches(data, np.array([0]), np.array([len(data)]))
        assert (len(key), value) in list(zip(size.tolist(), found.tolist(), strict=True))


def brute_components(rows):
    import re

    lower = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows(seed, n_base=12, copies=14, words=90):
    """Chains and clusters of near copies over shared passages, short texts included."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{k}" for k in range(700)]
    passage = [vocab[k] for k in rng.integers(0, 700, 40)]
    rows, at = [], 0
    for _ in range(n_base):
        size = int(rng.choice([3, 4, 5, 6, 7, 8, 12, 30, words, words, 3 * words]))
        base = [vocab[k] for k in rng.integers(0, 700, size)]
        if rng.random() < 0.5:
            base = passage + base
        now = list(base)
        for _ in range(copies):
            at += 1
            rows.append((at, " ".join(now)))
            now = list(base if rng.random() < 0.5 else now)
            for _ in range(int(rng.integers(0, 4))):
                now[int(rng.integers(0, len(now)))] = vocab[int(rng.integers(0, 700))]
            if rng.random() < 0.3:
                now.append("more")
    return rows


@pytest.mark.parametrize("frequent", [64, 3])
def test_ngram_join_finds_all_components(make, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "FLUSH_TOKENS", 4000)
    rows = near_rows(frequent) + [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "one two three"), (906, "x" * 9000)]
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(make(rows).repartition(4)).collect()}
    assert out == brute_components(rows)


@pytest.mark.parametrize("seed", [11, 12])
def test_ngram_join_of_a_cluster_without_its_original(make, monkeypatch, seed):
    """Copies of one text that differ from it so much that some link with each other and others don't."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 8)
    rng = np.random.default_rng(seed)
    base, rows = [f"w{k}" for k in rng.integers(0, 500, 100)], []
    for i in range(150):
        now = list(base) + [f"t{k}" for k in rng.integers(0, 30, int(rng.integers(0, 12)))]
        for _ in range(int(rng.integers(1, 5))):
            now[int(rng.integers(0, 100))] = f"e{int(rng.integers(0, 3))}"
        rows.append((i, " ".join(now)))
    want = brute_components(rows)
    assert 1 < len({root for _, root in want.values()}) < 150
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(make(rows).repartition(3)).collect()} == want


def test_ngram_join_tests_pairs_in_proportion_to_its_groups(make, monkeypatch):
    """One passage in all documents and one large group of near copies: pairs follow the documents, not their square."""
    tested = []

    def counted(df, what):
        out = common.written(df, what)
        if what in ("ngram-pairs", "ngram-members"):
            tested.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    made = []
    for n in (300, 1200):
        rng = np.random.default_rng(n)
        word = lambda k: [f"v{x}" for x in rng.integers(0, 10**6, k)]  # noqa: E731, B023
        passage, base, rows = word(60), word(140), []
        for i in range(n):
            rows.append((2 * i, " ".join(passage + word(int(rng.integers(5, 60))))))
            near = list(base)
            for _ in range(int(rng.integers(0, 6))):
                near[int(rng.integers(0, 140))] = word(1)[0]
            rows.append((2 * i + 1, " ".join(near)))
        tested.clear()
        out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(make(rows)).collect()}
        if n == 300:
            assert out == brute_components(rows)
        made.append(sum(tested))
    assert made[1] < 8 * made[0] and made[1] < 20 * 2400


def test_ngram_join_of_odd_tables(make, odd):
    assert ngram_join.near_duplicates(make([])).count() == 0
    out = ngram_join.near_duplicates(make(odd)).collect()
    assert len(out) == len(odd)
    assert {r.component_id for r in out if r.doc_id in (5, 6, 7)} == {5}


def test_signatures_of_matching_sets_meet():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(3, 400))
        x = rng.choice(10**6, n, replace=False).astype(np.uint64)
        drop = int(rng.integers(0, n // 8 + 1))
        y = np.concatenate([x[drop:], rng.integers(10**7, 10**8, int(rng.integers(0, max(1, n // 8)))).astype(np.uint64)])
        y = np.unique(y)
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        rate = rng.random()
        kind = lambda t: np.where((t * np.uint64(2654435761) % np.uint64(1000)) < np.uint64(int(1000 * rate)), 64, 2)
        signs = []
        for s in (x, y):
            c = kind(s)
            order = np.lexsort((s, c))
            signs.append(ngram_join.signatures(s[order], c[order], len(s) - len(s) * 25 // 100 - 1, len(s)))
        assert len(np.intersect1d(*signs))


def test_components_of_a_long_path(spark):
    rows = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (102, 101), (7, 7)]
    out = {r.ref: r.root for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert {out[k] for k in range(61)} == {0} and {out[k] for k in (100, 101, 102)} == {100}


def test_token_store(make, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(token_store.TOKENIZER))
    rows = [r for r in odd if r[0] is not None and r[0] != 6]
    out = token_store.write_and_read(make(rows).repartition(3)).orderBy("doc_id").collect()
    start = 0
    for r, (i, t, *_) in zip(out, sorted(rows, key=lambda x: x[0]), strict=True):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_store.write_and_read(make(odd)).count() == len(odd)
    assert token_store.write_and_read(make([])).count() == 0


def test_store_holds_chunks_once_and_notices_damage(spark, make):
    text = " ".join(f"word{k % 50} is here" for k in range(4000))
    store = token_store.write(make([(k, text) for k in range(20)]))
    chunks = spark.read.parquet(f"{store}/raw").where("kind = 'chunk'")
    assert chunks.count() == chunks.select("address").distinct().count()
    whole = spark.read.parquet(f"{store}/recipes").agg(F.sum("n_tokens")).first()[0]
    assert chunks.agg(F.sum("n_tokens")).first()[0] <= whole / 19
    bad = store + "-bad"
    raw = spark.read.schema(token_store._ROWS_SQL).parquet(f"{store}/raw")
    raw.withColumn("payload", F.when(F.col("kind") == "chunk", F.concat(F.col("payload"), F.lit(b"\0\0"))).otherwise(F.col("payload"))).write.partitionBy("kind").parquet(f"{bad}/raw")
    for to in (bad, bad + "2"):
        for part in ("recipes", "manifest"):
            spark.read.parquet(f"{store}/{part}").write.parquet(f"{to}/{part}")
    with pytest.raises(Exception, match="address"):
        token_store.read(spark, bad).count()
    raw.where("kind <> 'chunk' or n_tokens < 100").write.partitionBy("kind").parquet(f"{bad}2/raw")
    with pytest.raises(Exception, match="manifest"):
        token_store.read(spark, bad + "2").count()


def test_manifest_is_a_tree_whatever_the_buckets(spark, monkeypatch):
    """The one root on top is that of the roots below it, and small buckets hold every address once."""
    import hashlib

    names = [hashlib.sha256(bytes([k % 256, k // 256])).digest()[:16] for k in range(700)]
    df = spark.createDataFrame([(n,) for n in names], "address binary").repartition(3)
    monkeypatch.setattr(token_store, "LEAVES", 10)
    monkeypatch.setattr(token_store, "LEVEL_BITS", 3)
    rows = token_store.manifest(df, len(names)).collect()
    bits = sorted({r.bits for r in rows})
    assert bits == [0, 1, 4, 7] and all(sum(r.n for r in rows if r.bits == b) == 700 for b in bits)
    root = {(r.bits, r.bucket): bytes(r.root) for r in rows}
    lowest = {}
    for n in sorted(names):
        lowest.setdefault(n[0] >> 1, []).append(n)
    assert {b: token_store.merkle_root(g) for b, g in lowest.items()} == {b: r for (at, b), r in root.items() if at == 7}
    below = sorted((b, r) for (at, b), r in root.items() if at == 1)
    assert root[0, 0] == token_store.merkle_root([r for _, r in below])
    assert token_store.manifest(df.limit(0), 0).count() == 0


def test_words_of_one_hash_stay_two_words(monkeypatch):
    text = np.frombuffer(b"aa b ab aa b ccc ab c aa", np.uint8)
    starts, ends, _ = arrays.word_spans(text, np.array([0, len(text)]))
    words = bytes(text).split()
    for hashes in (token_store.word_hashes, lambda d, s, e: np.zeros(len(s), np.uint64), lambda d, s, e: (e - s).astype(np.uint64)):
        monkeypatch.setattr(token_store, "word_hashes", hashes)
        one, back = token_store.same_words(text, starts, ends)
        assert [words[one[k]] for k in back] == words


def test_store_refuses_other_vocabularies(make):
    with pytest.raises(ValueError, match="vocabulary"):
        token_store.write(make([(1, "a")]), path="/somewhere/other.json")


def test_chunks_follow_content():
    ids = np.random.default_rng(0).integers(0, 40_000, 20_000).astype(np.uint16)
    cut = lambda x: {x[a:b].tobytes() for a, b in zip([0, *e[:-1]], e, strict=True)} if (e := token_store.chunk_ends(x, np.array([0]))).size else set()
    a, b = cut(ids), cut(np.concatenate([ids[:5000], ids[5003:]]))
    assert len(a & b) >= 0.9 * len(a)


def test_checksums_combine():
    data = np.random.default_rng(0).integers(0, 256, 4000).astype(np.uint8).tobytes()
    shift = token_store._shifts(1000)
    for cut in (4, 400, 3996):
        crc = token_store.crc_times(shift[[(4000 - cut) // 4]], np.array([zlib.crc32(data[:cut])], np.uint64)) ^ np.uint64(zlib.crc32(data[cut:]))
        assert int(crc[0]) == zlib.crc32(data)


def test_word_spans_and_hashes():
    texts = ["", " a  bc\td", "x", "é ö\n", "  "]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, first = word_spans(data, np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == ["a", "bc", "d", "x", "é", "ö"]
    assert first.tolist() == [0, 0, 3, 4, 6, 6]
    assert word_hashes(data, starts, ends).tolist() == word_hashes(data, starts, ends, lower=True).tolist()


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    length = np.array([4, 1, 6])
    first = np.cumsum(length) - length
    scores, trans, begin = rng.normal(size=(11, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, pairs, _ = langid.forward_backward(scores, first, length, trans, begin, pairs=True)
    import itertools

    want, want_pairs = np.zeros((11, 3)), np.zeros((3, 3))
    for f, n in zip(first, length, strict=True):
        ways = list(itertools.product(range(3), repeat=int(n)))
        p = np.array([np.exp(begin[w[0]] + sum(scores[f + i, y] for i, y in enumerate(w)) + sum(trans[a, b] for a, b in zip(w, w[1:], strict=False))) for w in ways])
        p /= p.sum()
        for w, x in zip(ways, p, strict=True):
            for i, y in enumerate(w):
                want[f + i, y] += x
            for a, b in zip(w, w[1:], strict=False):
                want_pairs[a, b] += x
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_language_on_held_out_rows(spark, sf):
    out = queries.op8_language_id(spark, sf).join(queries.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) >= 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_language_query_by_plain_loops(spark, sf):
    """Votes and scores of whole documents: marginals of each chain by sums over states in plain Python."""
    from math import exp, log

    docs = queries.table(spark, sf, "documents")
    langs, weights, trans, begin = langid.fit(docs)
    many = range(len(langs))
    lse = lambda xs: (m := max(xs)) + log(sum(exp(x - m) for x in xs))

    def vote(text):
        words = (text or "").encode().translate(None, b"")
        words = [w for w in __import__("re").split(rb"[ \t\n\x0b\x0c\r]+", words) if w]
        total = [0.0] * len(langs)
        for c in range(0, len(words), langid.CHAIN):
            chain = words[c : c + langid.CHAIN]
            e = []
            for w in chain:
                rows, _ = langid.features(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))
                e.append([float(sum(weights[r, k] for r in rows)) for k in many])
            fwd = [[begin[k] + e[0][k] for k in many]]
            for x in e[1:]:
                fwd.append([x[k] + lse([fwd[-1][j] + trans[j, k] for j in many]) for k in many])
            bwd = [[0.0] * len(langs)]
            for x in reversed(e[1:]):
                bwd.insert(0, [lse([trans[j, k] + x[k] + bwd[0][k] for k in many]) for j in many])
            z = lse(fwd[-1])
            for w, a, b in zip(chain, fwd, bwd, strict=True):
                if any(chr(x).isalpha() if x < 128 else True for x in w):
                    for k in many:
                        total[k] += exp(a[k] + b[k] - z)
        if not any(ch.isalpha() for ch in text or "") or not sum(total):
            return "und", 0.0
        best = max(many, key=lambda k: total[k])
        return langs[best], total[best] / sum(total)

    texts = {r.doc_id: r.text for r in docs.collect()}
    out = queries.op8_language_id(spark, sf).collect()
    assert len(out) == len(texts)
    short = [r for r in out if len(texts[r.doc_id] or "") < 3000]
    assert len(short) > 100
    for r in short:
        lang, score = vote(texts[r.doc_id])
        assert r.score == pytest.approx(score, abs=1e-4) and (r.lang_pred == lang or abs(score - 0.5) < 1e-3), r.doc_id


def test_a_hot_text_does_not_flood_the_sample(spark, make, monkeypatch):
    """Half of the rows are copies of one text: its chains are learnt once, and the sample stays as small as asked for."""
    seen = []
    monkeypatch.setattr(langid, "train", lambda chains, n: seen.append(chains) or (np.zeros((1 << langid.FEATURE_BITS, n), np.float32), np.zeros((n, n)), np.zeros(n)))
    rows = [(i, "same words again " * 30 if i % 2 else f"text number {i} of its own kind", "en") for i in range(4000)]
    langid.fit(make(rows, clash=False), chains_per_lang=400)
    assert 20 < len(seen[0]) < 200 and len({b" ".join(w) for w, _ in seen[0]}) == len(seen[0])


def test_language_of_odd_rows(make, odd):
    out = {r.doc_id: r for r in langid.identify(make(odd)).collect()}
    assert all(out[k].lang_pred == "und" and out[k].score == 0 for k in (1, 2, 3))
    assert out[5].lang_pred in ("en", "de", "fr") and out[5].held_out == (zlib.crc32(b"5") % 5 == 0)
    assert all(r.lang_pred == "und" for r in langid.identify(make([(1, "text", None)])).collect())
    assert langid.identify(make([])).count() == 0


def test_nearest_is_exact():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(700):
        t = np.sort(rng.choice(60, int(rng.integers(0, 9)), replace=False))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, (w / np.linalg.norm(w)).astype(np.float32) if len(t) else w.astype(np.float32)))
    dense = np.zeros((700, 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(vectors, 60)
    for i in range(0, 700, 7):
        cosine = np.round(dense @ dense[i], 6)
        got = index.nearest(*vectors[i], 15)
        assert np.allclose([c for c, _ in got], np.sort(cosine[cosine > 0])[::-1][:15], atol=1e-5)
        assert i not in [j for _, j in index.nearest(*vectors[i], 15, skip=i)]


def test_toxicity(spark, make, odd):
    rng = np.random.default_rng(0)
    plain = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(1000):
        w = [plain[k] for k in rng.integers(0, 300, 40)]
        if i % 6 == 0:
            w[3], w[20] = "Vile,", "badword"
        rows.append((i, " ".join(w)))
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(1000)] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.score(make(rows), labels).collect()
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.evidence and max(r.cosines) <= 1.0001 for r in held if r.predicted)
    assert toxicity.score(make(odd), labels.where("doc_id is null")).where("score > 0").count() == 0
    assert toxicity.score(make([]), labels).count() == 0


def test_toxicity_neighbours_and_votes_by_brute_force(spark, make):
    """Weights, cosines, nearest examples and raw votes of whole texts, recomputed with dictionaries."""
    rng = np.random.default_rng(1)
    texts = [" ".join([f"w{k}" for k in rng.integers(0, 80, 20)] + (["Badword!"] if i % 5 == 0 else []) + [f"only{i}"]) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int")
    bags = []
    for t in texts:
        bag = defaultdict(int)
        for w in t.lower().split():
            bag[w.strip("!")] += 1
        bags.append(bag)
    learnt = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    n1 = sum(i % 5 == 0 for i in learnt)
    n0, p = len(learnt) - n1, n1 / len(learnt)

    def weight(w):
        df = sum(w in bag for bag in bags)
        a, c = sum(w in bags[i] for i in learnt if i % 5 == 0), sum(w in bags[i] for i in learnt if i % 5)
        lift = (a + 10 * p) / n1 / ((c + 10 * (1 - p)) / n0)
        return (np.log(301 / (1 + df)) + 1) * np.log2(1 + lift)

    weigh = {w: weight(w) for w in {w for bag in bags for w in bag}}
    vectors = [{w: (1 + np.log(c)) * weigh[w] for w, c in bag.items()} for bag in bags]
    norm = [np.sqrt(sum(w * w for w in x.values())) for x in vectors]
    model = toxicity.fit(make(list(enumerate(texts))), labels)
    out = {r.doc_id: r for r in toxicity.score(make(list(enumerate(texts))), labels, model).collect()}
    _, worth, prior, (slope, offset) = model[1]
    for i in range(0, 300, 7):
        want = {j: sum(w * vectors[j].get(h, 0) for h, w in vectors[i].items()) / norm[i] / norm[j] for j in learnt if j != i}
        best = sorted(want.items(), key=lambda x: (-round(x[1], 6), x[0]))[: toxicity.NEIGHBOURS]
        assert out[i].cosines == pytest.approx([c for _, c in best[:5]], abs=2e-5)
        assert out[i].cosines == pytest.approx([want[j] for j in out[i].evidence], abs=2e-5)
        own = toxicity.PRIOR_COSINE
        raw = (sum(c for j, c in best if j % 5 == 0) + own * prior) / (sum(c for _, c in best) + own)
        assert worth == pytest.approx(1) and prior == pytest.approx(p)
        assert out[i].score == pytest.approx(1 / (1 + np.exp(-(slope * np.log(raw / (1 - raw)) + offset))), abs=1e-3)


def test_terms_are_cut_at_any_number_of_marks():
    data = np.frombuffer(b"!!!!!!!!!!!!Word........... word ... it's -- (word) \xc3\xa4!", np.uint8)
    found, doc, place, tf = toxicity.counted(data, np.array([0, len(data)]))
    plain = np.frombuffer(b"word it's \xc3\xa4", np.uint8)
    same, _, _, _ = toxicity.counted(plain, np.array([0, len(plain)]))
    assert found.tolist() == same.tolist() and len(found) == 3 and sorted(np.round(np.exp(tf - 1)).tolist()) == [1, 1, 3]
    assert all(len(x) == 0 for x in toxicity.counted(np.frombuffer(b"!! ..", np.uint8), np.array([0, 5])))


def test_toxicity_under_a_model_of_other_documents(spark, make):
    """A term that the model's documents lack lengthens a text like one of a single document."""
    rows = [(i, f"w{i % 7} w{i % 11} " + ("vile" if i % 4 == 0 else "kind")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(make(rows), labels)
    out = {r.doc_id: r for r in toxicity.score(make([(9000, "w1 vile"), (9001, "w1 vile unheardof"), (9002, "unheardof")]), labels, model).collect()}
    assert out[9000].cosines[0] > out[9001].cosines[0] > 0.1 and out[9002].cosines == []


def test_toxicity_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op10_toxicity(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id", "left").select("held_out", "toxic", "predicted", "score", F.size("evidence").alias("near")).collect()
    held = [r for r in out if r.held_out and r.toxic is not None]
    assert np.mean([r.predicted for r in held if r.toxic == 1]) >= 0.87
    assert np.mean([r.predicted for r in held if r.toxic == 0]) <= 0.005
    assert np.mean([(r.score - r.toxic) ** 2 for r in held]) <= 0.02
    assert np.mean([r.near > 0 for r in out]) >= 0.95


def test_toxicity_of_odd_rows_under_a_fitted_index(spark, make, odd):
    labels = spark.createDataFrame([(r[0], int(r[0] % 3 == 0)) for r in odd if r[0] is not None and r[0] >= 100] + [(6, 1)], "doc_id long, toxic int")
    out = toxicity.score(make(odd), labels).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in odd)
    got = defaultdict(list)
    for r in out:
        assert 0 <= r.score <= 1
        got[r.doc_id].append(r)
    assert all(not got[k][0].evidence and got[k][0].score == got[1][0].score for k in (1, 2, 3, 10))
    assert got[6][0] == got[6][1] and 6 not in got[6][0].evidence and got[4][0].evidence and not got[None][0].held_out


def test_lm_prefers_what_it_has_seen(make):
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(30)]
    text = lambda: " ".join(words[(s + k) % 30] for k in range(60)) if (s := int(rng.integers(0, 30))) >= 0 else ""
    rows = [(i, " ".join([text()] * 20)) for i in range(200)]
    model = lm.fit(make(rows))
    probe = [(1, text()), (2, " ".join(rng.permutation(text().split()))), (3, None), (4, ""), (5, "only")]
    out = {r.doc_id: r for r in lm.score(make(probe), model).collect()}
    assert out[1].mean_log_prob > out[2].mean_log_prob + 0.2
    assert (out[3].n_tokens, out[3].log_prob, out[3].mean_log_prob, out[4].n_tokens, out[5].n_tokens) == (0, 0.0, None, 0, 1)
    assert lm.score(make([])).count() == 0


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_lm_tells_words_of_a_class_apart(make, monkeypatch, sent):
    monkeypatch.setattr(lm, "SENT_WORDS", sent)
    words = [f"w{k}" for k in range(2000)]
    tail = lambda w: int(word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]), lower=True)[0]) % lm.TAILS
    one = [w for w in words if tail(w) == 0]
    rows = [(i, " ".join([f"h{k}" for k in range(lm.HEAD)] * 20)) for i in range(2)] + [(9, " ".join([one[0]] * 9 + one[1:] + [w for w in words if w not in one]))]
    model = lm.fit(make(rows))
    new = next(w for k in range(10_000) if tail(w := f"new{k}") == 0)
    got = {r.doc_id: r.log_prob for r in lm.score(make([(1, one[0]), (2, one[1]), (3, new), (4, f"{one[0]} {one[1]}"), (4, None)]), model).collect() if r.n_tokens == 1}
    assert got[1] - got[2] == pytest.approx(np.log(9), abs=1e-6)
    raw = np.frombuffer(new.encode(), np.uint8)
    spelt = model[0].spelt(raw, np.array([0]), np.array([len(raw)]))[0]
    assert got[3] - got[2] == pytest.approx(np.log(len(one)) + spelt, abs=1e-6)


def lm_rows(seed=3, n=120):
    rng = np.random.default_rng(seed)
    rare = lambda k: [f"r{x}" for x in rng.integers(0, 10**7, k)]
    rows = [(i, " ".join([f"w{x}" for x in rng.zipf(1.3, 30) % 900] + rare(8))) for i in range(n)]
    return rows + [(1000 + i, t) for i, t in rows[:20]] + [(2000, None), (2001, ""), (2002, "Only"), (5, rows[5][1]), (2003, " ".join(f"w{x}" for x in rng.zipf(1.3, 20_000) % 900))]


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_lm_scores_by_brute_force(make, monkeypatch, sent):
    """Class and word probabilities of every token recomputed one at a time from the fitted weights and plain counts."""
    from collections import Counter

    monkeypatch.setattr(lm, "SENT_WORDS", sent)
    monkeypatch.setattr(lm, "SHARD_WORDS", 2000)
    rows = lm_rows()
    docs = make(rows)
    head, w, _ = lm.fit(docs)
    got = defaultdict(list)
    for r in lm.score(docs).collect():
        got[r.doc_id].append(r)
    lower = lambda t: [x.lower() for x in (t or "").split()]
    h = lambda x: int(word_hashes(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x)]))[0])
    count = Counter(x for _, t in rows for x in lower(t))
    rank = {int(x): 1 + int(r) for x, r in zip(head.words, head.rank, strict=True)}
    kind = {x: rank.get(h(x), 1 + lm.HEAD + h(x) % lm.TAILS) for x in count}
    types, tokens = Counter(), Counter()
    for x, n in count.items():
        types[kind[x]] += 1
        tokens[kind[x]] += n

    def softmax(z):
        return np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    for i, t in rows[:30] + rows[-5:-1]:
        ws = lower(t)
        c = [0, 0, *[kind[x] for x in ws], 0, 0]
        mine, my_tail = Counter(ws), Counter(kind[x] for x in ws)
        total = 0.0
        for k, x in enumerate(ws, 2):
            hidden = np.tanh(np.concatenate([w[0][c[k + d]] for d in (-2, -1, 1, 2)]) @ w[1] + w[2])
            g, m = divmod(c[k], lm.GROUP)
            total += np.log(softmax(hidden @ w[3] + w[4])[g] * softmax(hidden @ w[5][g] + w[6][g])[m])
            if c[k] > lm.HEAD:
                left = count[x] - mine[x]
                whole = tokens[c[k]] - my_tail[c[k]] + types[c[k]]
                total += np.log(left if left else types[c[k]] * np.exp(sum(head.spell[b] for b in x.encode()) + head.end)) - np.log(whole)
        r = got[i][0]
        assert (r.n_tokens, r.log_prob) == (len(ws), pytest.approx(total, rel=1e-4, abs=1e-3))
    assert got[5][0].log_prob == pytest.approx(got[5][1].log_prob, abs=1e-4) and got[2000][0].mean_log_prob is None


def test_lm_scores_do_not_depend_on_the_layout(make, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_WORDS", 3000)
    docs = make(lm_rows())
    a, b = ({(r.doc_id, r.n_tokens): r.mean_log_prob for r in lm.score(docs.repartition(k)).collect()} for k in (2, 7))
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], abs=1e-6) for k in a)


def test_lm_tells_what_occurs_twice(make):
    rows = lm_rows(7, 300)
    out = {r.doc_id: r.mean_log_prob for r in lm.score(make(rows)).collect()}
    twice, once = [out[i] for i in range(20) if i != 5], [out[i] for i in range(20, 300)]
    assert min(twice) > np.quantile(once, 0.9)


def test_lm_trains_on_every_position():
    tokens = np.array([0, 0, 5, 9, 7, 0, 0, 0, 0, 8, 0, 0], np.uint8)
    at = np.concatenate([np.flatnonzero(tokens)[nth :: lm.ROUNDS] for nth in range(lm.ROUNDS)])
    assert sorted(at.tolist()) == np.flatnonzero(tokens).tolist()


def test_lm_gradients_are_those_of_the_loss(monkeypatch):
    """A step without history moves each weight by the sign and size that finite differences give."""
    rng = np.random.default_rng(0)
    w = [x + rng.normal(0, 0.3, x.shape).astype(np.float32) for x in lm.start_weights()]
    tokens = np.array([0, 0, 5, 9, 200, 17, 5, 0, 0], np.uint8)
    at = np.flatnonzero(tokens)
    monkeypatch.setattr(lm, "RATE", 1e-3)
    start, sums = [x.astype(np.float64) for x in w], [np.full(x.shape, 1e-12) for x in w]
    moved = [x.copy() for x in start]
    lm.train_on(moved, sums, tokens, at)
    for k, index in ((0, (9, 3)), (1, (20, 4)), (2, (5,)), (3, (7, 12)), (4, (0,)), (5, (12, 3, 8)), (6, (1, 1))):
        loss = []
        for e in (1e-3, -1e-3):
            v = [x.copy() for x in start]
            v[k][index] += e
            loss.append(-float(lm.log_probabilities(v, tokens, at).astype(np.float64).mean()))
        assert np.sqrt(sums[k][index]) == pytest.approx(abs(loss[0] - loss[1]) / 2e-3, rel=0.05, abs=2e-4)


def test_lm_probabilities_add_up():
    w = lm.start_weights()
    total = sum(np.exp(lm.log_probabilities(w, np.array([0, 0, c, 9, 0, 0], np.uint8), np.array([2]))[0]) for c in range(lm.CLASSES))
    assert total == pytest.approx(1, abs=1e-4)


def test_pipeline(spark, sf):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    now, seen = docs, []
    for name, stage in c.STAGES:
        out = stage(spark, now, sf)
        if name != "sentencepiece":
            assert out.columns == docs.columns
            out = c.written(out, "test-stage")
        seen.append(out)
        now = out
    lang, exact, near, mix, last = seen
    text = lambda df: [given[r.doc_id].text for r in df.select("doc_id").collect()]
    by_text = defaultdict(list)
    for r in lang.collect():
        by_text[r.text].append(r.doc_id)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(max(v) for v in by_text.values())
    want = brute_components([(r.doc_id, r.text) for r in exact.collect()])
    assert sorted(r.doc_id for r in near.collect()) == sorted({root for _, root in want.values()})
    assert set(text(mix)) <= set(text(near))
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in mix.collect())
    assert all(r.round_trip for r in last.collect())


def test_pipeline_of_odd_rows(spark, make, odd):
    import corpus_pipeline as c

    for rows in (odd, []):
        now = make(rows)
        for _, stage in c.STAGES:
            now = c.written(stage(spark, now, ""), "test-odd")
        assert now.count() >= 0
