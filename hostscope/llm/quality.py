"""Quality rules with risk-controlled cutoffs, in SQL functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostscope.llm.common import WORD_RE, let, with_small, words, written

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: At most this share of good documents of a stratum may be rejected by all rules together, with this confidence.
RISK = 0.05
CONFIDENCE = 0.95
#: Signals; a document above its stratum's cutoff of any of them is rejected.
RULES = ("symbols_per_char", "repeats_per_word", "dup_lines_per_word", "chars_per_word")
#: Cutoffs that are tried lie at this many equal steps of the share of good documents that a rule may reject.
STEPS = 20
#: Rejecting a share of the good documents has to reject at least this many times that share of the bad ones.
COST = 2.0
#: A cutoff that is tried is off by a share of 1 / ACCURACY in rank at most; what it rejects is counted exactly.
ACCURACY = 100_000


def _windows(w: Column) -> Column:
    """Hashes of a word array's windows of three words, in text order."""
    return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))


def repeated_words(w: Column) -> Column:
    """How many words stand in a window of three words that occurs twice or more in the array.

    Windows are compared by 64-bit hashes sorted with their places, so a text of n words costs n log n.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twin = lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))
            return F.transform(F.filter(s, twin), lambda x: x["i"])

        return let(let(placed, places), lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2)))))

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(_windows(w), count)).cast("long")


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts over each whole text: doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, text_key (a hash)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col in docs.columns else F.lit("")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), stratum.alias("stratum"), text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_RE))
    counts = let(words(F.col("_text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words"),
    ))
    rows = rows.select(
        "doc_id", "stratum", counts.alias("_c"), F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), F.xxhash64("_text").alias("text_key"),
    )
    return rows.select("doc_id", "stratum", "_c.n_words", "_c.word_chars", "n_symbols", "n_dup_lines", "_c.n_repeat_words", "text_key")


def _rate(name: str) -> Column:
    top, under = {
        "symbols_per_char": ("n_symbols", "word_chars"), "repeats_per_word": ("n_repeat_words", "n_words"),
        "dup_lines_per_word": ("n_dup_lines", "n_words"), "chars_per_word": ("word_chars", "n_words"),
    }[name]
    return F.when(F.col(under) > 0, F.col(top) / F.col(under)).otherwise(F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)


def _ln_gamma(n: Column) -> Column:
    """ln((n - 1)!) of a whole number n >= 1, to about 1e-12 (exact factorials, then Stirling's series)."""
    x = n.cast("double")
    series = (x - 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (x * 12) - 1 / (x * x * x * 360) + 1 / (F.pow(x, F.lit(5.0)) * 1260)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int") - 1).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of X ~ Bin(n, p), summed from the k-th term down; 1 where k > n p, which no test here passes."""
    top = _ln_gamma(n + 1) - _ln_gamma(k + 1) - _ln_gamma(n - k + 1) + k * F.lit(math.log(p)) + (n - k) * F.lit(math.log1p(-p))
    start = F.struct(F.lit(0.0).alias("sum"), F.exp(top).alias("term"))

    def add(s: Column, d: Column) -> Column:
        i = k - d
        down = i.cast("double") / (n - i + 1).cast("double") * F.lit((1 - p) / p)
        return F.struct((s["sum"] + s["term"]).alias("sum"), (s["term"] * down).alias("term"))

    return F.when(k > n * F.lit(p), F.lit(1.0)).otherwise(F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, add, lambda s: s["sum"]))


def cutoffs(holdout: DataFrame, rules: Sequence[str] = RULES, risk: float = RISK, confidence: float = CONFIDENCE, cost: float = COST) -> DataFrame:
    """The best safe cutoff of each rule in each stratum: stratum and a column a rule (null: the rule stays off).

    holdout: the signals of labelled documents that pass the base rules and good (true or false), each text once (copies
    are no independent draws). Cutoffs are tried at quantiles of the good ones. One is safe if the exact
    (Clopper-Pearson) upper bound of its false-rejection rate is at most risk / rules, that is, if as few rejections
    have a binomial tail probability of at most (1 - confidence) / (rules * strata) (Bonferroni). A cutoff that k of n
    draws exceed is at least their (k + 1)-th greatest, whose true rate of rejections follows the same law (a
    distribution-free tolerance bound), and looser cutoffs reject less: so the promise holds for all safe cutoffs of a
    rule at once, and choosing among them by the data needs no further correction. Of them, the one is taken that
    rejects most of the bad, where a share of the good counts ``cost`` times; rules that gain nothing stay off.
    """
    names = list(rules)
    levels = [1 - risk / len(names) * j / STEPS for j in range(STEPS + 1)]
    good = F.col("good")
    tried = F.array(*[F.percentile_approx(F.when(good, _rate(r)), levels, ACCURACY) for r in names])
    marks = written(holdout.groupBy("stratum").agg(F.count_if(good).alias("_n"), F.count_if(~good).alias("_m"), tried.alias("_cuts")).where("_n > 0"), "quality-marks")
    held = with_small(holdout, marks.select("stratum", "_cuts"), "stratum", "inner", 2000)
    places = [(i, j) for i in range(len(names)) for j in range(STEPS + 1)]
    above = lambda i, j, which: F.count_if(which & (_rate(names[i]) > F.get(F.get("_cuts", F.lit(i)), F.lit(j))))
    counts = held.groupBy("stratum").agg(F.array(*[above(i, j, good) for i, j in places]).alias("_k"), F.array(*[above(i, j, ~good) for i, j in places]).alias("_b"))
    counts = counts.join(marks, "stratum").withColumn("_alpha", F.lit(1 - confidence) / (F.count(F.lit(1)).over(Window.partitionBy()) * len(names)))
    grid = F.array(*[
        F.struct(F.lit(i).alias("rule"), F.get(F.get("_cuts", F.lit(i)), F.lit(j)).alias("cut"), F.get("_k", F.lit(at)).alias("k"), F.get("_b", F.lit(at)).alias("b")) for at, (i, j) in enumerate(places)
    ])
    tests = counts.select("stratum", "_n", "_m", "_alpha", F.inline(grid))
    gain = F.when(F.col("_m") > 0, F.col("b") / F.col("_m") - F.lit(float(cost)) * (F.col("k") / F.col("_n"))).otherwise(F.lit(0.0))
    safe = (binomial_tail(F.col("k"), F.col("_n"), risk / len(names)) <= F.col("_alpha")) & (gain > 0)
    best = [F.max(F.when(safe & (F.col("rule") == i), F.struct(gain.alias("gain"), F.col("cut")))).getField("cut").alias(f"cut_{r}") for i, r in enumerate(names)]
    return tests.groupBy("stratum").agg(F.max("_n").alias("n_holdout"), *best)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **how) -> DataFrame:
    """Signals, base rules and the risk-controlled verdict of every document.

    Returns doc_id, stratum, the signals, base_failed, n_holdout, the cutoffs and kept. labels: doc_id and quality (1
    good, others bad; null or other ids do nothing; several labels of an id, or of equal texts, count as their least). Signals are computed once, in
    one pass over the whole texts without a shuffle, and written; only these numbers meet the labels. Null or blank
    text has no words and fails the base rules; a null stratum is the stratum ''; strata without enough good labels
    reject nothing beyond the base rules; repeated rows are judged alike and count once in the holdout, as do equal
    texts; the risk is that of good documents that pass the base rules; empty tables give an empty result; other
    columns are ignored.
    """
    rows = written(signals(docs, id_col, text_col, stratum_col).withColumn("base_failed", base_failed()), "quality")
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("_q")).groupBy("doc_id").agg(F.min("_q").alias("_q")).where("_q is not null")
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    known = rows.where(~F.col("base_failed")).join(marked, "doc_id")
    known = known.groupBy("stratum", "text_key").agg((F.min("_q") == 1).alias("good"), *[F.max(c).alias(c) for c in counted])
    cuts = written(cutoffs(written(known, "quality-holdout"), **how), "quality-cutoffs")
    names = how.get("rules", RULES)
    over = F.lit(False)
    for r in names:
        over = over | F.coalesce(_rate(r) > F.col(f"cut_{r}"), F.lit(False))
    return with_small(rows, cuts, "stratum", "left", 500).select(*[c for c in rows.columns if c != "text_key"], "n_holdout", *[f"cut_{r}" for r in names], (~F.col("base_failed") & ~over).alias("kept"))
