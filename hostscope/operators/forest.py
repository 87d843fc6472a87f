"""Isolation forests (Liu, Ting & Zhou 2008): trees are grown in parallel on hashed samples, scoring is one pass."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.operators.permutation import permuted

TREE_SCHEMA = "tree_id int, feature array<int>, threshold array<double>, left array<int>, right array<int>, size array<int>"


def _average_path(n):
    """The mean path of an unsuccessful search in a binary tree of n."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + 0.5772156649) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


def draw(tree: int, node: int, what: str, seed: int = 0) -> float:
    """A uniform number inside (0, 1), from the MD5 of its name; SQL can repeat it."""
    return (int(hashlib.md5(f"{tree}|{node}|{what}|{seed}".encode()).hexdigest()[:12], 16) + 0.5) / float(1 << 48)


def grow_tree(x: np.ndarray, tree: int = 0, seed: int = 0) -> dict[str, list]:
    """Arrays of one tree: random splits down to single rows or the height limit; the rows' order does not matter.

    A split's feature and cut are drawn by the node's place in the tree (1 for the root, 2n and 2n + 1 below n).
    """
    out = {"feature": [], "threshold": [], "left": [], "right": [], "size": []}
    limit = int(np.ceil(np.log2(max(len(x), 2))))

    def node(rows: np.ndarray, depth: int, name: int) -> int:
        at = len(out["feature"])
        for k, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("size", len(rows))):
            out[k].append(v)
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        splits = np.flatnonzero(high > low)
        if depth < limit and len(splits):
            f = int(splits[int(draw(tree, name, "feature", seed) * len(splits))])
            cut = float(low[f] + draw(tree, name, "cut", seed) * (high[f] - low[f]))
            cut = cut if low[f] < cut <= high[f] else float(high[f])  # rounding; a child is never empty
            goes = x[rows, f] < cut
            out["feature"][at], out["threshold"][at] = f, cut
            out["left"][at] = node(rows[goes], depth + 1, 2 * name)
            out["right"][at] = node(rows[~goes], depth + 1, 2 * name + 1)
        return at

    if len(x):
        node(np.arange(len(x)), 0, 1)
    return out


def _hashed(value):
    """48 bits of a string's MD5."""
    return F.conv(F.substring(F.md5(value), 1, 12), 16, 10).cast("long")


def _trees_of(key: str, rate: float, trees: int, seed: int):
    """The trees that a row serves: each of them with the same probability, whatever the table's size.

    Trees are reached by geometric steps over hashed draws, so a row that serves none costs a single draw.
    """
    def step(k):
        u = (_hashed(F.concat_ws("|", F.col(key), k, F.lit(seed))) + 0.5) / float(1 << 48)
        return F.floor(F.log(u) / F.lit(math.log1p(-rate))) if rate < 1 else F.lit(0).cast("long")

    first = step(F.lit(0))
    start = F.struct(first.alias("at"), F.array(first).alias("found"))

    def more(s, k):
        at = s["at"] + 1 + step(k)
        return F.when(s["at"] >= trees, s).otherwise(F.struct(at.alias("at"), F.concat(s["found"], F.array(at)).alias("found")))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(trees)), start, more)
    return F.when(first >= trees, F.array().cast("array<bigint>")).otherwise(F.filter(walked["found"], lambda t: t < trees))


def fit(df: DataFrame, features: Sequence[str], key: str, trees: int = 100, sample: int = 256, seed: int = 0) -> DataFrame:
    """The trees, a row each. A tree's rows are the ``sample`` with the least hashes of those drawn for it (fewer if fewer are).

    Twice the sample is drawn for a tree on average, so its group stays small whatever the table. Trees draw rows
    independently, in small tables as in large ones. All draws are MD5 of names (of keys, trees and nodes), so the forest
    is the same on every run and layout, and an oracle in SQL can grow it.
    """
    n = df.count()
    rate = min(1.0, 2.0 * sample / max(n, 1))
    filled = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    rows = df.select(F.col(key).alias("_key"), *filled)
    rows = rows.withColumn("tree_id", F.explode(_trees_of("_key", rate, trees, seed).cast("array<int>")))
    rows = rows.withColumn("_h", _hashed(F.concat_ws("|", "_key", "tree_id", F.lit(seed), F.lit("sample"))))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        some = group.sort_values(["_h", "_key"]).head(sample)
        tree = int(some["tree_id"].iloc[0])
        t = grow_tree(some[list(features)].to_numpy(), tree, seed)
        return pd.DataFrame([{"tree_id": tree, **t}])

    return rows.groupBy("tree_id").applyInPandas(grow, TREE_SCHEMA)


def scorer(trees: DataFrame, features: Sequence[str], sample: int = 256) -> Callable[[pd.DataFrame], np.ndarray]:
    """A function from feature rows to scores in (0, 1]; holds the trees (their size is trees times sample)."""
    forest = [(np.array(r["feature"]), np.array(r["threshold"]), np.array(r["left"]), np.array(r["right"]), np.array(r["size"])) for r in trees.orderBy("tree_id").collect()]
    names = list(features)

    def score(pdf: pd.DataFrame) -> np.ndarray:
        x = pdf[names].astype(float).fillna(0.0).to_numpy()
        path = np.zeros(len(x))
        for feature, threshold, left, right, size in forest:
            at, depth, live = np.zeros(len(x), int), np.zeros(len(x)), np.arange(len(x))
            while len(live := live[feature[at[live]] >= 0]):
                goes = x[live, feature[at[live]]] < threshold[at[live]]
                at[live] = np.where(goes, left[at[live]], right[at[live]])
                depth[live] += 1
            path += depth + _average_path(size[at])
        expect = float(_average_path(min(sample, int(forest[0][4][0])))) if forest else 1.0
        return np.power(2.0, -(path / max(len(forest), 1)) / max(expect, 1e-9))

    return score


def score_batches(df: DataFrame, score: Callable[[pd.DataFrame], np.ndarray], ids: Sequence[str], features: Sequence[str], model: str, batch: int = 200) -> DataFrame:
    """Scores of all rows, in batches of at most ``batch`` (a model's payload limit), each row once, with the model's name."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                yield part[list(ids)].assign(score=np.asarray(score(part), float), model_version=model)

    schema = ", ".join(f"`{i}` {kinds[i]}" for i in ids) + ", score double, model_version string"
    return df.select(*dict.fromkeys([*ids, *features])).mapInPandas(run, schema)


def permutation_impact(df: DataFrame, score: Callable[[pd.DataFrame], np.ndarray], features: Sequence[str], key: str, seed: int = 0) -> DataFrame:
    """(metric, impact): mean absolute change of the score when one feature takes another row's value.

    The other row is the one that a keyed permutation of the whole table puts in a row's place (see ``permutation``);
    rows are numbered by key, which has to tell them apart.
    """
    moved = permuted(df.select(F.col(key), *features), [key], features, seed)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            plain = score(pdf)
            for f in features:
                other = score(pdf.assign(**{f: pdf[f"_m_{f}"]}))
                yield pd.DataFrame({"metric": [f], "total": [float(np.abs(other - plain).sum())], "n": [len(pdf)]})

    out = moved.mapInPandas(run, "metric string, total double, n long")
    return out.groupBy("metric").agg((F.sum("total") / F.sum("n")).alias("impact"))
