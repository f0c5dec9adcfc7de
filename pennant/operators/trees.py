"""Extremely randomised trees, grown level by level for all trees at once.

A level is one pass: every task sends its rows down the trees so far and sums,
for each open node and each of its candidate splits, how many rows and how much
label go left. Candidates are a few features of each node with a threshold drawn
between the ends of the node's box, all from a hash of seed, tree and node, so
the trees don't depend on partitions. What a pass sends is of the size of the
open nodes, never of the rows. Labels of 0 and 1 give whole sums; others are
summed in units of 2**-20, for the same reason. A missing feature goes left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 1 << 20


@dataclass
class Forest:
    """Trees as arrays by node (root 1, children 2 i and 2 i + 1): feature (-1: leaf), threshold, value."""

    features: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    gain: dict[str, float] = field(default_factory=dict)

    def leaves(self, x: np.ndarray, levels: int | None = None) -> np.ndarray:
        """rows x trees: the node each row ends in; levels: how deep the trees are so far, if less than they may be."""
        at = np.ones((len(x), len(self.feature)), np.int64)
        tree = np.arange(len(self.feature))
        for _ in range(int(math.log2(self.feature.shape[1])) - 1 if levels is None else levels):
            f, t = self.feature[tree, at], self.threshold[tree, at]
            v = np.take_along_axis(x, np.maximum(f, 0), axis=1)
            at = np.where(f < 0, at, 2 * at + (v > t))
        return at

    def predict(self, df: DataFrame, name: str = "p") -> DataFrame:
        @F.pandas_udf("double")
        def run(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns], axis=1)
            return pd.Series(self.value[np.arange(len(self.feature)), self.leaves(x)].mean(axis=1))

        return df.withColumn(name, run(*[F.col(c).cast("double") for c in self.features]))


def extra_trees(df: DataFrame, features: Sequence[str], label: str, trees: int = 20, depth: int = 5, tries: int | None = None, least: int = 5, seed: int = 1) -> Forest:
    """tries: candidate splits of a node, the root of the number of features by default; least: rows that a node must have to be split."""
    names, tries = list(features), tries or max(1, round(math.sqrt(len(features))))
    rows = df.filter(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("double").alias("_y"))
    ends = rows.agg(F.count("*"), F.sum(F.round(F.col("_y") * UNIT).cast("long")), *[f(F.when(~F.isnan(c), F.col(c))) for c in names for f in (F.min, F.max)]).first()
    if not ends[0]:
        raise ValueError("there are no rows with a label")
    size = 2 << depth
    forest = Forest(names, np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size)), dict.fromkeys(names, 0.0))
    box = {(t, 1): [(ends[2 + 2 * k] or 0.0, ends[3 + 2 * k] or 0.0) for k in range(len(names))] for t in range(trees)}
    facts = {(t, 1): (ends[0], ends[1]) for t in range(trees)}
    for t in range(trees):
        forest.value[t, 1] = ends[1] / UNIT / ends[0]
    for level in range(depth):
        open_ = [key for key, (n, _) in facts.items() if key[1].bit_length() == level + 1 and n >= least]
        if not open_:
            break
        asked = {}
        for t, node in open_:
            rng = np.random.default_rng([seed, t, node])
            wide = [k for k in range(len(names)) if box[t, node][k][0] < box[t, node][k][1]]
            asked[t, node] = [(k, rng.uniform(*box[t, node][k])) for k in rng.permutation(wide)[:tries].tolist()]
        flat = [(t, node, k, cut) for (t, node), own in asked.items() for k, cut in own]
        if not flat:
            break
        of = {key: [] for key in asked}
        for i, (t, node, _, _) in enumerate(flat):
            of[t, node].append(i)
        left = _sums(rows, forest, names, flat, of, level)
        for key, own in of.items():
            n, total = facts[key]
            best, chosen = 0.0, None
            for i in own:
                m, s = left.get(i, (0, 0))
                if 0 < m < n:
                    gain = (s / m) ** 2 * m + ((total - s) / (n - m)) ** 2 * (n - m) - (total / n) ** 2 * n
                    if gain > best:
                        best, chosen = gain, i
            if chosen is not None:
                (t, node), (_, _, k, cut), (m, s) = key, flat[chosen], left[chosen]
                forest.feature[t, node], forest.threshold[t, node] = k, cut
                forest.gain[names[k]] += best / UNIT**2
                for child, count, part in ((2 * node, m, s), (2 * node + 1, n - m, total - s)):
                    facts[t, child], forest.value[t, child] = (count, part), part / UNIT / count
                    box[t, child] = [*box[key]]
                    lo, hi = box[key][k]
                    box[t, child][k] = (lo, cut) if child == 2 * node else (cut, hi)
    return forest


def _sums(rows: DataFrame, forest: Forest, names: list[str], flat: list[tuple], of: dict[tuple, list[int]], level: int) -> dict[int, tuple[int, int]]:
    """For each candidate split (tree, node, feature, threshold): rows that go left, and the sum of their labels in units."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, label = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        for frame in frames:
            x, y = frame[names].to_numpy(dtype=float, na_value=np.nan), np.round(frame["_y"].to_numpy(dtype=float) * UNIT).astype(np.int64)
            at = forest.leaves(x, level)
            for (t, node), own in of.items():
                here = np.flatnonzero(at[:, t] == node)
                for i in own:
                    goes = here[~(x[here, flat[i][2]] > flat[i][3])]
                    count[i] += len(goes)
                    label[i] += y[goes].sum()
        yield pd.DataFrame({"i": np.arange(len(flat)), "n": count, "s": label})

    found = rows.mapInPandas(work, "i long, n long, s long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    return {r["i"]: (r["n"], r["s"]) for r in found}


def importance(forest: Forest) -> dict[str, float]:
    """Each feature's share of what the splits gained."""
    total = sum(forest.gain.values())
    return {c: g / total if total else 0.0 for c, g in forest.gain.items()}


def stability(df: DataFrame, season: str, features: Sequence[str], label: str, noise: str, first: int = 1, **options) -> list[tuple[str, float, int, int]]:
    """feature, mean importance, folds in which it was worth more than the noise column, folds; forests of the seasons before each season."""
    seasons = sorted(r[0] for r in df.select(season).distinct().collect())
    shares = [importance(extra_trees(df.filter(F.col(season).isin(seasons[:k])), [*features, noise], label, **options)) for k in range(first, len(seasons))]
    return [(c, sum(s[c] for s in shares) / len(shares), sum(s[c] > s[noise] for s in shares), len(shares)) for c in [*features, noise]] if shares else []
