"""Forests over counted cells, for the grid search over many rows.

A tree of Spark ML sees a continuous feature only through ``maxBins`` bins, so
rows that share their bins and label are alike to it.  Binned rows are counted
once per training set; forests then grow over the counted cells, with Spark's
rules: a bootstrap gives each row a Poisson number (a cell of n rows the sum of
n of these, which is Poisson too), a random subset of the features per node, gini
gain, least rows per child, leaves of one class, twin leaves merged, votes by
class shares.  Levels are grown in turn, so the forest of a smaller depth is the
upper part of a deeper one: one growth serves every depth.

Cells are at most bins ^ features x classes; where they don't collapse the rows
the caller keeps Spark ML's own fits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _subset_size(forest: RandomForestClassifier, width: int) -> int | None:
    how = forest.getFeatureSubsetStrategy()
    if how == "all" or (how == "auto" and forest.getNumTrees() == 1):
        return width
    return math.ceil(math.sqrt(width)) if how in ("auto", "sqrt") else None


def _thresholds(df: DataFrame, names: Sequence[str], k: int, bins: int) -> list[list[np.ndarray]]:
    """Per training set (all rows but one fold's) and feature, the thresholds between
    bins: half-way between the values where there are at most ``bins``, else quantiles
    (over all rows, to a ten-thousandth of their ranks; Spark takes them from a sample)."""
    few: dict[str, np.ndarray] = {}
    for c in names:
        values = [r[0] for r in df.select(c).distinct().limit(bins + 1).collect()]
        if len(values) <= bins:
            v = np.sort(np.array(values, dtype=float))
            few[c] = (v[1:] + v[:-1]) / 2
    many = [c for c in names if c not in few]
    probs = [i / bins for i in range(1, bins)]
    found = df.agg(F.count(F.lit(1)), *[
        F.percentile_approx(F.when(F.col("fold") != f, F.col(c)), probs, 10_000).alias(f"{c}_{f}")
        for c in many for f in range(k)]).first()
    return [[few[c] if c in few else np.unique(np.array(found[f"{c}_{f}"] or [], dtype=float)) for c in names]
            for f in range(k)]


def _counted(edges: list[list[np.ndarray]], bins: int):
    """For ``mapInArrow`` over (fold, label, features...): per training set the cells of a batch with their rows."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            fold, label, *xs = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            out = []
            for f, cuts in enumerate(edges):
                cell = np.zeros(len(fold), dtype=np.int64)
                for x, cut in zip(xs, cuts):
                    cell = cell * bins + np.searchsorted(cut, x, side="left")
                both = np.stack([cell, label.astype(np.int64), (fold == f).astype(np.int64)])
                order = np.lexsort(both)
                both = both[:, order]
                first = np.flatnonzero(np.r_[True, (both[:, 1:] != both[:, :-1]).any(axis=0)]) if len(fold) else order
                out.append(np.vstack([np.full((1, len(first)), f), both[:, first],
                                      np.diff(np.r_[first, len(fold)])[None, :]]))
            table = np.hstack(out).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table], ["train", "cell", "label", "held", "n"])

    return run


def _grower(classes: int, bins: int, subset: int, min_gain: float):
    """``grow`` and ``votes`` for trees over cells; functions inside travel to tasks by value."""
    least_impurity = 2.220446049250313e-16

    def gini(counts, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.ones(n.shape)
            for c in range(classes):
                share = counts[..., c] / n
                out -= share * share
        return np.where(n > 0, out, 0.0)

    def grow(x, y, w, max_depth, least, rng):
        """(feature, last bin to the left, left child or -1, counts, level), a row per node, level by level."""
        rows = np.flatnonzero(w > 0)
        at = np.zeros(len(rows), dtype=np.int64)  # place in the level's open nodes
        counts = np.bincount(y[rows], weights=w[rows], minlength=classes)[None, :]
        tree = {"feature": [np.zeros(1, int)], "bin": [np.zeros(1, int)], "left": [np.full(1, -1)], "counts": [counts]}
        size, open_nodes = 1, np.zeros(1, dtype=np.int64)  # places in the newest level
        if gini(counts, counts.sum(axis=1))[0] < least_impurity:
            open_nodes = open_nodes[:0]
        for _ in range(max_depth):
            if not len(open_nodes):
                break
            counts = tree["counts"][-1][open_nodes]
            n = counts.sum(axis=1)
            a, width = len(open_nodes), x.shape[1]
            drawn = (np.argsort(rng.random((a, width)), axis=1)[:, :subset] if subset < width
                     else np.tile(np.arange(width), (a, 1)))
            before = gini(counts, n)
            gains, lefts = np.empty((a, subset, bins - 1)), []
            for j in range(subset):
                key = (at * bins + x[rows, drawn[at, j]]) * classes + y[rows]
                hist = np.bincount(key, weights=w[rows], minlength=a * bins * classes).reshape(a, bins, classes)
                left = np.cumsum(hist, axis=1)[:, :-1]
                right = counts[:, None, :] - left
                nl, nr = left.sum(axis=2), right.sum(axis=2)
                gain = (before[:, None] - (nl / n[:, None]) * gini(left, nl)) - (nr / n[:, None]) * gini(right, nr)
                gain[(nl < least) | (nr < least) | (gain < min_gain)] = -np.inf
                gains[:, j] = gain
                lefts.append(left)
            best = gains.reshape(a, -1).argmax(axis=1)
            split = np.take_along_axis(gains.reshape(a, -1), best[:, None], axis=1)[:, 0] > 0
            which, cut = np.divmod(best, bins - 1)
            went = np.flatnonzero(split)
            if not len(went):
                break
            feature = drawn[went, which[went]]
            left = np.stack(lefts, axis=1)[went, which[went], cut[went]]
            both = np.stack([left, counts[went] - left], axis=1).reshape(-1, classes)
            tree["feature"][-1][open_nodes[went]] = feature
            tree["bin"][-1][open_nodes[went]] = cut[went]
            tree["left"][-1][open_nodes[went]] = size + 2 * np.arange(len(went))
            size += len(both)
            for name, start in (("feature", 0), ("bin", 0), ("left", -1)):
                tree[name].append(np.full(len(both), start))
            tree["counts"].append(both)
            place = np.full(a, -1)
            place[went] = np.arange(len(went))
            keep = place[at] >= 0
            rows, at = rows[keep], place[at[keep]]
            child = 2 * at + (x[rows, feature[at]] > cut[went][at])
            is_open = gini(both, both.sum(axis=1)) >= least_impurity
            open_nodes = np.flatnonzero(is_open)
            place = np.full(len(both), -1)
            place[open_nodes] = np.arange(len(open_nodes))
            keep = place[child] >= 0
            rows, at = rows[keep], place[child[keep]]
        level = np.repeat(np.arange(len(tree["left"])), [len(v) for v in tree["left"]])
        return (*(np.concatenate(tree[c]) for c in ("feature", "bin", "left", "counts")), level)

    def votes(tree, x, depth):
        """Class shares of the leaf of each cell in the tree cut at ``depth``, twin leaves merged."""
        feature, cut, left, counts, level = tree
        leaf, says = (left < 0) | (level >= depth), counts.argmax(axis=1)
        for up in range(min(depth, int(level.max())) - 1, -1, -1):
            inner = np.flatnonzero((level == up) & ~leaf)
            l, r = left[inner], left[inner] + 1
            leaf[inner[leaf[l] & leaf[r] & (says[l] == says[r])]] = True
        at = np.zeros(len(x), dtype=np.int64)
        while len(going := np.flatnonzero(~leaf[at])):
            node = at[going]
            at[going] = left[node] + (x[going, feature[node]] > cut[node])
        return (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300))[at]

    return grow, votes


def forest_grid(forest: RandomForestClassifier, folded: DataFrame, depths: Sequence[int], min_instances: Sequence[int],
                label: str = "label", k: int = 5, features: str = "features", least_rows: int = 20_000,
                most_cells: int = 4_000_000) -> dict[tuple[int, int], float] | None:
    """Cross-validated accuracy per (depth, least rows per child) over the column ``fold``, as ``CrossValidator``
    gives it.  None where cells are not far fewer than rows, or ``forest`` asks for what isn't kept here."""
    total = folded.count()
    if total <= least_rows:
        return None
    width, bins = len(folded.select(features).first()[0]), forest.getMaxBins()
    subset = _subset_size(forest, width)
    if (subset is None or forest.getImpurity() != "gini" or forest.getMinWeightFractionPerNode() > 0
            or forest.isSet("weightCol") or forest.isSet("thresholds") or width * math.log2(bins) > 62):
        return None
    spark, v, names = folded.sparkSession, vector_to_array(features), [f"x{i}" for i in range(width)]
    wide = folded.select("fold", F.col(label).cast("double").alias("label"), *[v[i].alias(c) for i, c in enumerate(names)])
    wide = materialize(wide, "forest-rows")
    odd = reduce(or_, [F.col(c).isNull() | F.isnan(c) | (F.abs(c) == math.inf) for c in names])
    y = F.col("label")
    if not wide.where(odd | y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y))).isEmpty():
        return None  # Spark says what is wrong with them
    edges = _thresholds(wide, names, k, bins)
    counted = wide.mapInArrow(_counted(edges, bins), "train long, cell long, label long, held long, n long")
    cells = materialize(counted.groupBy("train", "cell", "label", "held").agg(F.sum("n").alias("n")), "forest-cells")
    number = cells.count()
    if number > min(most_cells, total * k // 4):
        return None
    got = {c: x.to_numpy() for c, x in zip(("train", "cell", "label", "held", "n"), cells.orderBy(
        "train", "held", "cell", "label").toArrow().columns)}
    classes = int(got["label"].max()) + 1
    sets = []
    for f in range(k):
        parts = []
        for held in (0, 1):
            at = (got["train"] == f) & (got["held"] == held)
            rest, x = got["cell"][at], np.empty((int(at.sum()), width), dtype=np.uint8 if bins <= 256 else np.int32)
            for i in range(width - 1, -1, -1):
                rest, x[:, i] = np.divmod(rest, bins)
            parts.append((x, got["label"][at], got["n"][at]))
        sets.append(parts)
    shared = spark.sparkContext.broadcast(sets)
    jobs = [(f, int(m)) for f in range(k) for m in min_instances]
    depths, deepest = [int(d) for d in depths], int(max(depths))
    trees, seed, bootstrap = forest.getNumTrees(), forest.getSeed(), forest.getBootstrap()
    rate, grower = forest.getSubsamplingRate(), _grower(classes, bins, subset, forest.getMinInfoGain())

    def run(batches):
        import pyarrow as pa

        grow, votes = grower
        for job in (j for batch in batches for j in batch.column(0).to_pylist()):
            f, least = jobs[job]
            (x, y, n), (held_x, held_y, held_n) = shared.value[f]
            sums = np.zeros((len(depths), len(held_x), classes))
            for t in range(trees):
                rng = np.random.default_rng([seed % 2 ** 32, t])
                w = rng.poisson(n * rate) if bootstrap else n if rate == 1 else rng.binomial(n, rate)
                tree = grow(x, y, w.astype(float), deepest, least, rng)
                for i, depth in enumerate(depths):
                    sums[i] += votes(tree, held_x, depth)
            right = [float(held_n[s.argmax(axis=1) == held_y].sum() / held_n.sum()) for s in sums]
            yield pa.RecordBatch.from_arrays([pa.array([least] * len(depths), pa.int64()), pa.array(depths, pa.int64()),
                                              pa.array(right)], ["least", "depth", "accuracy"])

    try:
        rows = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "least long, depth long, accuracy double").collect()
    finally:
        shared.unpersist()
    return {(d, m): float(np.mean([r.accuracy for r in rows if (r.depth, r.least) == (d, m)]))
            for d in depths for m in map(int, min_instances)}
