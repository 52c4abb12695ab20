"""Boosted trees on counted feature patterns.

A round's residual depends on a row's features and label alone, so rows that
agree in both take every round together.  Where the training rows hold few
distinct feature vectors (as in ``counted_forest``), one aggregate counts them
by label and the rounds, which follow each other, run in one task on the
counted table: its size follows the distinct vectors, at most ``MOST_CELLS``,
and not the rows.  All rounds stay; a round draws each of ``n`` equal rows with
the subsampling rate, which is one binomial draw.  First tree, residuals,
variance splits, leaf means and probabilities are those of Spark's boosted
trees.  Other inputs go to Spark's as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens.operators.counted_forest import TREE_SCHEMA, CountedForestModel, counted, thresholds


def regression_tree(bins: np.ndarray, n: np.ndarray, s: np.ndarray, q: np.ndarray, least: int, depth: int):
    """One tree by variance, level by level: ``(feature, bin, left, mean, importance)``; the right child follows the left.

    A cell stands for ``n`` drawn rows whose residuals add up to ``s`` and their
    squares to ``q``.  Equal gains go to the first feature and bin.
    """
    here = np.flatnonzero(n > 0)
    bins, n, s, q = bins[here], n[here], s[here], q[here]
    widths = bins.max(0) + 1 if len(here) else np.ones(bins.shape[1], dtype=np.int64)
    node = np.zeros(len(here), dtype=np.int64)
    feature, cut, left, mean, gains = [], [], [], [], []
    first, count = 0, 1
    for level in range(depth + 1):
        rows, total, squares = (np.bincount(node, v, count) for v in (n, s, q))
        mean.append(total / np.maximum(rows, 1))
        best, best_f, best_b = np.zeros(count), np.full(count, -1), np.zeros(count, dtype=np.int64)
        if level < depth:
            for f in np.flatnonzero(widths > 1):
                width = int(widths[f])
                key = node * width + bins[:, f]
                ln, ls = (np.bincount(key, v, count * width).reshape(count, width).cumsum(1) for v in (n, s))
                rn, rs = rows[:, None] - ln, total[:, None] - ls
                gain = ls * ls / np.maximum(ln, 1) + rs * rs / np.maximum(rn, 1) - (total * total / np.maximum(rows, 1))[:, None]
                gain[(ln < least) | (rn < least)] = -1.0
                b = gain.argmax(1)
                g = gain[np.arange(count), b]
                better = g > best + 1e-12 * squares
                best, best_f, best_b = np.where(better, g, best), np.where(better, f, best_f), np.where(better, b, best_b)
        split = best_f >= 0
        rank = np.cumsum(split) - 1
        feature.append(best_f)
        cut.append(best_b)
        left.append(np.where(split, first + count + 2 * rank, -1))
        gains.append(best)
        if not split.any():
            break
        on = split[node]
        bins, n, s, q, node = bins[on], n[on], s[on], q[on], node[on]
        node = 2 * rank[node] + (bins[np.arange(len(node)), best_f[node]] > best_b[node])
        first, count = first + count, 2 * int(split.sum())
    feature, cut, left, mean, gains = (np.concatenate(v) for v in (feature, cut, left, mean, gains))
    return feature, cut, left, mean, np.bincount(feature[feature >= 0], gains[feature >= 0], bins.shape[1])


def leaf_values(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, value: np.ndarray, depth: int) -> np.ndarray:
    """The value of the leaf that every cell ends in."""
    at = np.zeros(len(bins), dtype=np.int64)
    each = np.arange(len(bins))
    for _ in range(depth):
        f = feature[at]
        at = np.where(f >= 0, left[at] + (bins[each, f] > cut[at]), at)
    return value[at]


def boosted_trees(
    bins: np.ndarray, n: np.ndarray, rounds: int, depth: int, step: float, subsample: float, least: int, seed: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """The rounds' trees on cells with ``n`` (cells x 2) rows by label; means hold the trees' weights (1, then ``step``)."""
    sign = np.array([-1.0, 1.0])
    margin = np.zeros(len(bins))
    for m in range(rounds):
        # The first tree fits the labels, the others minus the gradient of the logistic loss 2 log(1 + exp(-2 y F)).
        with np.errstate(over="ignore"):
            r = np.broadcast_to(sign, n.shape) if m == 0 else 4 * sign / (1 + np.exp(2 * sign * margin[:, None]))
        drawn = n if subsample >= 1 else np.random.default_rng([seed & 0xFFFFFFFF, m]).binomial(n, subsample)
        feature, cut, left, mean, importance = regression_tree(
            bins, drawn.sum(1).astype(float), (drawn * r).sum(1), (drawn * r * r).sum(1), least, depth
        )
        mean = mean * (1.0 if m == 0 else step)
        margin = margin + leaf_values(bins, feature, cut, left, mean, depth)
        yield feature, cut, left, mean, importance


class CountedBoosting(GBTClassifier):
    """Spark's boosted trees, grown on counted feature vectors where the rows repeat them often enough."""

    def _fit(self, dataset: DataFrame):
        table = counted(dataset, self.getFeaturesCol(), self.getLabelCol(), None) if self._as_spark_counts() else None
        if table is None:
            return super()._fit(dataset)
        max_bins, rounds, depth, step = self.getMaxBins(), self.getMaxIter(), self.getMaxDepth(), self.getStepSize()
        subsample, least, seed = self.getSubsamplingRate(), self.getMinInstancesPerNode(), self.getSeed()

        def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # One partition: all vectors, at most MOST_CELLS; a fixed order gives the same draws on every run.
            cells = pd.concat(batches, ignore_index=True)
            if cells.empty:
                return
            x, n = np.array(cells["x"].tolist()), cells[["n0", "n1"]].to_numpy(dtype=np.int64)
            cuts = [thresholds(x[:, f], n.sum(1).astype(float), max_bins) for f in range(x.shape[1])]
            bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
            for t, (f, b, left, p, importance) in enumerate(boosted_trees(bins, n, rounds, depth, step, subsample, least, seed)):
                at = np.array([cuts[i][j] if i >= 0 else 0.0 for i, j in zip(f, b)])
                yield pd.DataFrame({"tree": [t], "feature": [f], "threshold": [at], "left": [left], "p": [p], "importance": [importance]})

        n_features = len(table.select("x").first()[0])
        grown = table.select("x", "n0", "n1").repartition(1).sortWithinPartitions("x").mapInPandas(grow, TREE_SCHEMA)
        return CountedBoostedModel.of(grown.toPandas(), n_features, self.getFeaturesCol())

    def _as_spark_counts(self) -> bool:
        weighted = self.isDefined("weightCol") and self.getWeightCol()
        validated = self.isDefined("validationIndicatorCol") and self.getValidationIndicatorCol()
        return (
            not weighted and not validated and self.getLossType() == "logistic" and self.getImpurity() == "variance"
            and self.getFeatureSubsetStrategy() == "all" and self.getMinInfoGain() == 0.0
            and self.getMinWeightFractionPerNode() == 0.0
        )


class CountedBoostedModel(CountedForestModel):
    """The trees of a ``CountedBoosting``; their leaves add up to the margin."""

    def _outputs(self, mean: Column) -> dict[str, Column]:
        margin = mean * len(self._trees)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2.0))
        return {
            "rawPrediction": array_to_vector(F.array(-margin, margin)),
            "probability": array_to_vector(F.array(F.lit(1.0) - p, p)), "prediction": (margin > 0).cast("double"),
        }
