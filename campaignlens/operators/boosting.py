"""Second-order boosted trees on counted cells.

Features are cut into bins once.  Margins, gradients and hessians depend on a
row's bins alone, so the training rows are collapsed into cells ``(slice, bins)``
with their rows and positives; the number of cells follows the distinct bin
patterns and not the rows.  A row's slice is a hash of its key: leaving out some
slices in a round is row subsampling that every run repeats.

A tree grows level by level.  One aggregate a level gives the gradient and
hessian sums of every (node, feature, bin): at most ``2 ** depth * features *
bins`` rows, whatever the data, which the driver turns into splits.  Leaf
weights are ``-G / (H + l2)``, shrunk by the step.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators.split import seeded_hash
from campaignlens.sources.sinks import stage_roundtrip

SLICES = 20
# Rounds after which the margins are stored, so that plans stay short.
STORE_EVERY = 5


@dataclass
class Node:
    """A split on ``bins[feature] <= bin``, or a leaf with its weight."""

    weight: float = 0.0
    feature: int = -1
    bin: int = -1
    left: Node | None = None
    right: Node | None = None

    def sql(self, leaf) -> str:
        """Nested SQL over the ``bins`` array; ``leaf`` gives the text of a leaf."""
        if self.left is None:
            return leaf(self)
        return f"CASE WHEN bins[{self.feature}] <= {self.bin} THEN {self.left.sql(leaf)} ELSE {self.right.sql(leaf)} END"


@dataclass
class Boosted:
    """Features, their bin edges (lowest value and width), the base margin and the trees."""

    features: list[str]
    edges: list[tuple[float, float, int]]
    base: float
    trees: list[Node] = field(default_factory=list)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[tuple[float, float, int]]:
    """``(lowest, width, bins)`` of equal-width bins per feature, from one aggregate; a constant has one bin."""
    cols = [F.col(f"`{c}`").cast("double") for c in features]
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("a", F.min), ("b", F.max))]).first()
    out = []
    for i in range(len(features)):
        low, high = row[f"a{i}"], row[f"b{i}"]
        out.append((low, (high - low) / bins, bins) if low is not None and low < high else (low or 0.0, 1.0, 1))
    return out


def bins_of(features: Sequence[str], edges: Sequence[tuple[float, float, int]]) -> Column:
    """The bin of every feature as one array; values outside the edges go to the first or last bin."""
    out = []
    for c, (low, width, n) in zip(features, edges):
        step = F.floor((F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) - F.lit(low)) / F.lit(width))
        out.append(F.greatest(F.least(step, F.lit(n - 1)), F.lit(0)).cast("int"))
    return F.array(*out)


def counted_cells(
    train: DataFrame, features: Sequence[str], edges: Sequence[tuple[float, float, int]], key: str = S.KEY, seed: int = S.SPLIT_SEED
) -> DataFrame:
    """``(slice, bins, n, pos)``: the rows and positives of every bin pattern in every hash slice."""
    digits = F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("long")
    rows = train.select((digits % SLICES).cast("int").alias("slice"), bins_of(features, edges).alias("bins"), "label")
    return rows.groupBy("slice", "bins").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))


def level_sums(cells: DataFrame, node: str, n_features: int) -> DataFrame:
    """``(node, feature, bin, g, h)`` of the cells' logistic gradients and hessians at their ``margin``."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
    at = cells.select(
        F.expr(node).alias("node"), "bins", (F.col("n") * p - F.col("pos")).alias("g"), (F.col("n") * p * (1 - p)).alias("h")
    )
    long = at.where("node IS NOT NULL").select("node", F.posexplode("bins").alias("feature", "bin"), "g", "h")
    return long.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def split_gain(gl: float, hl: float, g: float, h: float, l2: float) -> float:
    """Half the gain of the second-order objective when a node is split."""
    gr, hr = g - gl, h - hl
    return 0.5 * (gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2))


def best_splits(sums: Sequence, l2: float, least_hessian: float) -> dict[int, tuple[float, int, int, tuple, tuple]]:
    """Per node ``(gain, feature, bin, left (g, h), right (g, h))``; equal gains go to the first feature and bin."""
    by_node: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
    for r in sums:
        by_node.setdefault(r["node"], {}).setdefault(r["feature"], {})[r["bin"]] = (r["g"], r["h"])
    out = {}
    for node, features in by_node.items():
        first = features[min(features)]
        g, h = sum(x for x, _ in first.values()), sum(x for _, x in first.values())
        found = (0.0, -1, -1, (g, h), (0.0, 0.0))
        for f in sorted(features):
            gl = hl = 0.0
            for b in sorted(features[f])[:-1]:
                gl, hl = gl + features[f][b][0], hl + features[f][b][1]
                if hl < least_hessian or h - hl < least_hessian:
                    continue
                gain = split_gain(gl, hl, g, h, l2)
                if gain > found[0] + 1e-12:
                    found = (gain, f, b, (gl, hl), (g - gl, h - hl))
        out[node] = found
    return out


def grow(cells: DataFrame, n_features: int, depth: int, l2: float, least_hessian: float) -> Node:
    """One tree on cells with a ``margin``; leaves hold their unshrunk weight."""
    root = Node()
    frontier = [root]
    for _ in range(depth):
        number = {id(n): i for i, n in enumerate(frontier)}
        node = root.sql(lambda leaf: str(number[id(leaf)]) if id(leaf) in number else "NULL")
        found = best_splits(level_sums(cells, node, n_features).collect(), l2, least_hessian)
        following = []
        for i, n in enumerate(frontier):
            gain, feature, bin_, left, right = found.get(i, (0.0, -1, -1, (0.0, 0.0), (0.0, 0.0)))
            if feature < 0:
                n.weight = -left[0] / (left[1] + l2)
                continue
            n.feature, n.bin = feature, bin_
            n.left, n.right = (Node(-g / (h + l2)) for g, h in (left, right))
            following += [n.left, n.right]
        frontier = following
        if not frontier:
            break
    return root


def boost(
    train: DataFrame, features: Sequence[str], rounds: int = 300, depth: int = 4, step: float = 0.05, subsample: float = 0.8,
    l2: float = 1.0, least_hessian: float = 1.0, bins: int = 32, seed: int = S.SPLIT_SEED, key: str = S.KEY,
) -> Boosted:
    """Boosted trees on ``train (key, label, features...)``."""
    features = list(features)
    edges = bin_edges(train, features, bins)
    cells = stage_roundtrip(counted_cells(train, features, edges, key, seed), "cells")
    total = cells.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).first()
    rate = min(max((total.pos or 0.0) / max(total.n or 0, 1), 1e-6), 1 - 1e-6)
    model = Boosted(features, edges, math.log(rate / (1 - rate)))
    cells = cells.withColumn("margin", F.lit(model.base))
    draw = random.Random(seed)
    for t in range(rounds):
        used = sorted(draw.sample(range(SLICES), max(1, round(SLICES * subsample))))
        tree = grow(cells.where(F.col("slice").isin(used)), len(features), depth, l2, least_hessian)
        _shrink(tree, step)
        model.trees.append(tree)
        cells = cells.withColumn("margin", F.col("margin") + _value(tree))
        if (t + 1) % STORE_EVERY == 0 and t + 1 < rounds:
            cells = stage_roundtrip(cells, "cells")
    return model


def _shrink(node: Node, step: float) -> None:
    node.weight *= step
    if node.left is not None:
        _shrink(node.left, step)
        _shrink(node.right, step)


def _value(tree: Node) -> Column:
    return F.expr(tree.sql(lambda leaf: f"{leaf.weight!r}D"))


def scores(model: Boosted, rows: DataFrame, name: str = "score", key: str = S.KEY) -> DataFrame:
    """``(key, label, score)`` with the probability of the positive class."""
    at = rows.select(key, F.col("label").cast("int").alias(S.LABEL), bins_of(model.features, model.edges).alias("bins"))
    margin = F.lit(model.base)
    for tree in model.trees:
        margin = margin + _value(tree)
    return at.select(key, S.LABEL, (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias(name))


def root_gains(cells: DataFrame, l2: float = 1.0) -> DataFrame:
    """``(feature, bin, g, h, gain)`` of every split of the root at the base margin."""
    total = cells.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).first()
    base = math.log(total.pos / (total.n - total.pos))
    sums = level_sums(cells.withColumn("margin", F.lit(base)), "0", 0)
    so_far = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("feature")
    gl, hl, g, h = F.sum("g").over(so_far), F.sum("h").over(so_far), F.sum("g").over(whole), F.sum("h").over(whole)
    gr, hr = g - gl, h - hl
    gain = (gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2)) / 2
    last = F.max("bin").over(whole)
    return sums.select("feature", "bin", gl.alias("g"), hl.alias("h"), gain.alias("gain"), last.alias("_last")).where(
        "bin < _last"
    ).drop("_last")
