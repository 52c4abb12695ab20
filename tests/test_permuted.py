"""Copies of rows with one column permuted against a plain loop; permutation importance scores once."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from campaignlens.operators import model, permuted

SCHEMA = "rating_account_id long, fold int, label double, a double, b double, c double"


def rows_of(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = float(rnd.randrange(2)), float(rnd.randrange(3))
        rows.append((i, i % 2, float(rnd.random() < 0.1 + 0.4 * a + 0.1 * b), a, b, rnd.random()))
    return rows


@pytest.mark.parametrize("block", [7, 1000])
def test_counts_are_those_of_a_plain_loop(spark, block):
    n, rnd = 50, random.Random(3)
    rows = [(p, rnd.choice([0.0, 1.0, 1.0, None]), rnd.choice([1.0, 2.0, None]), float(rnd.randrange(3))) for p in range(n)]
    df = spark.createDataFrame(rows, "p long, label double, a double, b double").repartition(3)
    shifts = {"b": 5, "a": 49}
    got = {}
    for r in permuted.permuted_counts(df, "p", n, ["a", "b"], "label", shifts, block).collect():
        got[r["copy"], *("none" if v is None or math.isnan(v) else v for v in (r.a, r.b))] = (r.tp, r.fp)
    want = {}
    for k, name in enumerate(["", "b", "a"]):
        tp, fp = Counter(), Counter()
        for p, y, a, b in rows:
            taken = rows[(p - shifts.get(name, 0)) % n]
            vector = (k - 1, *("none" if v is None else v for v in (taken[2] if name == "a" else a, taken[3] if name == "b" else b)))
            tp[vector] += y == 1
            fp[vector] += y == 0
        want |= {v: (tp[v], fp[v]) for v in tp}
    assert {k: (t or 0, f or 0) for k, (t, f) in got.items()} == want


def test_rows_that_cannot_be_numbered_stay_apart():
    x = np.random.default_rng(0).random((400, 9))
    taken = x[::-1, [2]].copy()
    plain, copy = permuted.counted_copies(x, taken, [2])
    assert (plain[1] == x).all() and (plain[2] == 1).all() and (copy[1][:, 2] == taken[:, 0]).all() and (copy[1][:, 3] == x[:, 3]).all()


class Once:
    """A model that is asked for one scoring pass only."""

    def __init__(self, fitted):
        self.fitted, self.passes = fitted, 0

    def transform(self, rows):
        self.passes += 1
        return self.fitted.transform(rows)


def auc(scores, labels):
    pos, neg = ([s for s, y in zip(scores, labels) if y == v] for v in (1.0, 0.0))
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


def test_importance_takes_one_pass_and_equals_a_plain_loop(spark):
    rows = rows_of(300, 4)
    frame, names = spark.createDataFrame(rows, SCHEMA), ["a", "b", "c"]
    fitted = Once(model.fit(frame.where("fold = 1"), names, model.forest(num_trees=5, min_leaf=5, max_depth=4)))
    got = {r.feature: r for r in model.permutation_importance(fitted, frame.where("fold = 0"), ["b", "a"]).collect()}
    assert fitted.passes == 1 and set(got) == {"a", "b"}
    test = sorted((r for r in rows if r[1] == 0), key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), r[0]))
    n = len(test)

    def scored(column=None, shift=0):
        moved = [[*r] for r in test]
        for p, r in enumerate(moved):
            if column is not None:
                r[column] = test[(p - shift) % n][column]
        out = {r.rating_account_id: r.score for r in model.scores(fitted.fitted, spark.createDataFrame([tuple(r) for r in moved], SCHEMA)).collect()}
        return auc([out[r[0]] for r in test], [r[2] for r in test])

    base = scored()
    for i, name in enumerate(["a", "b"]):
        there = scored(names.index(name) + 3, 1 + (i * n) // 3)
        assert got[name].base_roc_auc == pytest.approx(base) and got[name].permuted_roc_auc == pytest.approx(there)
        assert got[name].importance == pytest.approx(base - there)


def test_no_rows_have_no_importance(spark):
    frame = spark.createDataFrame(rows_of(100, 5), SCHEMA)
    fitted = model.fit(frame, ["a"], model.forest(num_trees=2, min_leaf=5))
    assert model.permutation_importance(fitted, frame.where("fold > 5"), ["a"]).count() == 0
