"""Models: determinism, ranking, penalty, cross-validation, selection, promotion."""

import math
import random
import tempfile

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators import evaluate, model, split
from campaignlens.plans import flow

SF = "/root/testdata/sf0.001"


def test_forest_stage_is_deterministic(spark):
    runs = []
    for _ in range(2):
        paths = flow.materialize(spark, SF, tempfile.mkdtemp(prefix="campaignlens-rf-"), scorer="forest", num_trees=10)
        runs.append(spark.read.parquet(paths["predictions"]))
    a, b = runs
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    scores = [r.score for r in a.collect()]
    assert all(0.0 <= s <= 1.0 for s in scores)


def small_frame(spark, n=600):
    """Two informative inputs, one useless, one constant; five folds."""
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        a, b, c = rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.gauss(0, 1)
        y = float(rnd.random() < 1 / (1 + math.exp(-(2.0 * a - 1.0 * b))))
        rows.append((i, i % 5, y, a, b, c, 1.0))
    return spark.createDataFrame(rows, "rating_account_id long, fold int, label double, a double, b double, c double, k double")


NAMES = ["a", "b", "c", "k"]


def auc_of(fitted, rows):
    return evaluate.roc_auc(model.scores(fitted, rows)).first().roc_auc


def test_forest_and_boosted_trees_rank_above_the_base(spark):
    frame = small_frame(spark)
    train, test = frame.where("fold <> 0"), frame.where("fold = 0")
    for est in (model.forest(num_trees=20, min_leaf=5), model.boosted(max_iter=10)):
        assert auc_of(model.fit(train, NAMES, est), test) > 0.75


def test_logistic_coefficients_are_the_penalised_optimum(spark):
    frame = small_frame(spark, 200)
    n, c = frame.count(), 0.05
    fitted = model.fit(frame, ["a", "b"], model.logistic(n, c)).stages[-1]
    rows = frame.collect()
    count = {y: sum(r.label == y for r in rows) for y in (0.0, 1.0)}
    w, beta, icpt = [n / (2 * count[r.label]) for r in rows], np.zeros(2), 0.0
    x, y = np.array([[r.a, r.b] for r in rows]), np.array([r.label for r in rows])
    for _ in range(200):  # Newton on c * sum(w * loss) + |b|^2 / 2
        p = 1 / (1 + np.exp(-(x @ beta + icpt)))
        z = np.column_stack([x, np.ones(n)])
        g = c * z.T @ (np.array(w) * (p - y)) + np.append(beta, 0)
        h = c * (z * (np.array(w) * p * (1 - p))[:, None]).T @ z + np.diag([1, 1, 0])
        step = np.linalg.solve(h, g)
        beta, icpt = beta - step[:2], icpt - step[2]
    assert fitted.coefficients.toArray() == pytest.approx(beta, abs=1e-3) and fitted.intercept == pytest.approx(icpt, abs=1e-3)


def test_out_of_fold_accuracy_equals_a_manual_loop(spark):
    train = small_frame(spark).where("fold <> 0")
    est = model.forest(num_trees=5, min_leaf=20)
    got = model.out_of_fold_accuracy(train, NAMES, est)
    each = []
    weighted = split.with_class_weight(train, "label")
    for f in (1, 2, 3, 4):
        fitted = Pipeline(stages=[model.assembler(NAMES), est]).fit(weighted.where(F.col("fold") != f))
        out = fitted.transform(weighted.where(F.col("fold") == f))
        each.append(out.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
    assert got == pytest.approx(sum(each) / 4)


def test_tune_marks_and_refits_the_best(spark):
    frame = small_frame(spark)
    grid = model.full_grid({"maxDepth": [1, 4], "numTrees": [3]})
    table, best, fitted = model.tune(frame, NAMES, grid)
    rows = {r.params: (r.mean_roc_auc, r.is_best) for r in table.collect()}
    top = max(rows, key=lambda p: rows[p][0])
    assert [p for p in rows if rows[p][1]] == [top] and best == {"maxDepth": int(top.split("maxDepth=")[1][0]), "numTrees": 3}
    assert auc_of(fitted, frame.where("fold = 0")) > 0.6
    assert len(model.random_grid({"a": [1, 2, 3], "b": [1, 2]}, 4)) == 4
    assert model.random_grid({"a": [1, 2, 3]}, 2) == model.random_grid({"a": [1, 2, 3]}, 2)


def test_selectors_and_permutation_importance(spark):
    frame = small_frame(spark)
    kept = {r.feature: r for r in model.select_features(frame, NAMES, top=2, num_trees=10).collect()}
    assert kept["k"].kept_by_variance == 0 and kept["a"].kept_by_univariate == kept["a"].kept_by_embedded == 1
    stats = {r.feature: r for r in model.selector_statistics(frame, NAMES).collect()}
    rows = frame.where("fold <> 0").collect()
    g = [np.array([r.a for r in rows if r.label == y]) for y in (0.0, 1.0)]
    every = np.concatenate(g)
    between = sum(len(v) * (v.mean() - every.mean()) ** 2 for v in g)
    within = sum(((v - v.mean()) ** 2).sum() for v in g)
    assert stats["a"].f_value == pytest.approx(between / (within / (len(every) - 2)))
    assert stats["a"].variance == pytest.approx(every.var(ddof=1)) and stats["k"].variance == 0.0
    fitted = model.fit(frame.where("fold <> 0"), NAMES, model.forest(num_trees=20, min_leaf=5))
    drop = {r.feature: r.importance for r in model.permutation_importance(fitted, frame.where("fold = 0"), NAMES).collect()}
    assert drop["k"] == 0.0 and drop["a"] > 0.05 and drop["a"] > drop["c"]


def test_feature_set_report_equals_the_single_reports(spark):
    frame = small_frame(spark)
    out = model.compare_feature_sets(frame, {"ab": ["a", "b"], "c": ["c"]}, num_trees=5, threshold=0.5)
    got = {(r.feature_set, r.metric): r.value for r in out.collect()}
    fitted = model.fit(frame.where("fold <> 0"), ["c"], model.forest(num_trees=5, max_depth=S.COMPARE_MAX_DEPTH))
    scored = model.scores(fitted, frame.where("fold = 0"))
    for r in evaluate.classification_report(scored, 0.5).collect():
        for c in ("precision", "recall", "f1_score", "support"):
            if r[c] is not None:
                assert got["c", f"{r.class_label}:{c}"] == pytest.approx(r[c])
    for r in evaluate.precision_at_k(scored, rule="floor").collect():
        assert got["c", f"precision@{r.k_frac}"] == pytest.approx(r.precision_at_k)


def test_champion_is_found_and_compared(spark, tmp_path):
    frame = small_frame(spark, 200)
    fitted = model.fit(frame.where("fold <> 0"), NAMES, model.forest(num_trees=3, min_leaf=5))
    path = f"file://{tmp_path}/champion"
    assert model.champion_auc(spark, path) is None
    assert not model.promote(fitted, 0.6, path) and not model.promote(fitted, None, path)
    assert model.promote(fitted, 0.8, path) and model.champion_auc(spark, path) == 0.8
    assert not model.promote(fitted, 0.75, path) and model.promote(fitted, 0.9, path)
    assert model.champion_auc(spark, path) == 0.9
    test = frame.where("fold = 0")
    assert auc_of(model.load_champion(path), test) == auc_of(fitted, test)
