"""The forest on counted feature vectors against Spark's, and its parts against plain counterparts."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier

from campaignlens.operators import counted_forest, evaluate, model, split

NAMES = ["a", "b", "c", "k"]


@pytest.fixture(scope="module")
def frame(spark):
    """Few distinct vectors; a and c tell the label, k is constant."""
    rnd = random.Random(5)
    rows = []
    for i in range(4000):
        a, b, c = rnd.randrange(2), rnd.randrange(2), rnd.randrange(6)
        rows.append((i, i % 5, float(rnd.random() < 0.1 + 0.3 * a + 0.08 * c), float(a), float(b), float(c), 1.0))
    return spark.createDataFrame(rows, "rating_account_id long, fold int, label double, a double, b double, c double, k double").cache()


def test_rows_that_repeat_are_counted_and_rank_as_sparks_forest_does(spark, frame):
    train, test = frame.where("fold <> 0"), frame.where("fold = 0")
    ours = model.fit(train, NAMES, model.forest(num_trees=30, min_leaf=20))
    assert isinstance(ours.stages[-1], counted_forest.CountedForestModel)
    plain = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=30, minInstancesPerNode=20,
                                   maxDepth=30, featureSubsetStrategy="sqrt", seed=1)
    theirs = model.fit(train, NAMES, plain)
    a, b = ({r.rating_account_id: r.score for r in model.scores(m, test).collect()} for m in (ours, theirs))
    assert a.keys() == b.keys() and np.mean([abs(a[k] - b[k]) for k in a]) < 0.03
    auc = [evaluate.roc_auc(model.scores(m, test)).first().roc_auc for m in (ours, theirs)]
    assert auc[0] == pytest.approx(auc[1], abs=0.02)
    x, y = (m.stages[-1].featureImportances.toArray() for m in (ours, theirs))
    assert x == pytest.approx(y, abs=0.1) and x[3] == 0.0 and x.sum() == pytest.approx(1.0)


def test_rows_that_do_not_repeat_go_to_sparks_forest(spark):
    rnd = random.Random(1)
    rows = [(i, float(i % 2), rnd.random()) for i in range(300)]
    few = spark.createDataFrame(rows, "rating_account_id long, label double, a double")
    assert isinstance(model.fit(few, ["a"], model.forest(num_trees=2)).stages[-1], RandomForestClassificationModel)


def test_a_tree_without_bootstrap_splits_as_sparks_tree_does(spark, frame):
    weighted = model.assembler(["a", "b", "c"]).transform(split.with_class_weight(frame, "label"))
    table = counted_forest.counted(weighted, "features", "label", "weight").orderBy("x").toPandas()
    x, n, w = np.array(table.x.tolist()), table[["n0", "n1"]].to_numpy(float), table[["w0", "w1"]].to_numpy(float)
    cuts = [counted_forest.thresholds(x[:, f], n.sum(1), 32) for f in range(3)]
    bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1)
    f, b, left, p, _ = counted_forest.grow(bins, n.sum(1), w, 3, 50, 4, np.random.default_rng(0))
    at = np.array([cuts[i][j] if i >= 0 else 0.0 for i, j in zip(f, b)])
    plain = RandomForestClassifier(weightCol="weight", numTrees=1, minInstancesPerNode=50, maxDepth=4, featureSubsetStrategy="all",
                                   bootstrap=False, seed=1).fit(weighted)
    want = {tuple(r.features): r.probability[1] for r in plain.transform(weighted).select("features", "probability").distinct().collect()}
    got = dict(zip(map(tuple, x), counted_forest.score_vectors(x, [(f, at, left, p)])))
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_a_stored_model_scores_alike(spark, frame, tmp_path):
    fitted = model.fit(frame.where("fold <> 0"), NAMES, model.forest(num_trees=4))
    assert model.promote(fitted, 0.9, f"file://{tmp_path}/champion")
    test = frame.where("fold = 0")
    want = {tuple(r) for r in model.scores(fitted, test).collect()}
    assert {tuple(r) for r in model.scores(model.load_champion(f"file://{tmp_path}/champion"), test).collect()} == want


def test_thresholds_follow_the_rows():
    values = np.arange(100.0)
    assert list(counted_forest.thresholds(np.array([0.0, 1.0, 1.0, 4.0]), np.ones(4), 32)) == [0.5, 2.5]
    assert len(counted_forest.thresholds(values, np.ones(100), 10)) == 9
    assert counted_forest.thresholds(values, np.where(values < 50, 99.0, 1.0), 10).max() < 60
