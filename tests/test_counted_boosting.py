"""Boosted trees on counted feature vectors against Spark's."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier

from campaignlens.operators import counted_boosting, model

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


def both(frame, subsample):
    train, test = frame.where("fold <> 0"), frame.where("fold = 0")
    settings = dict(maxIter=12, maxDepth=3, stepSize=0.1, subsamplingRate=subsample, seed=42)
    ours = model.fit(train, NAMES, model.boosted(12, 3, 0.1, subsample))
    theirs = model.fit(train, NAMES, GBTClassifier(featuresCol="features", labelCol="label", **settings))
    assert isinstance(ours.stages[-1], counted_boosting.CountedBoostedModel)
    a, b = ({r.rating_account_id: r.score for r in model.scores(m, test).collect()} for m in (ours, theirs))
    assert a.keys() == b.keys()
    return ours, theirs, [a[k] for k in sorted(a)], [b[k] for k in sorted(a)]


def test_rows_that_repeat_are_counted_and_score_as_sparks_do(spark, frame):
    ours, theirs, a, b = both(frame, 1.0)
    assert a == pytest.approx(b, abs=1e-9)
    x, y = (m.stages[-1].featureImportances.toArray() for m in (ours, theirs))
    assert x == pytest.approx(y, abs=1e-6)


def test_drawn_rows_score_nearly_as_sparks_do(spark, frame):
    _, _, a, b = both(frame, 0.8)
    assert np.mean(np.abs(np.subtract(a, b))) < 0.03


def test_rows_that_do_not_repeat_go_to_sparks_trees(spark):
    rnd = random.Random(1)
    few = spark.createDataFrame([(i, float(i % 2), rnd.random()) for i in range(300)], "rating_account_id long, label double, a double")
    assert isinstance(model.fit(few, ["a"], model.boosted(2)).stages[-1], GBTClassificationModel)


def test_a_stored_model_scores_alike(spark, frame, tmp_path):
    fitted = model.fit(frame.where("fold <> 0"), NAMES, model.boosted(4))
    assert model.promote(fitted, 0.9, f"file://{tmp_path}/champion")
    test = frame.where("fold = 0")
    want = {tuple(r) for r in model.scores(fitted, test).collect()}
    assert {tuple(r) for r in model.scores(model.load_champion(f"file://{tmp_path}/champion"), test).collect()} == want
