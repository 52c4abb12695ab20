"""Second-order boosting against brute force and Spark's first-order trees."""

import math
import random

import pytest
from pyspark.sql import functions as F

from campaignlens.operators import boosting, evaluate, model

FEATURES = ["x", "a b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(1200):
        x, y, c = rnd.random(), rnd.randrange(5), rnd.randrange(2)
        chance = 1 / (1 + math.exp(-(6 * (x - 0.5) * (1 if y > 2 else -1) + c - 0.5)))
        rows.append((i, i % 5, float(rnd.random() < chance), x, float(y), float(c)))
    return spark.createDataFrame(rows, "rating_account_id long, fold int, label double, x double, `a b` double, c double").cache()


def test_level_sums_and_gains_equal_brute_force(frame):
    edges = boosting.bin_edges(frame, FEATURES, 8)
    cells = boosting.counted_cells(frame, FEATURES, edges)
    rows = frame.select("label", boosting.bins_of(FEATURES, edges).alias("bins")).collect()
    assert cells.agg(F.sum("n")).first()[0] == len(rows)
    margin = 0.3
    p = 1 / (1 + math.exp(-margin))
    node = "CASE WHEN bins[1] <= 3 THEN 0 ELSE 1 END"
    sums = boosting.level_sums(cells.withColumn("margin", F.lit(margin)), node, 3).collect()
    splits = boosting.best_splits(sums, 1.0, 1.0)
    for side in (0, 1):
        here = [r for r in rows if (r.bins[1] > 3) == bool(side)]
        best = None
        for f in range(3):
            for b in range(8):
                left = [r for r in here if r.bins[f] <= b]
                if not left or len(left) == len(here):
                    continue
                g, h = sum(p - r.label for r in here), len(here) * p * (1 - p)
                gl, hl = sum(p - r.label for r in left), len(left) * p * (1 - p)
                if hl < 1 or h - hl < 1:
                    continue
                gain = 0.5 * (gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1))
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, f, b)
        assert splits[side][0] == pytest.approx(best[0]) and splits[side][1] == best[1]
    for s in sums:
        of = [r for r in rows if (r.bins[1] > 3) == bool(s["node"]) and r.bins[s["feature"]] == s["bin"]]
        assert s["g"] == pytest.approx(sum(p - r.label for r in of)) and s["h"] == pytest.approx(len(of) * p * (1 - p))


def auc(df):
    return evaluate.roc_auc(df).first().roc_auc


def test_auc_is_at_least_that_of_first_order_trees(frame):
    train, test = frame.where("fold <> 0"), frame.where("fold = 0")
    fitted = boosting.boost(train, FEATURES, rounds=12, depth=3, step=0.3, bins=16)
    first = model.fit(train, FEATURES, model.boosted(max_iter=12, max_depth=3, step=0.3))
    mine = boosting.scores(fitted, test)
    assert auc(mine) >= auc(model.scores(first, test)) - 0.01 and auc(mine) > 0.7
    assert mine.count() == test.count()
    again = boosting.boost(train.repartition(5), FEATURES, rounds=12, depth=3, step=0.3, bins=16)
    assert [t.sql(lambda n: f"{n.weight:.6f}") for t in again.trees] == [t.sql(lambda n: f"{n.weight:.6f}") for t in fitted.trees]


def test_cells_stay_few_whatever_the_rows(spark):
    many = spark.range(50_000).select(F.col("id").alias("rating_account_id"), (F.col("id") % 2).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    cells = boosting.counted_cells(many, ["x"], boosting.bin_edges(many, ["x"], 8))
    assert cells.count() <= 2 * boosting.SLICES


def test_constant_and_missing_features(spark):
    rows = spark.createDataFrame([(i, float(i % 2), 1.0, None) for i in range(60)], "rating_account_id long, label double, k double, z double")
    fitted = boosting.boost(rows, ["k", "z"], rounds=2, depth=2, subsample=1.0)
    assert [round(r.score, 6) for r in boosting.scores(fitted, rows).collect()] == [0.5] * 60
