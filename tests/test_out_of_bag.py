"""Out-of-bag votes against a plain loop over rows and bags."""

import hashlib
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from campaignlens.operators import model


def draws(seed, bag, key):
    u = int(hashlib.md5(f"{seed}:{bag}:{key}".encode()).hexdigest()[:12], 16) / 2**48
    below, k = 0.0, 0
    for i in range(12):
        below += math.exp(-1.0) / math.factorial(i)
        k += u >= below
    return k


@pytest.fixture(scope="module")
def train(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        x, y = rnd.random(), rnd.random()
        rows.append((i, 1 + i % 4, float(x + 0.3 * rnd.random() > 0.7), x, y))
    return spark.createDataFrame(rows, "rating_account_id long, fold int, label double, x double, y double").repartition(3).cache()


def test_bootstrap_weights_equal_the_hash_in_python(spark, train):
    got = train.select("rating_account_id", *[model.bootstrap_weight("rating_account_id", b).alias(f"b{b}") for b in range(3)])
    seen = []
    for r in got.collect():
        for b in range(3):
            assert r[f"b{b}"] == draws(42, b, r.rating_account_id)
            seen.append(r[f"b{b}"])
    assert 0.3 < seen.count(0) / len(seen) < 0.43 and 0.8 < sum(seen) / len(seen) < 1.2


def test_votes_equal_a_plain_loop(spark, train):
    models = model.bagged_forests(train, ["x", "y"], bags=4, trees_per_bag=3, max_depth=4, min_leaf=5)
    votes = {r.rating_account_id: r for r in model.out_of_bag_votes(models, train).collect()}
    scores = [
        {r.rating_account_id: r.p for r in m.transform(train).select("rating_account_id", vector_to_array("probability")[1].alias("p")).collect()}
        for m in models
    ]
    right = total = 0
    for r in train.collect():
        own = [scores[b][r.rating_account_id] for b in range(4) if draws(42, b, r.rating_account_id) == 0]
        if not own:
            assert r.rating_account_id not in votes
            continue
        v = votes[r.rating_account_id]
        assert v.votes == len(own) and v.score == pytest.approx(sum(own) / len(own))
        total += 1
        right += (sum(own) / len(own) > 0.5) == (r.label == 1.0)
    found = model.out_of_bag_accuracy(model.out_of_bag_votes(models, train)).first()
    assert found.n == total and found.accuracy == pytest.approx(right / total)
    assert found.accuracy > 0.75


def test_a_bag_is_fitted_on_the_rows_it_drew(spark, train):
    a = model.bagged_forests(train, ["x", "y"], 1, 2, max_depth=3, min_leaf=5)[0]
    b = model.bagged_forests(train.where(model.bootstrap_weight("rating_account_id", 0) > 0), ["x", "y"], 1, 2, max_depth=3, min_leaf=5)[0]
    pa = a.transform(train).select(F.avg(vector_to_array("probability")[1])).first()[0]
    pb = b.transform(train).select(F.avg(vector_to_array("probability")[1])).first()[0]
    assert abs(pa - pb) < 0.1  # the balance weights differ slightly, the rows do not


def test_a_bag_draws_the_rows_that_weigh(spark, train):
    got = train.select("rating_account_id", *[model.bag_draws("rating_account_id", b).alias(f"b{b}") for b in range(3)])
    for r in got.collect():
        assert [r[f"b{b}"] for b in range(3)] == [draws(42, b, r.rating_account_id) > 0 for b in range(3)]
