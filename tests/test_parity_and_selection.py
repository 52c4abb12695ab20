"""Parity by digests, successive halving and pair information against plain counterparts."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from campaignlens.operators import model, profile


def frames(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(50), rnd.choice([None, "a", "b"]), rnd.choice([0.0, -0.0, 1.5, None])) for _ in range(400)]
    return spark.createDataFrame(rows, "k long, s string, x double")


def test_digests_give_the_result_of_the_row_comparison(spark):
    left = frames(spark)
    changed = left.withColumn("s", F.when((F.col("k") == 7) & (F.col("s") == "a"), "z").otherwise(F.col("s")))
    cases = [
        (left, left.repartition(7)), (left, changed), (left, left.unionByName(left.where("k = 3"))), (left, left.where("k < 40")),
        (left.limit(0), left), (left.limit(0), left.limit(0)), (left, left.withColumn("more", F.lit(1))),
        (left, left.withColumn("k", F.col("k").cast("int"))),
    ]
    for a, b in cases:
        want = profile.stage_parity(a, b, "t").first().asDict()
        assert profile.stage_parity_by_digest(a, b, "t", buckets=16).first().asDict() == want


def test_equal_stages_compare_no_row(spark, monkeypatch):
    left = frames(spark)
    monkeypatch.setattr(profile, "stage_parity", lambda *a: pytest.fail("rows were compared"))
    assert profile.stage_parity_by_digest(left, left.repartition(3), "t").first().only_left == 0


@pytest.mark.parametrize("differ", [[], [0], [15], [1, 2, 9], list(range(16))])
def test_listed_buckets_are_found_by_one_look(spark, differ):
    rows = spark.range(16).withColumnRenamed("id", profile._BUCKET)
    listed = rows.where(profile._is_listed(differ, 16))
    assert sorted(r[0] for r in listed.collect()) == differ
    assert "array_contains" not in listed._jdf.queryExecution().analyzed().toString()


def test_copies_do_not_cancel_out(spark):
    one = spark.createDataFrame([("x",)], "s string")
    two = one.unionByName(one)
    r = profile.stage_parity_by_digest(two, two.unionByName(two), "t").first()
    assert (r.only_left, r.only_right, r.right_rows) == (0, 2, 4)


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(900):
        x, y = rnd.random(), rnd.random()
        rows.append((i, i % 5, float(x * y + 0.1 * rnd.random() > 0.35), x, y, rnd.random()))
    return spark.createDataFrame(rows, "rating_account_id long, fold int, label double, x double, y double, z double").cache()


CANDIDATES = [{"num_trees": 5, "min_leaf": m, "max_depth": d} for m, d in ((200, 1), (5, 6), (300, 2), (100, 1))]


def test_survivor_is_the_winner_of_a_full_search(spark, frame):
    table, best = model.successive_halving(frame, ["x", "y", "z"], CANDIDATES)
    train = frame.where("fold <> 0")
    full = {}
    for i, c in enumerate(CANDIDATES):
        fitted = model.fit(train.where("fold <> 4"), ["x", "y", "z"], model.forest(**c))
        scored = model.scores(fitted, train.where("fold = 4")).withColumn("g", F.lit(i))
        full[i] = model.evaluate.roc_auc_by(scored, "g").first().roc_auc
    assert best == CANDIDATES[max(full, key=lambda i: (full[i], -i))]
    rows = table.collect()
    assert Counter(r["round"] for r in rows) == {0: 4, 1: 2} and {r.share for r in rows} == {0.5, 1.0}
    again, same = model.successive_halving(frame, ["x", "y", "z"], CANDIDATES)
    assert same == best and sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_samples_are_nested(frame):
    shares = frame.select("rating_account_id", model.hash_share("rating_account_id").alias("u")).collect()
    assert all(0 <= r.u < 1 for r in shares)
    assert 0.4 < sum(r.u < 0.5 for r in shares) / len(shares) < 0.6


def test_pair_information_and_greedy_choice(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(600):
        a = rnd.choice(["p", "q", None])
        b = a if rnd.random() < 0.9 else "p"
        rows.append((a, b, rnd.random() * 3, int((a == "p") ^ (rnd.random() < 0.1))))
    df = spark.createDataFrame(rows, "a string, b string, x double, y int")
    pairs = model.pair_information(df, ["a", "b", "x", "y"], ["x"], bins=3)
    found = {(r.a, r.b): r for r in pairs.collect()}
    lo, hi = min(r[2] for r in rows), max(r[2] for r in rows)
    cut = [(r[0] or "", r[1] or "", str(min(math.floor((r[2] - lo) * (3 / (hi - lo))), 2)), str(r[3])) for r in rows]
    for i, a in enumerate("abxy"):
        for j, b in enumerate("abxy"):
            if i < j:
                joint, left, right = (Counter((r[i], r[j]) for r in cut), Counter(r[i] for r in cut), Counter(r[j] for r in cut))
                want = sum(c / 600 * math.log(c * 600 / (left[p] * right[q])) for (p, q), c in joint.items())
                assert found[a, b].information == pytest.approx(want) and found[a, b].n == 600
    picked = model.select_without_redundancy(pairs, "y", 2)
    assert picked[0][0] == "a" and picked[1][0] == "x"  # b repeats a
