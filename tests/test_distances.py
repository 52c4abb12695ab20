"""Drift distances against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from campaignlens.operators import profile


def plain(e, a):
    if not e or not a:
        return None, None
    points = sorted(set(e) | set(a))

    def gap(x):
        return abs(sum(v <= x for v in e) / len(e) - sum(v <= x for v in a) / len(a))

    return max(map(gap, points)), sum(gap(x) * (y - x) for x, y in zip(points, points[1:]))


def test_distances_equal_plain_python(spark):
    rnd = random.Random(2)
    rows = [
        (rnd.random() < 0.3, rnd.choice([None, float("nan"), rnd.gauss(0, 1), 0.5]), rnd.randrange(4), float(i), 7.0)
        for i in range(400)
    ] + [(None, 1.0, 1, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "side boolean, x double, `a b` long, z double, same double")
    found = {r.feature: r for r in profile.distribution_distances(df, F.col("side"), ["x", "a b", "z", "same"]).collect()}
    for j, c in enumerate(["x", "a b", "z", "same"], 1):
        have = [r for r in rows if r[j] is not None and r[j] == r[j]]
        e, a = [r[j] for r in have if not r[0]], [r[j] for r in have if r[0]]
        ks, area = plain(e, a)
        assert found[c].n_expected == len(e) and found[c].n_actual == len(a)
        assert found[c].ks == pytest.approx(ks) and found[c].wasserstein == pytest.approx(area)


def test_one_side_missing_and_equal_samples(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 2.0)], "side boolean, x double")
    r = profile.distribution_distances(df, F.col("side"), ["x"]).first()
    assert r.ks is None and r.wasserstein is None and r.n_actual == 2
    both = df.unionByName(df.withColumn("side", F.lit(False)))
    r = profile.distribution_distances(both, F.col("side"), ["x"]).first()
    assert r.ks == 0.0 and r.wasserstein == 0.0


def test_a_hot_value_and_an_empty_table(spark):
    df = spark.range(6000).select((F.col("id") % 2 == 0).alias("side"), F.when(F.col("id") % 3 == 0, F.col("id") / 7).otherwise(0.0).alias("x"))
    rows = df.collect()
    r = profile.distribution_distances(df, F.col("side"), ["x"]).first()
    e, a = [x.x for x in rows if not x.side], [x.x for x in rows if x.side]
    import bisect

    e.sort(), a.sort()
    points = sorted(set(e) | set(a))
    gaps = [abs(bisect.bisect_right(e, p) / len(e) - bisect.bisect_right(a, p) / len(a)) for p in points]
    assert r.ks == pytest.approx(max(gaps))
    assert r.wasserstein == pytest.approx(sum(g * (q - p) for g, p, q in zip(gaps, points, points[1:])))
    assert profile.distribution_distances(df.where("false"), F.col("side"), ["x"]).count() == 0
