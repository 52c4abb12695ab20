"""Profiles: drift (PSI) against a brute-force computation."""

import math

from pyspark.sql import functions as F

from campaignlens.operators import profile


def _psi_brute(rows, numeric, categorical, bins=10, eps=1e-6):
    out = {}
    for c in numeric:
        vals = [(r[c], r["side"]) for r in rows if r[c] is not None]
        lo, hi = min(v for v, _ in vals), max(v for v, _ in vals)
        def b(v):
            return 0 if hi == lo else min(math.floor((v - lo) * (bins / (hi - lo))), bins - 1)
        out[c] = [(str(b(v)), s) for v, s in vals]
    for c in categorical:
        out[c] = [(r[c], r["side"]) for r in rows if r[c] is not None]
    psi = {}
    for c, pairs in out.items():
        te = sum(1 for _, s in pairs if s == "e")
        ta = sum(1 for _, s in pairs if s == "a")
        total = 0.0
        for k in {k for k, _ in pairs}:
            pe = max(sum(1 for x, s in pairs if x == k and s == "e") / te, eps)
            pa = max(sum(1 for x, s in pairs if x == k and s == "a") / ta, eps)
            total += (pa - pe) * math.log(pa / pe)
        psi[c] = total
    return psi


def test_psi_one_frame_equals_two_samples_and_brute_force(spark):
    rows = []
    for i in range(200):
        side = "a" if i % 3 == 0 else "e"
        x = None if i % 17 == 0 else float((i * 7) % 50 + (5 if side == "a" else 0))
        brand = None if i % 23 == 0 else ["A", "B", "C"][(i * (2 if side == "a" else 1)) % 3]
        rows.append({"x": x, "brand": brand, "side": side})
    df = spark.createDataFrame(rows, "x double, brand string, side string")
    one = {r.feature: r.psi for r in profile.population_stability_by(
        df, F.col("side") == "a", ["x"], ["brand"]).collect()}
    two = {r.feature: r.psi for r in profile.population_stability(
        df.where("side = 'e'"), df.where("side = 'a'"), ["x"], ["brand"]).collect()}
    want = _psi_brute(rows, ["x"], ["brand"])
    assert set(one) == set(two) == set(want) == {"x", "brand"}
    for c in want:
        assert math.isclose(one[c], want[c], rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(two[c], want[c], rel_tol=1e-9, abs_tol=1e-12)


def test_describe_numeric_equals_pandas(spark):
    import pandas as pd

    rows = [(float(i % 7) * 1.5, 3.0 if i == 0 else None, float(i) if i % 5 else float("nan")) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, single double, b double")
    got = {r.column_name: r for r in profile.describe_numeric(df, ["a", "single", "b"]).collect()}
    pdf = pd.DataFrame(rows, columns=["a", "single", "b"])
    for c in ["a", "single", "b"]:
        want = pdf[c].describe()
        r = got[c]
        assert r["count"] == int(want["count"])
        for mine, theirs in [("mean", "mean"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("max", "max")]:
            assert math.isclose(r[mine], want[theirs], rel_tol=1e-12), (c, mine)
        if want["count"] > 1:
            assert math.isclose(r["std"], want["std"], rel_tol=1e-9), c
        else:
            assert r["std"] is None
