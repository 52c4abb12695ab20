"""Ranking metrics against brute-force numpy versions of the usual formulas."""

import numpy as np
import pytest

from campaignlens.operators import evaluate


def brute_ap(y, s):
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    P = y.sum()
    ap, tp, fp, i = 0.0, 0, 0, 0
    while i < len(ss):
        j = i
        while j < len(ss) and ss[j] == ss[i]:
            j += 1
        blk = ys[i:j]
        tp += blk.sum(); fp += len(blk) - blk.sum()
        ap += blk.sum() / P * tp / (tp + fp)
        i = j
    return ap


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def brute_pk(y, s, keys, kf, rule):
    order = np.lexsort((keys, -s))
    n = len(y)
    k = max(1, int(round(kf * n))) if rule == "round" else max(1, int(n * kf))
    tp = y[order][:k].sum()
    return k, tp


def frame(spark, y, s):
    rows = [(int(i), int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))]
    return spark.createDataFrame(rows, "rating_account_id long, has_done_upselling int, score double")


@pytest.mark.parametrize("seed", [1, 2])
def test_ap_auc_with_ties(spark, seed):
    rnd = np.random.default_rng(seed)
    s = np.round(rnd.random(400), 1)  # heavy ties across labels
    y = (rnd.random(400) < 0.3).astype(int)
    df = frame(spark, y, s)
    ap = evaluate.average_precision(df).first().average_precision
    auc = evaluate.roc_auc(df).first().roc_auc
    assert ap == pytest.approx(brute_ap(y, s), abs=1e-12)
    assert auc == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_auc_invariant_to_monotone_map(spark):
    rnd = np.random.default_rng(5)
    s = rnd.random(300)
    y = (rnd.random(300) < 0.2).astype(int)
    a1 = evaluate.roc_auc(frame(spark, y, s)).first().roc_auc
    a2 = evaluate.roc_auc(frame(spark, y, s ** 3)).first().roc_auc
    assert a1 == pytest.approx(a2)


def test_no_positives_gives_null(spark):
    df = frame(spark, np.zeros(10, int), np.linspace(0, 1, 10))
    assert evaluate.average_precision(df).first().average_precision is None
    assert evaluate.roc_auc(df).first().roc_auc is None


def test_all_positives(spark):
    df = frame(spark, np.ones(10, int), np.linspace(0, 1, 10))
    assert evaluate.average_precision(df).first().average_precision == 1.0
    assert evaluate.roc_auc(df).first().roc_auc is None


@pytest.mark.parametrize("n", [1, 10, 30, 50])
@pytest.mark.parametrize("rule", ["round", "floor"])
def test_precision_at_k_rounding(spark, n, rule):
    rnd = np.random.default_rng(n)
    s = np.round(rnd.random(n), 1)
    y = (rnd.random(n) < 0.4).astype(int)
    got = {r.k_frac: r for r in evaluate.precision_at_k(frame(spark, y, s), rule=rule).collect()}
    for kf in (0.05, 0.10, 0.20):
        k, tp = brute_pk(y, s, np.arange(n), kf, rule)
        assert got[kf].k_n == k and got[kf].tp == tp
        assert got[kf].precision_at_k == pytest.approx(tp / k)


def test_top_k_has_exactly_k_rows(spark):
    rnd = np.random.default_rng(9)
    df = frame(spark, (rnd.random(205) < 0.1).astype(int), np.round(rnd.random(205), 1))
    assert evaluate.top_k_targets(df, 0.1).count() == max(1, round(0.1 * 205))


def test_threshold_is_inclusive(spark):
    df = frame(spark, np.array([1, 0, 1]), np.array([0.5, 0.5, 0.49]))
    m = {r.actual: (r.pred_0, r.pred_1) for r in evaluate.confusion_at_threshold(df, 0.5).collect()}
    assert m == {0: (0, 1), 1: (1, 1)}


def test_budget_matrix_without_positives(spark):
    df = frame(spark, np.zeros(20, int), np.linspace(0, 1, 20))
    m = {r.actual: (r.pred_0, r.pred_1) for r in evaluate.confusion_at_budget(df, 0.1).collect()}
    assert m == {0: (18, 2), 1: (0, 0)}


def test_grouped_auc_equals_per_group(spark):
    rnd = np.random.default_rng(11)
    rows = []
    for g in ("a", "b", "c"):
        s = np.round(rnd.random(200), 1)
        y = (rnd.random(200) < 0.3).astype(int)
        rows += [(g, int(i), int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))]
    df = spark.createDataFrame(rows, "g string, rating_account_id long, has_done_upselling int, score double")
    got = {r.g: r.roc_auc for r in evaluate.roc_auc_by(df, "g").collect()}
    for g in ("a", "b", "c"):
        want = evaluate.roc_auc(df.where(df.g == g)).first().roc_auc
        assert got[g] == pytest.approx(want, abs=1e-12)


def test_normalised_matrix_rounds_half_even(spark):
    # 1/32 = 0.03125 and 31/32 = 0.96875 are exact binary ties at the 5th digit (T22).
    m = spark.createDataFrame([(0, 1, 31), (1, 0, 0)], "actual int, pred_0 long, pred_1 long")
    got = {r.actual: (r.pred_0, r.pred_1) for r in evaluate.normalise_rows(m).collect()}
    assert got[0] == (0.0312, 0.9688)
    assert got[1] == (None, None)


def test_score_ties_rank_by_ascending_key(spark):
    rows = [(30, 1, 0.5), (10, 0, 0.5), (20, 0, 0.9), (40, 1, 0.5)]
    df = spark.createDataFrame(rows, "rating_account_id long, has_done_upselling int, score double")
    got = [r.rating_account_id for r in evaluate.ranked(df).orderBy("rank").collect()]
    assert got == [20, 10, 30, 40]
