"""Ranking and threshold metrics over ``(key, label, score)`` frames.

Average precision and ROC AUC are computed from the distinct-score curve:
rows are first aggregated per distinct score (map-side combine), then the
running positive/negative counts come from the distributed prefix sum.
Top-k metrics use the distributed position with ties broken by the key.
Scalar inputs (row count, positives) enter as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators.rank import with_position, with_prefix_sums
from campaignlens.session import ensure_checkpoint_dir


def score_curve(scored: DataFrame, label: str = S.LABEL, score: str = "score") -> DataFrame:
    """Distinct scores, descending, with ``tp``/``fp`` and running ``cum_tp``/``cum_fp``."""
    by_score = scored.groupBy(score).agg(
        F.sum(F.col(label).cast("long")).alias("tp"),
        F.sum((F.lit(1) - F.col(label)).cast("long")).alias("fp"),
    )
    return with_prefix_sums(by_score, [F.col(score).desc()], ["tp", "fp"], position="score_rank")


def _ap_expr() -> Column:
    prec = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    return F.try_divide(F.sum(F.col("tp") * prec), F.sum("tp")).alias("average_precision")


def _auc_expr() -> Column:
    above = F.col("cum_tp") - F.col("tp") / F.lit(2.0)
    return F.try_divide(F.sum(F.col("fp") * above), F.sum("tp").cast("double") * F.sum("fp")).alias("roc_auc")


def average_precision(scored: DataFrame, label: str = S.LABEL, score: str = "score") -> DataFrame:
    """Step-wise average precision: sum over thresholds of delta-recall x precision."""
    return score_curve(scored, label, score).agg(_ap_expr())


def roc_auc(scored: DataFrame, label: str = S.LABEL, score: str = "score") -> DataFrame:
    """Area under the ROC curve with ties counted half (trapezoid on the curve)."""
    return score_curve(scored, label, score).agg(_auc_expr())


def curve_metrics(scored: DataFrame, label: str = S.LABEL, score: str = "score") -> DataFrame:
    """``average_precision`` and ``roc_auc`` from one distinct-score curve (one ordering pass)."""
    return score_curve(scored, label, score).agg(_ap_expr(), _auc_expr())


def roc_auc_by(scored: DataFrame, group: str, label: str = S.LABEL, score: str = "score") -> DataFrame:
    """ROC AUC per ``group`` in one pass: ``(group, roc_auc)``."""
    by_score = scored.groupBy(group, score).agg(
        F.sum(F.col(label).cast("long")).alias("tp"),
        F.sum((F.lit(1) - F.col(label)).cast("long")).alias("fp"),
    )
    return roc_auc_of_counts(by_score, group, score)


def roc_auc_of_counts(by_score: DataFrame, group: str, score: str = "score") -> DataFrame:
    """ROC AUC per ``group`` of its distinct scores with ``tp`` and ``fp``: ``(group, roc_auc)``.

    The distinct-score curve of every group is ordered by (group, score desc)
    with the distributed prefix sum, which stores it, so the rows are scored
    once; the running counts of earlier groups are subtracted with offsets from
    a per-group summary (one row per group).
    """
    seq = with_prefix_sums(by_score, [F.col(group).asc(), F.col(score).desc()], ["tp", "fp"], position="_r")
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    totals = seq.groupBy(group).agg(F.sum("tp").alias("_P"), F.sum("fp").alias("_N"))
    offsets = F.broadcast(totals.select(
        group, "_P", "_N", F.coalesce(F.sum("_P").over(before), F.lit(0)).alias("_off_tp"),
    ))
    within = F.col("cum_tp") - F.col("_off_tp")
    return seq.join(offsets, group).groupBy(group).agg(
        F.try_divide(F.sum(F.col("fp") * (within - F.col("tp") / F.lit(2.0))),
                     F.first("_P").cast("double") * F.first("_N")).alias("roc_auc")
    )


def ranked(scored: DataFrame, key: str = S.KEY, score: str = "score") -> DataFrame:
    """Rows with ``rank``: 1 = highest score, ties by ascending key."""
    return with_position(scored, [F.col(score).desc(), F.col(key).asc()], name="rank")


def _counts(r: DataFrame, label: str) -> tuple[int, int]:
    """Row and positive counts, read from the checkpointed rank frame (two numbers)."""
    row = r.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("pos")).first()
    return int(row.n), int(row.pos)


def rank_once(scored: DataFrame, label: str = S.LABEL, key: str = S.KEY,
              score: str = "score") -> tuple[DataFrame, int, int]:
    """The ranked (checkpointed) frame with its row and positive counts."""
    r = ranked(scored, key, score)
    n, pos = _counts(r, label)
    return r, n, pos


def k_of(n: int, fraction: float, rule: str = "round") -> int:
    """Budget size: ``max(1, round(fraction * n))`` (half-even) or the floor rule."""
    if rule == "round":
        return max(1, int(round(fraction * n)))
    if rule == "floor":
        return max(1, int(n * fraction))
    raise ValueError(rule)


def precision_at_k(
    scored: DataFrame,
    fractions: Sequence[float] = S.TOP_K_FRACTIONS,
    rule: str = "round",
    label: str = S.LABEL,
    key: str = S.KEY,
    score: str = "score",
    ranking: tuple[DataFrame, int, int] | None = None,
) -> DataFrame:
    """``k_frac, k_n, tp, precision_at_k, recall_at_k, lift_at_k`` per fraction.

    ``ranking`` is an already ranked frame with its row and positive
    counts (from ``rank_once``), shared by several top-k metrics.
    """
    r, n, pos = ranking or rank_once(scored, label, key, score)
    ks = [k_of(n, f, rule) for f in fractions]
    agg = r.agg(
        *[F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col(label))), F.lit(0)).cast("long").alias(f"tp{i}")
          for i, k in enumerate(ks)]
    )
    rate = pos / n if n else 0.0
    rows = []
    for i, (f, k) in enumerate(zip(fractions, ks)):
        tp = F.col(f"tp{i}")
        prec = tp / F.lit(k)
        rows.append(
            F.struct(
                F.lit(f).alias("k_frac"),
                F.lit(k).cast("long").alias("k_n"),
                tp.alias("tp"),
                prec.alias("precision_at_k"),
                (tp / F.lit(max(pos, 1))).alias("recall_at_k"),
                (prec / F.lit(max(rate, 1e-12))).alias("lift_at_k"),
            )
        )
    return agg.select(F.inline(F.array(*rows)))


def _matrix(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    return F.inline(
        F.array(
            F.struct(F.lit(0).alias("actual"), tn.alias("pred_0"), fp.alias("pred_1")),
            F.struct(F.lit(1).alias("actual"), fn.alias("pred_0"), tp.alias("pred_1")),
        )
    )


def confusion_at_budget(
    scored: DataFrame, fraction: float = S.BUDGET_FRACTION, label: str = S.LABEL,
    key: str = S.KEY, score: str = "score", ranking: tuple[DataFrame, int, int] | None = None,
) -> DataFrame:
    """Matrix when the top ``fraction`` of contracts is contacted.

    Uses the true positive count (the reference floors it at 1, which
    shifts fn/tn by one when the fold holds no positive).
    """
    r, n, pos = ranking or rank_once(scored, label, key, score)
    k = k_of(n, fraction)
    agg = r.agg(F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col(label))), F.lit(0)).cast("long").alias("tp"))
    tp = F.col("tp")
    fp = F.lit(k) - tp
    fn = F.lit(pos) - tp
    tn = F.lit(n - pos) - fp
    return agg.select(_matrix(tn, fp, fn, tp))


def _threshold_counts(scored: DataFrame, threshold: float, label: str, score: str) -> DataFrame:
    pred = F.col(score) >= F.lit(threshold)
    y = F.col(label) == 1
    return scored.agg(
        F.count_if(~y & ~pred).alias("tn"),
        F.count_if(~y & pred).alias("fp"),
        F.count_if(y & ~pred).alias("fn"),
        F.count_if(y & pred).alias("tp"),
    )


def confusion_at_threshold(
    scored: DataFrame, threshold: float = S.DECISION_THRESHOLD, label: str = S.LABEL, score: str = "score"
) -> DataFrame:
    """Matrix of ``score >= threshold`` against the label (one pass)."""
    c = _threshold_counts(scored, threshold, label, score)
    return c.select(_matrix(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def normalise_rows(matrix: DataFrame, digits: int = 4) -> DataFrame:
    """Each actual-class row divided by its total, rounded half-even."""
    total = F.col("pred_0") + F.col("pred_1")
    return matrix.select(
        "actual",
        F.bround(F.try_divide(F.col("pred_0").cast("double"), total), digits).alias("pred_0"),
        F.bround(F.try_divide(F.col("pred_1").cast("double"), total), digits).alias("pred_1"),
    )


def classification_report(
    scored: DataFrame, threshold: float = S.NOTEBOOK_THRESHOLD, label: str = S.LABEL, score: str = "score"
) -> DataFrame:
    """Per-class precision/recall/f1/support, accuracy, macro and weighted means.

    An empty denominator gives 0, as the usual report does.
    """
    c = _threshold_counts(scored, threshold, label, score)
    return c.select(F.inline(F.array(*report_rows(*(F.col(x) for x in ("tn", "fp", "fn", "tp"))))))


def report_rows(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    """Rows ``(class_label, precision, recall, f1_score, support)`` of a class report from its four counts."""

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    p1, r1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    p0, r0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    f1_1 = ratio(2 * p1 * r1, p1 + r1)
    f1_0 = ratio(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1

    def row(name: str, p, r, f, s) -> Column:
        return F.struct(
            F.lit(name).alias("class_label"),
            (p if p is not None else F.lit(None).cast("double")).alias("precision"),
            (r if r is not None else F.lit(None).cast("double")).alias("recall"),
            f.alias("f1_score"),
            s.cast("long").alias("support"),
        )

    def wmean(a0: Column, a1: Column) -> Column:
        return ratio(a0 * s0 + a1 * s1, n)

    return [
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", None, None, ratio(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", wmean(p0, p1), wmean(r0, r1), wmean(f1_0, f1_1), n),
    ]


def gains_curve(scored: DataFrame, label: str = S.LABEL, key: str = S.KEY, score: str = "score") -> DataFrame:
    """Every row with its rank and the positives at or above it (a missing label counts as none)."""
    y = scored.select(key, label, score, F.coalesce(F.col(label).cast("long"), F.lit(0)).alias("_y"))
    out = with_prefix_sums(y, [F.col(score).desc(), F.col(key).asc()], ["_y"], position="rank")
    return out.select(key, label, score, "rank", F.col("cum__y").alias("cum_pos"))


def top_k_targets(
    scored: DataFrame, fraction: float = S.BUDGET_FRACTION, key: str = S.KEY, score: str = "score"
) -> DataFrame:
    """The contact list: the top ``fraction`` of rows by score."""
    r = ranked(scored, key, score)
    n = r.count()
    return r.where(F.col("rank") <= k_of(n, fraction)).select(key, score, "rank")


def base_rate(scored: DataFrame, label: str = S.LABEL) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positives"),
        F.avg(F.col(label).cast("double")).alias("pos_rate"),
    )


def eval_report(scored: DataFrame, label: str = S.LABEL, key: str = S.KEY, score: str = "score") -> DataFrame:
    """All headline metrics in long form ``(metric, value)``.

    The narrow scored rows are stored once (checkpoint) and feed every metric.
    AP and ROC AUC come from one score curve, the top-k metrics and the budget
    matrix from one ranking, and the base rate and both threshold matrices
    from one aggregate.
    """
    ensure_checkpoint_dir(scored.sparkSession)
    scored = scored.select(key, label, score).checkpoint(eager=True)
    ranking = rank_once(scored, label, key, score)
    _, n, pos = ranking

    def listed(df: DataFrame, pairs: list[tuple[Column, Column]]) -> DataFrame:
        rows = [F.struct(m.alias("metric"), v.cast("double").alias("value")) for m, v in pairs]
        return df.select(F.inline(F.array(*rows)))

    def cells(name: str) -> list[tuple[Column, Column]]:
        return [
            (F.concat(F.lit(name + "["), F.col("actual"), F.lit(f",{p}]")), F.col(f"pred_{p}")) for p in (0, 1)
        ]

    matrix = confusion_at_threshold(scored, label=label, score=score)
    pct = F.concat((F.round(F.col("k_frac") * 100)).cast("int").cast("string"), F.lit("%"))
    at_k = [("P@", "precision_at_k"), ("R@", "recall_at_k"), ("Lift@", "lift_at_k"), ("k_n@", "k_n")]
    curve = curve_metrics(scored, label, score)
    parts = [
        listed(curve, [
            (F.lit("BaselinePosRate"), F.lit(pos / n if n else None)),
            (F.lit("PR_AUC"), F.col("average_precision")),
            (F.lit("ROC_AUC"), F.col("roc_auc")),
            (F.lit("DecisionThreshold"), F.lit(S.DECISION_THRESHOLD)),
        ]),
        listed(
            precision_at_k(scored, label=label, key=key, score=score, ranking=ranking),
            [(F.concat(F.lit(m), pct), F.col(c)) for m, c in at_k],
        ),
        listed(
            confusion_at_budget(scored, label=label, key=key, score=score, ranking=ranking),
            cells("ConfusionMatrix@10%"),
        ),
        listed(matrix, cells("ConfusionMatrix@Threshold")),
        listed(normalise_rows(matrix), cells("ConfusionMatrixRowNorm@Threshold")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
