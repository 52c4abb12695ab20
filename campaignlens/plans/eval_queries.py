"""Registered queries: split, scores and evaluation (rule score, test fold)."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators import evaluate, scoring, split
from campaignlens.plans import flow
from campaignlens.plans.oracle_views import with_views
from campaignlens.plans.registry import DIGITS, register, round_doubles, sql_round

# A contract without a customer is a group of its own.
GROUP_SQL = "coalesce('customer ' || customer_id, 'account ' || CAST(rating_account_id AS VARCHAR))"


def _groups_sql(view: str) -> str:
    return (
        f"SELECT {GROUP_SQL} AS grp, customer_id, count(*) AS n_rows, "
        f"CAST(coalesce(sum(has_done_upselling), 0) AS BIGINT) AS n_pos FROM {view} GROUP BY grp, customer_id"
    )


_DEAL_ORDER = "n_pos DESC, n_rows DESC, md5('42:' || coalesce(customer_id, grp)), grp"

EVAL_CTES = [
    ("cust", _groups_sql("core_data")),
    ("cust_ranked", f"SELECT *, row_number() OVER (ORDER BY {_DEAL_ORDER}) - 1 AS r FROM cust"),
    (
        "folds",
        "SELECT grp, customer_id, n_rows, n_pos, "
        "CAST(CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS INTEGER) AS fold FROM cust_ranked",
    ),
    (
        "scored_all",
        "SELECT p.rating_account_id, p.customer_id, p.has_done_upselling, "
        "least(greatest(CAST("
        "CASE WHEN age < 45 THEN 20 ELSE 0 END"
        " + CASE WHEN contract_lifetime_days BETWEEN 300 AND 1460 THEN 15 ELSE 0 END"
        " + CASE WHEN remaining_binding_days < 60 THEN 10 ELSE 0 END"
        " + CASE WHEN is_magenta1_customer = 1 THEN 10 ELSE 0 END"
        " + CASE WHEN available_gb_value <= 20 THEN 20 ELSE 0 END"
        " + CASE WHEN gross_mrc < 35 THEN 10 ELSE 0 END AS DOUBLE) / 100.0, 0.0), 1.0) AS score, f.fold "
        "FROM (SELECT *, CASE WHEN available_gb_missing = 0 THEN available_gb END AS available_gb_value "
        f"FROM processed_core) p LEFT JOIN folds f ON {GROUP_SQL.replace('customer_id', 'p.customer_id')} = f.grp",
    ),
    ("test", "SELECT rating_account_id, has_done_upselling, score FROM scored_all WHERE fold = 0"),
    (
        "test_counts",
        "SELECT count(*) AS n, CAST(coalesce(sum(has_done_upselling), 0) AS BIGINT) AS pos FROM test",
    ),
    (
        "test_ranked",
        "SELECT *, row_number() OVER (ORDER BY score DESC, rating_account_id) AS rank FROM test",
    ),
    (
        "curve",
        "SELECT score, sum(has_done_upselling) AS tp, sum(1 - has_done_upselling) AS fp FROM test GROUP BY score",
    ),
    (
        "curve_cum",
        "SELECT *, sum(tp) OVER w AS cum_tp, sum(fp) OVER w AS cum_fp FROM curve "
        "WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    ),
    (
        "ap",
        "SELECT sum(tp * cum_tp / (cum_tp + cum_fp)) / nullif(sum(tp), 0) AS average_precision FROM curve_cum",
    ),
    (
        "auc",
        "SELECT sum(fp * (cum_tp - tp / 2.0)) / nullif(CAST(sum(tp) AS DOUBLE) * sum(fp), 0) AS roc_auc "
        "FROM curve_cum",
    ),
    (
        "budget",
        "SELECT b.*, CAST(coalesce((SELECT sum(has_done_upselling) FROM test_ranked WHERE rank <= b.k), 0) "
        "AS BIGINT) AS tp FROM (SELECT CAST(greatest(1, round_even(CAST(0.1 AS DOUBLE) * n, 0)) AS BIGINT) AS k, "
        "n, pos FROM test_counts) b",
    ),
    (
        "thr",
        "SELECT count(*) FILTER (WHERE has_done_upselling <> 1 AND NOT score >= {t}) AS tn, "
        "count(*) FILTER (WHERE has_done_upselling <> 1 AND score >= {t}) AS fp, "
        "count(*) FILTER (WHERE has_done_upselling = 1 AND NOT score >= {t}) AS fn, "
        "count(*) FILTER (WHERE has_done_upselling = 1 AND score >= {t}) AS tp FROM test",
    ),
]


def _ctes(threshold: float = S.DECISION_THRESHOLD) -> list[tuple[str, str]]:
    return [(n, s.replace("{t}", f"CAST({threshold} AS DOUBLE)")) for n, s in EVAL_CTES]


def eval_sql(
    body: str, doubles: list[str] | None = None, threshold: float = S.DECISION_THRESHOLD, digits: int = DIGITS
) -> str:
    return sql_round(with_views(body, extra=_ctes(threshold)), doubles or [], digits)


def _pk_sql(rule: str) -> str:
    kexpr = "round_even(CAST(kf AS DOUBLE) * n, 0)" if rule == "round" else "floor(CAST(kf AS DOUBLE) * n)"
    return f"""
SELECT CAST(kf AS DOUBLE) AS k_frac, k_n, tp, tp / k_n AS precision_at_k,
  tp / greatest(pos, 1) AS recall_at_k, (tp / k_n) / greatest(CAST(pos AS DOUBLE) / n, 1e-12) AS lift_at_k
FROM (
  SELECT ks.*, CAST(coalesce((SELECT sum(has_done_upselling) FROM test_ranked WHERE rank <= ks.k_n), 0) AS BIGINT) AS tp
  FROM (SELECT kf, CAST(greatest(1, {kexpr}) AS BIGINT) AS k_n, n, pos
        FROM test_counts, (VALUES (0.05), (0.10), (0.20)) v(kf)) ks
)"""


PK_DOUBLES = ["k_frac", "precision_at_k", "recall_at_k", "lift_at_k"]


@register(
    "stratified_group_folds",
    sql=eval_sql("SELECT rating_account_id, customer_id, fold FROM scored_all"),
)
def stratified_group_folds(spark, sf_dir):
    return flow.contract_folds(spark, sf_dir).select(S.KEY, S.CUSTOMER, "fold")


@register(
    "fold_balance",
    sql=eval_sql(
        "SELECT fold, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, "
        "CAST(coalesce(sum(has_done_upselling), 0) AS BIGINT) AS n_pos, "
        "avg(CAST(has_done_upselling AS DOUBLE)) AS pos_rate FROM scored_all GROUP BY fold",
        ["pos_rate"],
    ),
)
def fold_balance(spark, sf_dir):
    return round_doubles(split.fold_balance(flow.contract_folds(spark, sf_dir)))


@register(
    "fold_leakage_check",
    sql=eval_sql(
        "SELECT count(*) AS n_customers, count(*) FILTER (WHERE k > 1) AS n_customers_multi_fold "
        "FROM (SELECT customer_id, count(DISTINCT fold) AS k FROM scored_all GROUP BY customer_id)"
    ),
)
def fold_leakage_check(spark, sf_dir):
    return split.fold_leakage(flow.contract_folds(spark, sf_dir))


# Contracts with a customer of a third of the rows, one of a twentieth, and rows without a customer.
SKEWED_CORE_SQL = (
    "SELECT rating_account_id, CASE WHEN rating_account_id % 3 = 0 THEN 'hot' WHEN rating_account_id % 17 = 1 THEN NULL "
    "WHEN rating_account_id % 11 = 2 THEN 'warm' ELSE customer_id END AS customer_id, has_done_upselling FROM core_data"
)

_SKEWED_FOLDS_SQL = f"""
SELECT * FROM (
WITH RECURSIVE core_skewed AS ({SKEWED_CORE_SQL}),
grps AS ({_groups_sql('core_skewed')}),
tot AS (SELECT CAST(sum(n_rows) AS BIGINT) AS n FROM grps),
heavy AS (SELECT g.*, row_number() OVER (ORDER BY n_rows DESC, n_pos DESC, md5('42:' || coalesce(customer_id, grp)), grp) AS i
          FROM grps g, tot WHERE n_rows * 5.0 > {split.HEAVY_SHARE} * tot.n),
place AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS grp, CAST(-1 AS BIGINT) AS fold,
    CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS loads, CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS pos
  UNION ALL
  SELECT i, grp, f - 1, [CASE WHEN x = f THEN loads[x] + n_rows ELSE loads[x] END for x in range(1, 6)],
    [CASE WHEN x = f THEN pos[x] + n_pos ELSE pos[x] END for x in range(1, 6)]
  FROM (SELECT h.i, h.grp, h.n_rows, h.n_pos, p.loads, p.pos,
          list_min([struct_pack(a := p.loads[x], b := p.pos[x], c := x) for x in range(1, 6)]).c AS f
        FROM place p JOIN heavy h ON h.i = p.i + 1)),
loads AS (SELECT x - 1 AS fold, l.loads[x] AS load FROM (SELECT loads FROM place ORDER BY i DESC LIMIT 1) l, range(1, 6) t(x)),
levels AS (
  SELECT load, lead(load) OVER w AS following, row_number() OVER w AS i,
    (sum(load) OVER (ORDER BY load, fold ROWS UNBOUNDED PRECEDING)
     + (SELECT n FROM tot) - (SELECT sum(load) FROM loads)) / row_number() OVER w AS level
  FROM loads WINDOW w AS (ORDER BY load, fold)),
level AS (SELECT level FROM levels WHERE following IS NULL OR level <= following ORDER BY i LIMIT 1),
rooms AS (SELECT fold, greatest(0.0, (SELECT level FROM level) - load) AS room FROM loads),
exact AS (SELECT fold, room * {split.DEAL_SLOTS} / (SELECT sum(room) FROM rooms) AS e FROM rooms),
ranked AS (SELECT fold, CAST(floor(e) AS BIGINT) AS q, row_number() OVER (ORDER BY e - floor(e) DESC, fold) AS i FROM exact),
quotas AS (SELECT fold, q + CASE WHEN i <= {split.DEAL_SLOTS} - (SELECT sum(q) FROM ranked) THEN 1 ELSE 0 END AS q FROM ranked),
slots AS (SELECT fold, row_number() OVER (ORDER BY (2 * j + 1) / (2 * q), fold) - 1 AS slot
          FROM (SELECT fold, q, unnest(range(0, CAST(q AS BIGINT))) AS j FROM quotas)),
light AS (SELECT g.*, (row_number() OVER (ORDER BY {_DEAL_ORDER}) - 1) % {split.DEAL_SLOTS} AS slot
          FROM grps g WHERE grp NOT IN (SELECT grp FROM heavy)),
assigned AS (SELECT grp, fold FROM place WHERE i > 0 UNION ALL SELECT l.grp, s.fold FROM light l JOIN slots s USING (slot))
SELECT c.rating_account_id, c.customer_id, CAST(a.fold AS INTEGER) AS fold
FROM core_skewed c JOIN assigned a ON {GROUP_SQL.replace('customer_id', 'c.customer_id')} = a.grp)
"""


def skewed_core(spark, sf_dir):
    """Contracts of the test tables with heavy customers and missing ones."""
    core = flow.inputs(spark, sf_dir).core.select(S.KEY, S.CUSTOMER, S.LABEL)
    k = F.col(S.KEY)
    customer = F.when(k % 3 == 0, "hot").when(k % 17 == 1, F.lit(None)).when(k % 11 == 2, "warm").otherwise(F.col(S.CUSTOMER))
    return core.withColumn(S.CUSTOMER, customer)


@register("skewed_group_folds", sql=with_views(_SKEWED_FOLDS_SQL))
def skewed_group_folds(spark, sf_dir):
    """Folds where one customer holds a third of the contracts: heavy groups first, the rest fills the room."""
    return split.assign_folds(skewed_core(spark, sf_dir)).select(S.KEY, S.CUSTOMER, "fold")


@register(
    "class_weights",
    sql=eval_sql(
        "SELECT has_done_upselling, count(*) AS n_class, "
        "(SELECT count(*) FROM scored_all WHERE fold <> 0) / "
        "((SELECT count(DISTINCT has_done_upselling) FROM scored_all WHERE fold <> 0) * count(*)) AS weight "
        "FROM scored_all WHERE fold <> 0 GROUP BY has_done_upselling",
        ["weight"],
    ),
)
def class_weights(spark, sf_dir):
    train = flow.contract_folds(spark, sf_dir).where(F.col("fold") != 0)
    return round_doubles(split.class_weights(train))


@register(
    "label_base_rate",
    sql=eval_sql(
        "SELECT scope, count(*) AS n, CAST(coalesce(sum(has_done_upselling), 0) AS BIGINT) AS positives, "
        "avg(CAST(has_done_upselling AS DOUBLE)) AS pos_rate FROM ("
        "SELECT 'all' AS scope, has_done_upselling FROM scored_all UNION ALL "
        "SELECT CASE WHEN fold = 0 THEN 'test' ELSE 'train' END, has_done_upselling FROM scored_all) GROUP BY scope",
        ["pos_rate"],
    ),
)
def label_base_rate(spark, sf_dir):
    s = flow.contract_folds(spark, sf_dir)
    scope = F.when(F.col("fold") == 0, "test").otherwise("train")
    both = s.select(F.lit("all").alias("scope"), S.LABEL).unionByName(s.select(scope.alias("scope"), S.LABEL))
    return round_doubles(
        both.groupBy("scope").agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(S.LABEL), F.lit(0)).cast("long").alias("positives"),
            F.avg(F.col(S.LABEL).cast("double")).alias("pos_rate"),
        )
    )


@register("rule_score", sql=eval_sql("SELECT rating_account_id, score FROM scored_all", ["score"]))
def rule_score(spark, sf_dir):
    return round_doubles(flow.scored(spark, sf_dir).select(S.KEY, "score"))


@register(
    "rule_score_calibrated",
    sql=eval_sql(
        "SELECT rating_account_id, score, least(greatest(score * CASE WHEN m <> 0 THEN 0.07 / m ELSE 1.0 END, 0.0), 1.0) "
        "AS calibrated_score FROM scored_all, (SELECT avg(score) AS m FROM scored_all)",
        ["score", "calibrated_score"],
    ),
)
def rule_score_calibrated(spark, sf_dir):
    s = flow.scored(spark, sf_dir).select(S.KEY, "score")
    return round_doubles(scoring.calibrate_to_rate(s))


@register("average_precision", sql=eval_sql("SELECT * FROM ap", ["average_precision"]))
def average_precision(spark, sf_dir):
    return round_doubles(evaluate.average_precision(flow.scored_test(spark, sf_dir)))


@register("roc_auc", sql=eval_sql("SELECT * FROM auc", ["roc_auc"]))
def roc_auc(spark, sf_dir):
    return round_doubles(evaluate.roc_auc(flow.scored_test(spark, sf_dir)))


@register("precision_at_k", sql=eval_sql(_pk_sql("round"), PK_DOUBLES))
def precision_at_k(spark, sf_dir):
    return round_doubles(evaluate.precision_at_k(flow.scored_test(spark, sf_dir)))


@register("precision_at_k_floor", sql=eval_sql(_pk_sql("floor"), PK_DOUBLES))
def precision_at_k_floor(spark, sf_dir):
    return round_doubles(evaluate.precision_at_k(flow.scored_test(spark, sf_dir), rule="floor"))


_BUDGET_MATRIX = (
    "SELECT 0 AS actual, (n - pos) - (k - tp) AS pred_0, k - tp AS pred_1 FROM budget "
    "UNION ALL SELECT 1, pos - tp, tp FROM budget"
)


@register("confusion_budget", sql=eval_sql(_BUDGET_MATRIX))
def confusion_budget(spark, sf_dir):
    return evaluate.confusion_at_budget(flow.scored_test(spark, sf_dir))


_THR_MATRIX = "SELECT 0 AS actual, tn AS pred_0, fp AS pred_1 FROM thr UNION ALL SELECT 1, fn, tp FROM thr"


@register("confusion_threshold", sql=eval_sql(_THR_MATRIX))
def confusion_threshold(spark, sf_dir):
    return evaluate.confusion_at_threshold(flow.scored_test(spark, sf_dir))


@register(
    "confusion_normalised",
    sql=eval_sql(
        "SELECT actual, round_even(pred_0 / nullif(pred_0 + pred_1, 0), 4) AS pred_0, "
        f"round_even(pred_1 / nullif(pred_0 + pred_1, 0), 4) AS pred_1 FROM ({_THR_MATRIX})"
    ),
)
def confusion_normalised(spark, sf_dir):
    return evaluate.normalise_rows(evaluate.confusion_at_threshold(flow.scored_test(spark, sf_dir)))


_REPORT_SQL = """
WITH c AS (SELECT tn, fp, fn, tp,
    coalesce(tp / nullif(tp + fp, 0), 0.0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0.0) AS r1,
    coalesce(tn / nullif(tn + fn, 0), 0.0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0.0) AS r0,
    tp + fn AS s1, tn + fp AS s0 FROM thr),
f AS (SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0.0) AS f1,
    coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0.0) AS f0, s0 + s1 AS n FROM c)
SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, coalesce((tp + tn) / nullif(n, 0), 0.0), n FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
UNION ALL SELECT 'weighted avg', coalesce((p0 * s0 + p1 * s1) / nullif(n, 0), 0.0),
  coalesce((r0 * s0 + r1 * s1) / nullif(n, 0), 0.0), coalesce((f0 * s0 + f1 * s1) / nullif(n, 0), 0.0), n FROM f
"""


@register(
    "classification_report",
    sql=eval_sql(_REPORT_SQL.replace("WITH c AS", "SELECT * FROM (WITH c AS") + ")",
                 ["precision", "recall", "f1_score"], threshold=S.NOTEBOOK_THRESHOLD),
)
def classification_report(spark, sf_dir):
    return round_doubles(evaluate.classification_report(flow.scored_test(spark, sf_dir)))


@register(
    "gains_curve",
    sql=eval_sql(
        "SELECT rating_account_id, has_done_upselling, score, "
        "row_number() OVER (ORDER BY score DESC, rating_account_id) AS rank, "
        "CAST(sum(has_done_upselling) OVER (ORDER BY score DESC, rating_account_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_pos FROM test",
        ["score"],
    ),
)
def gains_curve(spark, sf_dir):
    return round_doubles(evaluate.gains_curve(flow.scored_test(spark, sf_dir)))


@register(
    "topk_target_list",
    sql=eval_sql(
        "SELECT rating_account_id, score, rank FROM test_ranked WHERE rank <= (SELECT k FROM budget)", ["score"]
    ),
)
def topk_target_list(spark, sf_dir):
    return round_doubles(evaluate.top_k_targets(flow.scored_test(spark, sf_dir)))


_EVAL_REPORT_SQL = f"""
SELECT 'BaselinePosRate' AS metric, CAST(pos AS DOUBLE) / n AS value FROM test_counts
UNION ALL SELECT 'PR_AUC', average_precision FROM ap
UNION ALL SELECT 'ROC_AUC', roc_auc FROM auc
UNION ALL SELECT metric, value FROM (
  SELECT k_frac, precision_at_k, recall_at_k, lift_at_k FROM ({_pk_sql('round')})
) UNPIVOT (value FOR metric IN (precision_at_k, recall_at_k, lift_at_k))
UNION ALL SELECT 'ConfusionMatrix@10%[' || actual || ',0]', pred_0 FROM ({_BUDGET_MATRIX})
UNION ALL SELECT 'ConfusionMatrix@10%[' || actual || ',1]', pred_1 FROM ({_BUDGET_MATRIX})
UNION ALL SELECT 'ConfusionMatrix@Threshold[' || actual || ',0]', pred_0 FROM ({_THR_MATRIX})
UNION ALL SELECT 'ConfusionMatrix@Threshold[' || actual || ',1]', pred_1 FROM ({_THR_MATRIX})
UNION ALL SELECT 'ConfusionMatrixRowNorm@Threshold[' || actual || ',0]',
  round_even(pred_0 / nullif(pred_0 + pred_1, 0), 4) FROM ({_THR_MATRIX})
UNION ALL SELECT 'ConfusionMatrixRowNorm@Threshold[' || actual || ',1]',
  round_even(pred_1 / nullif(pred_0 + pred_1, 0), 4) FROM ({_THR_MATRIX})
UNION ALL SELECT 'k_n@' || CAST(CAST(round(k_frac * 100) AS INTEGER) AS VARCHAR) || '%', k_n FROM ({_pk_sql('round')})
UNION ALL SELECT 'DecisionThreshold', {S.DECISION_THRESHOLD}
"""


def _eval_report_sql() -> str:
    # The unpivoted names become P@5%, R@5%, Lift@5%, ... as in the report.
    body = _EVAL_REPORT_SQL.replace(
        "UNION ALL SELECT metric, value FROM (",
        "UNION ALL SELECT CASE metric WHEN 'precision_at_k' THEN 'P@' WHEN 'recall_at_k' THEN 'R@' "
        "ELSE 'Lift@' END || CAST(CAST(round(k_frac * 100) AS INTEGER) AS VARCHAR) || '%', value FROM (",
    )
    return eval_sql(f"SELECT metric, CAST(value AS DOUBLE) AS value FROM ({body})", ["value"])


@register("eval_report", sql=_eval_report_sql())
def eval_report(spark, sf_dir):
    return round_doubles(evaluate.eval_report(flow.scored_test(spark, sf_dir)))


@register(
    "promotion_gate",
    sql=eval_sql(
        f"SELECT 'ROC_AUC' AS metric, roc_auc AS value, {S.PROMOTION_MIN_AUC} AS min_value, "
        f"CAST(coalesce(roc_auc >= {S.PROMOTION_MIN_AUC}, false) AS INTEGER) AS promoted FROM auc",
        ["value", "min_value"],
    ),
)
def promotion_gate(spark, sf_dir):
    auc = evaluate.roc_auc(flow.scored_test(spark, sf_dir))
    return round_doubles(
        auc.select(
            F.lit("ROC_AUC").alias("metric"),
            F.col("roc_auc").alias("value"),
            F.lit(S.PROMOTION_MIN_AUC).alias("min_value"),
            F.coalesce(F.col("roc_auc") >= S.PROMOTION_MIN_AUC, F.lit(False)).cast("int").alias("promoted"),
        )
    )
