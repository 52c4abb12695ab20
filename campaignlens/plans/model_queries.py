"""Registered queries: model fits and scores (rows-only checks), table sinks."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators import boosting, evaluate, features, model
from campaignlens.plans import flow
from campaignlens.plans.oracle_views import with_views
from campaignlens.plans.registry import register, round_doubles, sql_round
from campaignlens.plans.clean_queries import USAGE_DOUBLES
from campaignlens.plans.eval_queries import GROUP_SQL, eval_sql
from campaignlens.sources.sinks import (
    backfill_date_range,
    champion_dir,
    stage_root,
    write_stage,
    write_versioned,
)

# Stored frames and fitted pipelines shared by the queries of one application (same data, same params).
_FRAMES: dict[tuple, object] = {}
_FITS: dict[tuple, object] = {}


def _frame(spark, sf_dir, features):
    """The modelling frame, stored once per application (it feeds several fits)."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(features))
    if key not in _FRAMES:
        _FRAMES[key] = model.stored_frame(flow.modelling_frame(spark, sf_dir, features))
    return _FRAMES[key]


def _fit_once(spark, sf_dir, tag, features, make_estimator):
    key = (spark.sparkContext.applicationId, sf_dir, tag, tuple(features))
    if key not in _FITS:
        train = _frame(spark, sf_dir, features).where(F.col("fold") != 0)
        _FITS[key] = model.fit(train, features, make_estimator(train))
    return _FITS[key]


def _forest(train):
    return model.forest()


def _test_scores(spark, sf_dir, tag, features, make_estimator):
    fitted = _fit_once(spark, sf_dir, tag, features, make_estimator)
    frame = _frame(spark, sf_dir, features)
    return model.scores(fitted, frame.where(F.col("fold") == 0))


def _rf_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "rf", S.SELECTED_FEATURES, _forest)


@register("rf_scores", note="random forest, 300 trees; rows-only")
def rf_scores(spark, sf_dir):
    return _rf_scores(spark, sf_dir)


@register("rf_eval_report", note="evaluation report of the forest on the test fold; rows-only")
def rf_eval_report(spark, sf_dir):
    return evaluate.eval_report(_rf_scores(spark, sf_dir))


@register("feature_importance", note="top 10 impurity importances; rows-only")
def feature_importance(spark, sf_dir):
    fitted = _fit_once(spark, sf_dir, "rf", S.SELECTED_FEATURES, _forest)
    pairs = model.importances(fitted, S.SELECTED_FEATURES, top=10)
    return spark.createDataFrame(pairs, "feature string, importance double")


@register("oof_accuracy", note="out-of-fold accuracy over the training folds; rows-only")
def oof_accuracy(spark, sf_dir):
    frame = _frame(spark, sf_dir, S.SELECTED_FEATURES)
    train = frame.where(F.col("fold") != 0)
    acc = model.out_of_fold_accuracy(train, S.SELECTED_FEATURES, model.forest())
    stats = train.agg(F.avg("label").alias("rate"), F.count(F.lit(1)).alias("n"))
    return stats.select(
        F.inline(
            F.array(
                F.struct(F.lit("oof_accuracy").alias("metric"), F.lit(acc).alias("value")),
                F.struct(F.lit("oof_error").alias("metric"), F.lit(1.0 - acc).alias("value")),
                F.struct(F.lit("train_pos_rate").alias("metric"), F.col("rate").alias("value")),
                F.struct(F.lit("n_train").alias("metric"), F.col("n").cast("double").alias("value")),
            )
        )
    )


OOB_BAGS, OOB_TREES = 12, 25


@register("oob_accuracy", note="out-of-bag accuracy of bagged forests over the training folds; rows-only")
def oob_accuracy(spark, sf_dir):
    """Out-of-bag accuracy and error, as the reference's training step reports them."""
    train = _frame(spark, sf_dir, S.SELECTED_FEATURES).where(F.col("fold") != 0)
    models = model.bagged_forests(train, S.SELECTED_FEATURES, OOB_BAGS, OOB_TREES)
    found = model.out_of_bag_accuracy(model.out_of_bag_votes(models, train)).first()
    stats = train.agg(F.avg("label").alias("rate"), F.count(F.lit(1)).alias("n"))
    pairs = [
        ("oob_accuracy", F.lit(found.accuracy)), ("oob_error", F.lit(1.0 - found.accuracy)),
        ("train_pos_rate", F.col("rate")), ("n_train", F.col("n").cast("double")), ("n_voted", F.lit(float(found.n))),
    ]
    return round_doubles(stats.select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in pairs]))
    ))


def _bootstrap_sql() -> str:
    below = [sum(math.exp(-1.0) / math.factorial(i) for i in range(k + 1)) for k in range(3)]
    steps = " + ".join(f"CAST(u >= CAST('{x!r}' AS DOUBLE) AS INTEGER)" for x in below)
    return (
        f"SELECT CAST(bag AS INTEGER) AS bag, {steps} AS draws, count(*) AS n_rows, "
        "CAST(sum(has_done_upselling) AS BIGINT) AS n_pos FROM ("
        "SELECT bag, has_done_upselling, CAST(CAST('0x' || left(md5('42:' || bag || ':' || rating_account_id), 12) AS BIGINT) "
        f"AS DOUBLE) / 281474976710656.0 AS u FROM core_data, range(0, {OOB_BAGS}) b(bag)) GROUP BY 1, 2"
    )


@register("bootstrap_draws", sql=with_views(_bootstrap_sql()))
def bootstrap_draws(spark, sf_dir):
    """Rows and positives of every bag by the number of draws (three or more together)."""
    core = flow.inputs(spark, sf_dir).core.select(S.KEY, S.LABEL)
    bags = core.select("*", F.explode(F.sequence(F.lit(0), F.lit(OOB_BAGS - 1))).alias("bag"))
    draws = F.least(model.bootstrap_weight(S.KEY, F.col("bag")), F.lit(3)).alias("draws")
    return bags.groupBy("bag", draws).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(S.LABEL).cast("long").alias("n_pos"))


@register("lr_scores", note="logistic regression, 1000 iterations, balanced; rows-only")
def lr_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "lr", S.SELECTED_FEATURES, lambda train: model.logistic(train.count()))


@register("gbt_scores", note="boosted trees, 300 rounds, depth 4; rows-only")
def gbt_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "gbt", S.SELECTED_FEATURES, lambda train: model.boosted())


BOOST_ROUNDS, BOOST_STEP = 30, 0.3


@register("second_order_scores", note="second-order boosted trees, 30 rounds; rows-only")
def second_order_scores(spark, sf_dir):
    frame = _frame(spark, sf_dir, S.SELECTED_FEATURES)
    fitted = boosting.boost(frame.where(F.col("fold") != 0), S.SELECTED_FEATURES, BOOST_ROUNDS, step=BOOST_STEP)
    return boosting.scores(fitted, frame.where(F.col("fold") == 0))


GAIN_FEATURES = ["age", "contract_lifetime_days", "gross_mrc", "has_special_offer", "is_magenta1_customer"]


def _gain_sql() -> str:
    bins = 16
    rows = " UNION ALL ".join(
        f"SELECT {i} AS feature, has_done_upselling AS y, CAST(CASE WHEN hi > lo THEN greatest(least("
        f"floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}), 0) ELSE 0 END AS INTEGER) AS bin FROM ("
        f"SELECT has_done_upselling, CAST({c} AS DOUBLE) AS v, (SELECT CAST(min({c}) AS DOUBLE) FROM core_data) AS lo, "
        f"(SELECT CAST(max({c}) AS DOUBLE) FROM core_data) AS hi FROM core_data)"
        for i, c in enumerate(GAIN_FEATURES)
    )
    return sql_round(
        with_views(
            "SELECT feature, bin, g, h, (g * g / (h + 1) + (tg - g) * (tg - g) / (th - h + 1) - tg * tg / (th + 1)) / 2 AS gain FROM ("
            "SELECT feature, bin, sum(n * p - pos) OVER w AS g, sum(n * p * (1 - p)) OVER w AS h, "
            "sum(n * p - pos) OVER f AS tg, sum(n * p * (1 - p)) OVER f AS th, max(bin) OVER f AS top FROM ("
            "SELECT feature, bin, count(*) AS n, CAST(sum(y) AS DOUBLE) AS pos, "
            "(SELECT avg(CAST(has_done_upselling AS DOUBLE)) FROM core_data) AS p "
            f"FROM ({rows}) GROUP BY feature, bin) "
            "WINDOW w AS (PARTITION BY feature ORDER BY bin ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY feature)) WHERE bin < top"
        ),
        ["g", "h", "gain"],
        4,
    )


@register("root_split_gains", sql=_gain_sql())
def root_split_gains(spark, sf_dir):
    """Gradient and hessian sums and the gain of every split of the first tree's root over all contracts."""
    core = flow.inputs(spark, sf_dir).core.withColumn("label", F.col(S.LABEL))
    edges = boosting.bin_edges(core, GAIN_FEATURES, 16)
    return round_doubles(boosting.root_gains(boosting.counted_cells(core, GAIN_FEATURES, edges)), 4)


@register("feature_set_comparison", note="9 forests of 100 trees; rows-only")
def feature_set_comparison(spark, sf_dir):
    sets = S.feature_sets()
    all_feats = list(dict.fromkeys(f for v in sets.values() for f in v))
    frame = _frame(spark, sf_dir, all_feats)
    return round_doubles(model.compare_feature_sets(frame, sets))


SELECTOR_FEATURES = list(dict.fromkeys(S.CORE_RAW + S.CORE_WITH_BUCKETS + S.USAGE_FEATURES + S.INTERACTION_FEATURES))


@register("select_features", note="variance, univariate and embedded selectors; rows-only")
def select_features(spark, sf_dir):
    return model.select_features(_frame(spark, sf_dir, SELECTOR_FEATURES), SELECTOR_FEATURES)


def _selector_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, has_done_upselling AS y, coalesce(CAST(\"{f}\" AS DOUBLE), 0.0) AS x FROM train"
        for f in SELECTOR_FEATURES
    )
    body = (
        "SELECT feature, var_samp(x) AS variance, "
        "(sum(n * (m - g) * (m - g)) / (count(*) - 1)) / nullif(sum(n * v) / (sum(n) - count(*)), 0) AS f_value "
        "FROM (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS g, "
        "FROM (SELECT feature, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long GROUP BY feature, y)) "
        "GROUP BY feature"
    ).replace("var_samp(x)", "(sum(n * v) + sum(n * (m - g) * (m - g))) / (sum(n) - 1)")
    train = (
        f"SELECT m.*, f.fold FROM merged_filled m LEFT JOIN folds f ON {GROUP_SQL.replace('customer_id', 'm.customer_id')} = f.grp "
        "WHERE f.fold <> 0"
    )
    return eval_sql(
        f"SELECT * FROM (WITH train AS ({train}), long AS ({rows}) {body})", ["variance", "f_value"], digits=4
    )


@register("selector_statistics", sql=_selector_sql())
def selector_statistics(spark, sf_dir):
    """Variance and ANOVA F of every candidate feature over the training folds."""
    return round_doubles(model.selector_statistics(_frame(spark, sf_dir, SELECTOR_FEATURES), SELECTOR_FEATURES), 4)


@register("permutation_importance", note="AUC drop per permuted input on the test fold; rows-only")
def permutation_importance(spark, sf_dir):
    fitted = _fit_once(spark, sf_dir, "rf", S.SELECTED_FEATURES, _forest)
    test = _frame(spark, sf_dir, S.SELECTED_FEATURES).where(F.col("fold") == 0)
    return model.permutation_importance(fitted, test, S.SELECTED_FEATURES)


@register("tune", note="grid search, cross-validated on training folds; rows-only")
def tune(spark, sf_dir):
    frame = _frame(spark, sf_dir, S.SELECTED_FEATURES)
    grid = model.full_grid({"numTrees": [50, 100], "minInstancesPerNode": [20, 50]})
    return model.tune(frame, S.SELECTED_FEATURES, grid)[0]


HALVING_SPACE = {"num_trees": [10, 20, 40], "min_leaf": [20, 50, 100], "max_depth": [4, 6, 8]}


@register("tune_halving", note="random draws of the space raced on nested samples; rows-only")
def tune_halving(spark, sf_dir):
    frame = _frame(spark, sf_dir, S.SELECTED_FEATURES)
    return model.successive_halving(frame, S.SELECTED_FEATURES, model.random_grid(HALVING_SPACE, 8))[0]


INFORMATION_COLUMNS = ["age", "gross_mrc", "contract_lifetime_days", "smartphone_brand", "available_gb", S.LABEL]
INFORMATION_NUMERIC = ["age", "gross_mrc", "contract_lifetime_days"]


def _information_sql() -> str:
    def binned(c: str) -> str:
        if c not in INFORMATION_NUMERIC:
            return f"coalesce(CAST({c} AS VARCHAR), '')"
        low, high = f"(SELECT CAST(min({c}) AS DOUBLE) FROM core_data)", f"(SELECT CAST(max({c}) AS DOUBLE) FROM core_data)"
        step = f"floor((CAST({c} AS DOUBLE) - {low}) * (CAST(10 AS DOUBLE) / ({high} - {low})))"
        return f"coalesce(CAST(CAST(least({step}, 9) AS BIGINT) AS VARCHAR), '')"

    cut = ", ".join(f"{binned(c)} AS v{i}" for i, c in enumerate(INFORMATION_COLUMNS))
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, v{i} AS x, v{j} AS y FROM cut"
        for i, a in enumerate(INFORMATION_COLUMNS) for j, b in enumerate(INFORMATION_COLUMNS) if i < j
    )
    return with_views(
        "SELECT a, b, CAST(max(n) AS BIGINT) AS n, round(sum(c / n * ln(c * n / (nx * ny))), 6) AS information FROM ("
        "SELECT a, b, CAST(c AS DOUBLE) AS c, CAST(sum(c) OVER (PARTITION BY a, b) AS DOUBLE) AS n, "
        "CAST(sum(c) OVER (PARTITION BY a, b, x) AS DOUBLE) AS nx, CAST(sum(c) OVER (PARTITION BY a, b, y) AS DOUBLE) AS ny "
        f"FROM (SELECT a, b, x, y, count(*) AS c FROM ({pairs}) GROUP BY a, b, x, y)) GROUP BY a, b",
        extra=[("cut", f"SELECT {cut} FROM core_data")],
    )


@register("pair_information", sql=_information_sql())
def pair_information(spark, sf_dir):
    """Mutual information of every pair of contract columns and the label."""
    core = flow.inputs(spark, sf_dir).core
    return round_doubles(model.pair_information(core, INFORMATION_COLUMNS, INFORMATION_NUMERIC))


@register("select_without_redundancy", note="greedy relevance minus redundancy over the pair table; rows-only")
def select_without_redundancy(spark, sf_dir):
    core = flow.inputs(spark, sf_dir).core
    pairs = model.pair_information(core, INFORMATION_COLUMNS, INFORMATION_NUMERIC)
    picked = model.select_without_redundancy(pairs, S.LABEL, 3)
    return spark.createDataFrame([(i + 1, f, w) for i, (f, w) in enumerate(picked)], "rank int, feature string, worth double")


@register("rf_promotion_gate", note="forest AUC against the bar and the current champion; rows-only")
def rf_promotion_gate(spark, sf_dir):
    auc = evaluate.roc_auc(_rf_scores(spark, sf_dir)).first().roc_auc
    fitted = _fit_once(spark, sf_dir, "rf", S.SELECTED_FEATURES, _forest)
    path, tag = champion_dir(spark), f"rf {sf_dir}"
    before = model.champion_auc(spark, path, but=tag)
    promoted = model.promote(fitted, auc, path, tag=tag)
    return spark.createDataFrame(
        [("ROC_AUC", auc, S.PROMOTION_MIN_AUC, before, int(promoted))],
        "metric string, value double, min_value double, champion_value double, promoted int",
    )


# -- table sinks ---------------------------------------------------------------------------

STAGE_DB = "campaignlens_stages"


@register("latest_version_view", sql=with_views("SELECT * FROM processed_core"))
def latest_version_view(spark, sf_dir):
    """Two versions of the cleaned contracts; the view follows the latest."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGE_DB} LOCATION '{stage_root(spark)}/warehouse'")
    old = flow.processed_core(spark, sf_dir, age_edges=S.AGE_EDGES_NOTEBOOK)
    new = flow.processed_core(spark, sf_dir)
    write_versioned(old, "processed_core", 1, 2, STAGE_DB)
    name = write_versioned(new, "processed_core", 2, 2, STAGE_DB)
    return round_doubles(spark.table(name))


BACKFILL_WINDOW = ("1995-01-01", "1996-01-01")


def usage_daily(spark, sf_dir):
    usage = flow.inputs(spark, sf_dir).usage
    return usage.groupBy(F.to_date("billed_period_month_d").alias("day_dt")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("used_gb").alias("total_used_gb"),
        F.sum("has_used_roaming").cast("long").alias("roaming_rows"),
    )


@register(
    "date_range_backfill",
    sql=with_views(
        "SELECT CAST(billed_period_month_d AS DATE) AS day_dt, count(*) AS n_rows, "
        "round(sum(used_gb), 6) AS total_used_gb, CAST(sum(has_used_roaming) AS BIGINT) AS roaming_rows "
        "FROM usage_info GROUP BY 1"
    ),
)
def date_range_backfill(spark, sf_dir):
    """Initial load without the window, then a backfill of exactly the window."""
    import uuid

    lo, hi = BACKFILL_WINDOW
    daily = usage_daily(spark, sf_dir)
    path = f"{stage_root(spark)}/usage_daily-{uuid.uuid4().hex}"
    outside = (F.col("day_dt") < F.lit(lo).cast("date")) | (F.col("day_dt") >= F.lit(hi).cast("date"))
    write_stage(daily.where(outside), path, partition_by=["day_dt"])
    backfill_date_range(daily, path, "day_dt", lo, hi)
    return round_doubles(spark.read.parquet(path))


@register(
    "backfill_rows_written",
    sql=with_views(
        f"SELECT count(DISTINCT CAST(billed_period_month_d AS DATE)) AS rows_written, "
        f"count(DISTINCT CAST(billed_period_month_d AS DATE)) AS rows_stored FROM usage_info "
        f"WHERE CAST(billed_period_month_d AS DATE) >= DATE '{BACKFILL_WINDOW[0]}' "
        f"AND CAST(billed_period_month_d AS DATE) < DATE '{BACKFILL_WINDOW[1]}'"
    ),
)
def backfill_rows_written(spark, sf_dir):
    """The rows a backfill reports as written, beside the rows found in its window afterwards."""
    import uuid

    lo, hi = BACKFILL_WINDOW
    path = f"{stage_root(spark)}/usage_daily-{uuid.uuid4().hex}"
    written = backfill_date_range(usage_daily(spark, sf_dir), path, "day_dt", lo, hi)
    stored = spark.read.parquet(path).where((F.col("day_dt") >= F.lit(lo)) & (F.col("day_dt") < F.lit(hi)))
    return stored.agg(F.lit(written).cast("long").alias("rows_written"), F.count(F.lit(1)).alias("rows_stored"))


STATE_WINDOW = ("1994-03-01", "1995-09-01")


@register("usage_from_states", sql=sql_round(with_views("SELECT * FROM usage_features"), USAGE_DOUBLES))
def usage_from_states(spark, sf_dir):
    """Usage features from stored monthly states: a load with a wrong window, its backfill, and the merge."""
    import uuid

    ins = flow.inputs(spark, sf_dir)
    lo, hi = (F.lit(d).cast("date") for d in STATE_WINDOW)
    day = F.to_date("billed_period_month_d")
    wrong = F.when((day >= lo) & (day < hi), F.col("used_gb") * 2 + 1).otherwise(F.col("used_gb"))
    path = f"{stage_root(spark)}/usage_states-{uuid.uuid4().hex}"
    first = features.usage_states(ins.usage.withColumn("used_gb", wrong), ins.usage_ties)
    write_stage(first, path, partition_by=[features.STATE_MONTH])
    window = features.usage_states(ins.usage.where((day >= lo) & (day < hi)), ins.usage_ties)
    backfill_date_range(window, path, features.STATE_MONTH, *STATE_WINDOW)
    return round_doubles(features.merge_usage_states(spark.read.parquet(path)))
