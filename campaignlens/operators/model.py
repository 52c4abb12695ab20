"""Models on Spark ML: random forest, logistic regression, boosted trees,
out-of-fold accuracy, importances, feature-set comparison, feature
selection, tuning and the promotion gate.

Training data is the merged feature table with its fold column; fold 0 is
the test fold.  Class balance uses a per-row weight (``n / (2 n_class)``,
joined from a two-row frame).  Missing model inputs are filled with 0
before assembly (Spark's trees do not take NaN).  Scores keep the row key:
``probability[1]`` is read with ``vector_to_array``, never by position.
"""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import UnivariateFeatureSelector, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from campaignlens import schemas as S
from campaignlens.operators import evaluate
from campaignlens.operators.counted_boosting import CountedBoosting
from campaignlens.operators.counted_forest import CountedForest
from campaignlens.operators.joins import shuffle_partitions
from campaignlens.operators.permuted import permuted_counts
from campaignlens.operators.rank import with_position
from campaignlens.operators.split import with_class_weight
from campaignlens.session import ensure_checkpoint_dir, shuffle_files_removed
from campaignlens.sources.sinks import pointers, publish, published


def model_frame(df: DataFrame, features: Sequence[str], label: str = S.LABEL) -> DataFrame:
    """Key, fold, label (as double), weight and the numeric features (nulls -> 0)."""
    cols = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in features]
    return df.select(S.KEY, "fold", F.col(label).cast("double").alias("label"), *cols)


def stored_frame(df: DataFrame, key: str = S.KEY) -> DataFrame:
    """The modelling frame dealt over the shuffle partitions by its key and stored (checkpoint).

    Iterative learners pass over their input many times, one task per
    partition; the deal is the same whatever the input's own partitions are.
    The shuffle files of the joins behind it go once it is stored.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with shuffle_files_removed(df.sparkSession):
        return df.repartition(shuffle_partitions(df), key).checkpoint(eager=True)


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")


def forest(num_trees: int = S.RF_PARAMS["num_trees"], min_leaf: int = S.RF_PARAMS["min_leaf"],
           max_depth: int = 30, seed: int = S.RF_PARAMS["seed"]) -> CountedForest:
    """Forest of the training step; depth is capped at Spark's maximum of 30.

    Grown on counted feature vectors where the rows repeat them (``counted_forest``).
    """
    return CountedForest(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=num_trees,
        minInstancesPerNode=min_leaf, maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed,
        maxMemoryInMB=1024, cacheNodeIds=True,
    )


def fit(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    """Weighted fit of ``assembler -> estimator`` on the training rows."""
    weighted = with_class_weight(train, "label")
    return plain_model(Pipeline(stages=[assembler(features), estimator]).fit(weighted))


def plain_model(fitted: PipelineModel) -> PipelineModel:
    """A copy without the training summary.

    A forest's summary holds the session, which cannot be sent to the tasks
    that score rows once the session has observed a metric.
    """
    return fitted.copy()


def scores(model: PipelineModel, rows: DataFrame, name: str = "score") -> DataFrame:
    """``(key, label, score)`` with the positive-class probability."""
    out = model.transform(rows)
    return out.select(
        S.KEY, F.col("label").cast("int").alias(S.LABEL), vector_to_array("probability")[1].alias(name)
    )


def importances(model: PipelineModel, features: Sequence[str], top: int | None = 10) -> list[tuple[str, float]]:
    """Impurity importances of the last stage, largest first."""
    imp = model.stages[-1].featureImportances.toArray()
    pairs = sorted(zip(features, (float(v) for v in imp)), key=lambda p: -p[1])
    return pairs[:top] if top else pairs


def out_of_fold_accuracy(train: DataFrame, features: Sequence[str], estimator, parallelism: int = 4) -> float:
    """Mean accuracy of models scored on the fold they did not see.

    Spark's forest has no out-of-bag score; cross-validation over the
    existing group-disjoint folds of the training rows stands in for it.
    """
    idx, k = _dense_fold(train)
    data = with_class_weight(train, "label").withColumn("cv_fold", idx)
    cv = CrossValidator(
        estimator=Pipeline(stages=[assembler(features), estimator]),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"),
        foldCol="cv_fold",
        numFolds=k,
        parallelism=parallelism,
    )
    return float(cv.fit(data).avgMetrics[0])


# Draws of one row beyond which the bootstrap's probability is below 1e-11.
_MOST_DRAWS = 12


def bootstrap_weight(key: str, bag: int | Column, seed: int = S.SPLIT_SEED) -> Column:
    """How often a bag's bootstrap sample draws a row: Poisson with mean 1, from a hash of (seed, bag, key).

    The same on every machine and in every engine that has md5, so a row's
    unseen bags are known without a stored sample.
    """
    uniform = _bag_share(key, bag, seed)
    below, steps = 0.0, []
    for k in range(_MOST_DRAWS):
        below += math.exp(-1.0) / math.factorial(k)
        steps.append((uniform >= F.lit(below)).cast("int"))
    return sum(steps[1:], steps[0])


def _bag_share(key: str, bag: int | Column, seed: int) -> Column:
    """A number in [0, 1) from a hash of (seed, bag, key)."""
    bag = F.lit(bag) if isinstance(bag, int) else bag
    text = F.concat(F.lit(f"{seed}:"), bag.cast("string"), F.lit(":"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def bag_draws(key: str, bag: int, seed: int = S.SPLIT_SEED) -> Column:
    """Whether ``bootstrap_weight`` is above 0: a filter hashes the row once, not once per step of the weight."""
    return _bag_share(key, bag, seed) >= F.lit(math.exp(-1.0))


def bagged_forests(
    train: DataFrame, features: Sequence[str], bags: int, trees_per_bag: int, seed: int = S.SPLIT_SEED,
    max_depth: int = S.COMPARE_MAX_DEPTH, min_leaf: int = S.RF_PARAMS["min_leaf"], key: str = S.KEY, parallelism: int = 4,
) -> list[PipelineModel]:
    """One small forest per bag; its trees share the bag's bootstrap weights and draw their own features."""
    weighted = with_class_weight(train, "label", name="_balance")

    def run(bag: int) -> PipelineModel:
        drawn = weighted.where(bag_draws(key, bag, seed)).withColumn("_draws", bootstrap_weight(key, bag, seed))
        drawn = drawn.withColumn("weight", F.col("_balance") * F.col("_draws"))
        trees = forest(num_trees=trees_per_bag, min_leaf=min_leaf, max_depth=max_depth, seed=seed + bag).setBootstrap(False)
        return plain_model(Pipeline(stages=[assembler(features), trees]).fit(drawn))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(run, range(bags)))


def out_of_bag_votes(models: Sequence[PipelineModel], train: DataFrame, seed: int = S.SPLIT_SEED, key: str = S.KEY) -> DataFrame:
    """``(key, label, votes, score)``: the mean probability over the bags that did not draw the row.

    Every bag scores its unseen rows (about 37 percent); one aggregate over the
    bags makes the table.  Rows that every bag drew have no vote and no row.
    """
    parts = []
    for bag, model in enumerate(models):
        unseen = train.where(~bag_draws(key, bag, seed))
        parts.append(model.transform(unseen).select(key, "label", vector_to_array("probability")[1].alias("_p")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(key, "label").agg(F.count(F.lit(1)).alias("votes"), F.avg("_p").alias("score"))


def out_of_bag_accuracy(votes: DataFrame) -> DataFrame:
    """``(n, accuracy)`` of the vote table; the class with the larger mean probability wins, ties go to 0."""
    right = (F.col("score") > 0.5).cast("double") == F.col("label")
    return votes.agg(F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy"))


def _dense_fold(train: DataFrame):
    """Training folds renumbered 0..k-1 (the fold list has k <= a handful entries)."""
    folds = sorted(r.fold for r in train.select("fold").distinct().collect())
    idx = F.lit(None).cast("int")
    for i, f in enumerate(folds):
        idx = F.when(F.col("fold") == f, F.lit(i)).otherwise(idx)
    return idx, len(folds)


def logistic(n_rows: int, c: float = S.LR_C, max_iter: int = S.LR_MAX_ITER) -> LogisticRegression:
    """Logistic regression with an L2 penalty of inverse strength ``c``.

    The reference minimises ``c * sum(w * loss) + |b|^2 / 2``, Spark the mean
    loss plus ``reg * |b|^2 / 2``; balanced weights add up to the number of
    training rows, so ``reg = 1 / (c * n_rows)``.  Inputs are not standardised.
    """
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=max_iter,
                              regParam=1.0 / (c * max(n_rows, 1)), standardization=False)


def boosted(max_iter: int = 300, max_depth: int = 4, step: float = 0.05, subsample: float = 0.8,
            seed: int = 42) -> CountedBoosting:
    """Boosted trees, grown on counted feature vectors where the rows repeat them (``counted_boosting``)."""
    return CountedBoosting(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                           stepSize=step, subsamplingRate=subsample, seed=seed)


def compare_feature_sets(
    frame: DataFrame,
    sets: dict[str, Sequence[str]],
    num_trees: int = S.RF_NOTEBOOK_TREES,
    threshold: float = S.NOTEBOOK_THRESHOLD,
    fractions: Sequence[float] = S.TOP_K_FRACTIONS,
    parallelism: int = 4,
    max_depth: int = S.COMPARE_MAX_DEPTH,
) -> DataFrame:
    """One forest per feature set, scored on the test fold, in long form ``(feature_set, metric, value)``.

    Fits run concurrently from driver threads on one stored frame; every model
    scores the test fold once, and all sets share one grouped class report
    (precision, recall, f1 and support per class, the means and the accuracy at
    ``threshold``) and one grouped ranking (precision at k, floor rule).  Trees
    on raw columns grow with the rows, so their depth is bounded.
    """
    train = frame.where(F.col("fold") != 0)
    test = frame.where(F.col("fold") == 0)

    def run(item):
        name, feats = item
        model = fit(train, feats, forest(num_trees=num_trees, max_depth=max_depth))
        return scores(model, test).withColumn("feature_set", F.lit(name))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        parts = list(pool.map(run, sets.items()))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = every.checkpoint(eager=True)
    return grouped_report(every, "feature_set", threshold).unionByName(
        grouped_precision_at_k(every, "feature_set", fractions)
    )


def grouped_report(scored: DataFrame, group: str, threshold: float) -> DataFrame:
    """The class report of every group in one pass: ``(group, metric, value)``."""
    pred, y = F.col("score") >= F.lit(threshold), F.col(S.LABEL) == 1
    counts = scored.groupBy(group).agg(
        F.count_if(~y & ~pred).alias("tn"), F.count_if(~y & pred).alias("fp"),
        F.count_if(y & ~pred).alias("fn"), F.count_if(y & pred).alias("tp"),
    )
    rows = evaluate.report_rows(*(F.col(c) for c in ("tn", "fp", "fn", "tp")))
    long = counts.select(group, F.inline(F.array(*rows)))
    cells = [
        F.struct(F.concat(F.col("class_label"), F.lit(f":{c}")).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in ("precision", "recall", "f1_score", "support")
    ]
    return long.select(group, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def grouped_precision_at_k(scored: DataFrame, group: str, fractions: Sequence[float]) -> DataFrame:
    """Precision at k (floor rule) of every group from one ranking: ``(group, metric, value)``."""
    order = [F.col(group).asc(), F.col("score").desc(), F.col(S.KEY).asc()]
    ranked = with_position(scored.select(group, S.KEY, S.LABEL, "score"), order, name="_p")
    # One row per group: a bounded frame, broadcast.
    spans = F.broadcast(ranked.groupBy(group).agg(F.min("_p").alias("_first"), F.count(F.lit(1)).alias("_n")))
    met = ranked.join(spans, group)
    k = [F.greatest(F.lit(1), F.floor(F.lit(f) * F.col("_n"))).cast("long") for f in fractions]
    inside = met.groupBy(group).agg(*[
        (F.sum(F.when(F.col("_p") - F.col("_first") < k[i], F.col(S.LABEL)).otherwise(0)) / F.max(k[i])).alias(f"p{i}")
        for i in range(len(fractions))
    ])
    cells = [
        F.struct(F.lit(f"precision@{f}").alias("metric"), F.col(f"p{i}").cast("double").alias("value"))
        for i, f in enumerate(fractions)
    ]
    return inside.select(group, F.inline(F.array(*cells)))


def selector_statistics(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, variance, f_value)`` over the training folds: the inputs of the two filter selectors.

    ``variance`` is the sample variance; ``f_value`` the one-way ANOVA F of the
    feature between the label's classes (null where the classes do not vary).
    All features are reshaped by one ``explode`` and aggregated once.
    """
    from campaignlens.operators.profile import long_values

    long = long_values(frame.where(F.col("fold") != 0), features, "double", extra=["label"])
    by_class = long.groupBy("column_name", "label").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v")
    )
    total = by_class.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"), F.sum(F.col("n") * F.col("v")).alias("within"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("squares"),
    )
    # One row per feature and class: small frames.
    between = by_class.join(F.broadcast(total.select("column_name", "grand")), "column_name").groupBy("column_name").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("between")
    )
    both = total.join(F.broadcast(between), "column_name")
    f_value = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))
    )
    return both.select(
        F.col("column_name").alias("feature"),
        F.try_divide(F.col("between") + F.col("within"), F.col("n") - 1).alias("variance"),
        f_value.alias("f_value"),
    )


def select_features(
    frame: DataFrame, features: Sequence[str], top: int = 10, num_trees: int = S.RF_NOTEBOOK_TREES
) -> DataFrame:
    """Two filters and an embedded selector over the training folds.

    ``kept_by_variance`` drops constant inputs, ``kept_by_univariate`` keeps
    the top-k by ANOVA F, ``kept_by_embedded`` those whose impurity importance
    in a forest is at least the mean importance.
    """
    train = frame.where(F.col("fold") != 0)
    data = assembler(features).transform(train)
    var_model = VarianceThresholdSelector(featuresCol="features", outputCol="v_sel", varianceThreshold=0.0).fit(data)
    uni = UnivariateFeatureSelector(featuresCol="features", outputCol="u_sel", labelCol="label",
                                    selectionMode="numTopFeatures")
    uni.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(top)
    uni_model = uni.fit(data)
    fitted = fit(train, features, forest(num_trees=num_trees, max_depth=S.COMPARE_MAX_DEPTH))
    weight = dict(importances(fitted, features, top=None))
    mean = sum(weight.values()) / max(len(weight), 1)
    kept_var, kept_uni = set(var_model.selectedFeatures), set(uni_model.selectedFeatures)
    rows = [(f, int(i in kept_var), int(i in kept_uni), int(weight[f] >= mean)) for i, f in enumerate(features)]
    return frame.sparkSession.createDataFrame(
        rows, "feature string, kept_by_variance int, kept_by_univariate int, kept_by_embedded int"
    )


def full_grid(space: dict[str, Sequence]) -> list[dict]:
    """Every combination of the parameter values."""
    names = sorted(space)
    return [dict(zip(names, values)) for values in product(*(space[n] for n in names))]


def random_grid(space: dict[str, Sequence], n: int, seed: int = S.SPLIT_SEED) -> list[dict]:
    """``n`` different combinations drawn at random (all of them if there are fewer)."""
    grid = full_grid(space)
    return random.Random(seed).sample(grid, min(n, len(grid)))


def tune(
    frame: DataFrame, features: Sequence[str], candidates: Sequence[dict], parallelism: int = 4
) -> tuple[DataFrame, dict, PipelineModel]:
    """Cross-validated search over the training folds (ROC AUC).

    Returns the table ``(params, mean_roc_auc, is_best)``, the best parameters
    and the model refitted with them on all training rows.
    """
    train = frame.where(F.col("fold") != 0)
    idx, k = _dense_fold(train)
    data = with_class_weight(train, "label").withColumn("cv_fold", idx)
    est = forest()
    maps = [{est.getParam(name): value for name, value in c.items()} for c in candidates]
    cv = CrossValidator(
        estimator=Pipeline(stages=[assembler(features), est]),
        estimatorParamMaps=maps,
        evaluator=BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability",
                                                metricName="areaUnderROC", numBins=0),
        foldCol="cv_fold",
        numFolds=k,
        parallelism=parallelism,
    )
    res = cv.fit(data)
    best = max(range(len(candidates)), key=lambda i: (res.avgMetrics[i], -i))
    rows = [
        (", ".join(f"{n}={c[n]}" for n in sorted(c)), float(res.avgMetrics[i]), int(i == best))
        for i, c in enumerate(candidates)
    ]
    table = frame.sparkSession.createDataFrame(rows, "params string, mean_roc_auc double, is_best int")
    return table, dict(candidates[best]), plain_model(res.bestModel)


def hash_share(key: str, seed: int = S.SPLIT_SEED) -> Column:
    """A number in [0, 1) from a hash of the row's key; the rows below a share are part of those below a larger one."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def successive_halving(
    frame: DataFrame, features: Sequence[str], candidates: Sequence[dict], seed: int = S.SPLIT_SEED, parallelism: int = 4,
    max_depth: int = S.COMPARE_MAX_DEPTH, key: str = S.KEY,
) -> tuple[DataFrame, dict]:
    """Candidates raced on nested samples of the training folds; the better half goes on, at last on all rows.

    A round fits every remaining candidate on all but the last training fold
    and compares their ROC AUC on that fold in one grouped pass; equal scores
    go to the earlier candidate.  The rounds' samples double and contain each
    other, so the result is the same on every run.  Returns ``(round, params,
    share, roc_auc, kept)`` and the survivor.
    """
    rounds = max(1, math.ceil(math.log2(max(len(candidates), 1))) + (len(candidates) == 1))
    train = frame.where(F.col("fold") != 0)
    held_out = train.agg(F.max("fold")).first()[0]
    left, rows = list(range(len(candidates))), []
    for r in range(rounds):
        share = 2.0 ** (r + 1 - rounds)
        sample = train.where(hash_share(key, seed) < share)
        fitting, judging = sample.where(F.col("fold") != held_out), sample.where(F.col("fold") == held_out)

        def run(i: int) -> DataFrame:
            settings = {"max_depth": max_depth, **candidates[i]}
            return scores(fit(fitting, features, forest(**settings)), judging).withColumn("candidate", F.lit(i))

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            parts = list(pool.map(run, left))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        auc = {a.candidate: a.roc_auc for a in evaluate.roc_auc_by(every, "candidate").collect()}
        ranked = sorted(left, key=lambda i: (-(auc.get(i) or 0.0), i))
        kept = ranked[: max(1, len(left) // 2)]
        rows += [(r, _shown(candidates[i]), share, auc.get(i), int(i in kept)) for i in left]
        left = sorted(kept)
    table = frame.sparkSession.createDataFrame(rows, "round int, params string, share double, roc_auc double, kept int")
    return table, dict(candidates[left[0]])


def _shown(candidate: dict) -> str:
    return ", ".join(f"{n}={candidate[n]}" for n in sorted(candidate))


def pair_information(df: DataFrame, columns: Sequence[str], numeric: Sequence[str], bins: int = 10) -> DataFrame:
    """Mutual information (nats) of every pair of columns: ``(a, b, n, information)`` with ``a`` before ``b``.

    Columns in ``numeric`` are cut into equal-width bins between their extremes
    (one aggregate); the others count by value; missing values are a value.
    The joint counts of all pairs come from one pass that makes a row per pair
    and combines them before the shuffle; everything after works on counts.
    """
    bounds = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in (("a", F.min), ("b", F.max))]).first() if numeric else None

    def binned(c: str) -> Column:
        x = F.col(f"`{c}`")
        if c not in numeric:
            return F.coalesce(x.cast("string"), F.lit(""))
        low, high = bounds[f"a{numeric.index(c)}"], bounds[f"b{numeric.index(c)}"]
        if low is None or low == high:
            return F.when(x.isNull(), "").otherwise("0")
        step = F.floor((x.cast("double") - F.lit(low)) * F.lit(bins / (high - low)))
        return F.coalesce(F.least(step, F.lit(bins - 1)).cast("string"), F.lit(""))

    cut = df.select(*[binned(c).alias(f"v{i}") for i, c in enumerate(columns)])
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"v{i}").alias("x"), F.col(f"v{j}").alias("y"))
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j
    ]
    joint = cut.select(F.inline(F.array(*pairs))).groupBy("a", "b", "x", "y").agg(F.count(F.lit(1)).alias("c"))

    def total(*by: str) -> Column:
        return F.sum("c").over(Window.partitionBy("a", "b", *by)).cast("double")

    # A pair's windows see its distinct value pairs, not its rows.
    cells = joint.select("a", "b", "c", total().alias("n"), total("x").alias("nx"), total("y").alias("ny"))
    term = F.col("c") / F.col("n") * F.log(F.col("c") * F.col("n") / (F.col("nx") * F.col("ny")))
    return cells.groupBy("a", "b").agg(F.max("n").cast("long").alias("n"), F.sum(term).alias("information"))


def select_without_redundancy(pairs: DataFrame, label: str, top: int) -> list[tuple[str, float]]:
    """Features picked one by one: the information on the label less the mean information on those picked before.

    ``pairs`` is ``pair_information`` with the label among its columns: one row
    per pair of columns.  Equal values go to the name first in order.
    """
    info = {frozenset((r.a, r.b)): r.information for r in pairs.collect()}
    names = sorted({n for pair in info for n in pair} - {label})
    picked: list[tuple[str, float]] = []
    while names and len(picked) < top:
        def worth(name: str) -> float:
            redundant = sum(info[frozenset((name, p))] for p, _ in picked) / max(len(picked), 1)
            return info[frozenset((name, label))] - redundant

        best = min(names, key=lambda n: (-worth(n), n))
        picked.append((best, worth(best)))
        names.remove(best)
    return picked


def champion_auc(spark: SparkSession, path: str, but: str | None = None) -> float | None:
    """ROC AUC of the champion published under ``path``, if there is one.

    With ``but`` the champion before those published under that tag, so that a
    rerun of one challenger is compared with what the first run met.
    """
    found = [p for p in pointers(spark, path) if but is None or p.get("tag") != but]
    return float(found[-1]["roc_auc"]) if found else None


def load_champion(path: str) -> PipelineModel:
    """The champion that the latest pointer under ``path`` names."""
    current = published(SparkSession.active(), path)
    if current is None:
        raise FileNotFoundError(f"no champion under {path}")
    return PipelineModel.load(str(current["path"]))


def promote(
    model: PipelineModel, auc: float | None, path: str, min_auc: float = S.PROMOTION_MIN_AUC, tag: str | None = None
) -> bool:
    """Publish the model as the champion when its AUC clears the bar and beats the current champion's.

    ``path`` is a durable folder of the caller's choice.  The model is written
    to a folder of its own and published, with its AUC, by one pointer: a
    promotion that stops before the pointer leaves the old champion with the
    old AUC.  ``tag`` names the challenger (its data and settings); a rerun
    under the same tag decides as the first run did and writes nothing again.
    """
    spark = SparkSession.active()
    current = champion_auc(spark, path, but=tag)
    if auc is None or auc < min_auc or (current is not None and auc <= current):
        return False
    latest = published(spark, path)
    if tag is not None and latest is not None and latest.get("tag") == tag and latest["roc_auc"] == float(auc):
        return True
    version = f"{path}/versions/{uuid.uuid4().hex}"
    model.write().save(version)
    publish(spark, path, version, {"roc_auc": float(auc), "tag": tag})
    return True


def permutation_importance(model: PipelineModel, test: DataFrame, features: Sequence[str],
                           seed: int = S.SPLIT_SEED) -> DataFrame:
    """ROC AUC drop when one input column of the test rows is permuted.

    The test rows are stored once, numbered by a seeded hash of their key.  A
    feature's copy shifts its column by an offset of its own along that order
    (a cyclic permutation over an arbitrary order).  All copies are made in one
    pass (``permuted``), where equal rows of a copy are counted; every distinct
    vector is scored once, and one grouped AUC covers all features.
    """
    from campaignlens.operators.split import seeded_hash

    feats = sorted(features)
    numbered = with_position(test, [seeded_hash(S.KEY, seed).asc(), F.col(S.KEY).asc()], name="_p")
    numbered = numbered.withColumn("_p", F.col("_p") - 1).checkpoint(eager=True)
    n = max(numbered.count(), 1)
    # The model may read columns that are not permuted.
    others = [f.name for f in test.schema.fields if isinstance(f.dataType, NumericType) and f.name not in (S.KEY, "fold", "label", *feats)]
    shifts = {f: 1 + (i * n) // (len(feats) + 1) for i, f in enumerate(feats)}
    counted = permuted_counts(numbered, "_p", n, [*feats, *others], "label", shifts)
    scored = model.transform(counted).select("copy", "tp", "fp", vector_to_array("probability")[1].alias("score"))
    curve = scored.groupBy("copy", "score").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    # One row per feature: a bounded frame.
    auc = evaluate.roc_auc_of_counts(curve, "copy")
    base = F.max(F.when(F.col("copy") == -1, F.col("roc_auc"))).over(Window.partitionBy())
    named = F.element_at(F.array(*map(F.lit, feats)), F.col("copy") + 1)
    return auc.withColumn("base_roc_auc", base).where(F.col("copy") >= 0).select(
        named.alias("feature"), "base_roc_auc", F.col("roc_auc").alias("permuted_roc_auc"),
        (F.col("base_roc_auc") - F.col("roc_auc")).alias("importance"),
    )
