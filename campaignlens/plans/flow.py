"""End-to-end composition of the stages, lazily (nothing runs until an action).

Stage graph: inputs -> processed core / usage features / interaction
features -> merged table -> folds -> scores -> evaluation.  Each function
returns a DataFrame; the caller decides what to persist or write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators import clean, features, scoring, split
from campaignlens.sources.tables import Inputs, derive_inputs


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return derive_inputs(spark, sf_dir)


def processed_core(
    spark: SparkSession, sf_dir: str, age_edges: Sequence[float] = S.AGE_EDGES, impute: bool = True
) -> DataFrame:
    return clean.process_core(inputs(spark, sf_dir).core, age_edges=age_edges, impute=impute)


def usage_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ins = inputs(spark, sf_dir)
    return features.usage_features(ins.usage, ins.usage_ties)


def interaction_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.interaction_features(inputs(spark, sf_dir).interactions)


def merged(spark: SparkSession, sf_dir: str, fill: bool = False,
           columns: Sequence[str] | None = None) -> DataFrame:
    """The merged feature table.

    With ``columns`` given, a side whose columns are not among them is not
    joined at all (Catalyst does not remove the salted customer join by
    itself), so a model on contract features alone never reads usage rows, and
    ``available_gb`` is left out where its median is not wanted.
    """
    ins = inputs(spark, sf_dir)
    wanted = set(columns) if columns is not None else None
    usage = features.usage_features(ins.usage, ins.usage_ties)
    inter = features.interaction_features(ins.interactions)
    if wanted is not None:
        if not wanted & (set(usage.columns) - {S.KEY}):
            usage = None
        if not wanted & (set(inter.columns) - {S.CUSTOMER}):
            inter = None
    impute = wanted is None or "available_gb" in wanted
    core = clean.process_core(ins.core, impute=impute)
    out = features.merge_features(core if impute else core.drop("available_gb"), usage, inter)
    return features.fill_interactions(out) if fill else out


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with its fold (computed from the contracts only)."""
    return split.customer_folds(inputs(spark, sf_dir).core)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contract with its rule score and fold (the contracts alone are read)."""
    return split.attach_folds(scoring.score_contracts(inputs(spark, sf_dir).core), folds(spark, sf_dir))


def contract_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contract with its label and fold."""
    core = inputs(spark, sf_dir).core.select(S.KEY, S.CUSTOMER, S.LABEL)
    return split.attach_folds(core, folds(spark, sf_dir))


def scored_test(spark: SparkSession, sf_dir: str, test_fold: int = 0) -> DataFrame:
    """The evaluation input: ``(key, label, score)`` of the test fold."""
    return scored(spark, sf_dir).where(F.col("fold") == test_fold).select(S.KEY, S.LABEL, "score")


def modelling_frame(spark: SparkSession, sf_dir: str, feature_names: Sequence[str]) -> DataFrame:
    """Merged, filled features with the fold column, ready for assembly."""
    from campaignlens.operators import model

    with_folds = split.attach_folds(merged(spark, sf_dir, fill=True, columns=feature_names), folds(spark, sf_dir))
    return model.model_frame(with_folds, feature_names)


STAGES = [
    "processed_core_data",
    "agg_processed_usage_info",
    "agg_processed_customer_interactions",
    "processed_and_merged_data",
    "split",
    "predictions",
    "eval_report",
]


def materialize(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                scorer: str = "rule", num_trees: int = S.RF_PARAMS["num_trees"]) -> dict[str, str]:
    """Run the stage graph and write every stage as Parquet under ``out_dir``.

    Each stage is written and read back before the next one uses it, so
    lineage is cut at stage boundaries: a lost executor recomputes only the
    stage in flight, from the stored inputs.  ``out_dir`` defaults to a
    folder under the shared stage root.  ``scorer`` is ``rule`` (transparent
    score) or ``forest``.  Returns the path of every stage.
    """
    import uuid

    from campaignlens.operators import evaluate, model
    from campaignlens.sources.sinks import stage_root, write_stage

    out = (out_dir or f"{stage_root(spark)}/run-{uuid.uuid4().hex}").rstrip("/")
    paths = {name: f"{out}/{name}" for name in STAGES}

    def store(name: str, df: DataFrame) -> DataFrame:
        write_stage(df, paths[name])
        return spark.read.parquet(paths[name])

    ins = inputs(spark, sf_dir)
    pc = store("processed_core_data", clean.process_core(ins.core))
    usage = store("agg_processed_usage_info", features.usage_features(ins.usage, ins.usage_ties))
    inter = store("agg_processed_customer_interactions", features.interaction_features(ins.interactions))
    merged_df = store("processed_and_merged_data", features.merge_features(pc, usage, inter))
    with_folds = store("split", split.assign_folds(merged_df))
    test = with_folds.where(F.col("fold") == 0)
    if scorer == "rule":
        scored_test = scoring.with_rule_score(test).select(S.KEY, S.LABEL, "score")
    elif scorer == "forest":
        frame = model.stored_frame(model.model_frame(with_folds, S.SELECTED_FEATURES))
        fitted = model.fit(frame.where(F.col("fold") != 0), S.SELECTED_FEATURES, model.forest(num_trees=num_trees))
        scored_test = model.scores(fitted, frame.where(F.col("fold") == 0))
    else:
        raise ValueError(scorer)
    preds = store("predictions", scored_test)
    store("eval_report", evaluate.eval_report(preds))
    return paths
