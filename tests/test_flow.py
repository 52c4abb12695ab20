"""Stage materialization and plan guards."""

import tempfile

from pyspark.sql import functions as F

from campaignlens.plans import flow

SF = "/root/testdata/sf0.001"


def test_materialize_writes_every_stage(spark):
    out = tempfile.mkdtemp(prefix="campaignlens-stages-")
    paths = flow.materialize(spark, SF, out)
    assert list(paths) == flow.STAGES
    n = flow.inputs(spark, SF).core.count()
    assert spark.read.parquet(paths["processed_and_merged_data"]).count() == n
    assert spark.read.parquet(paths["split"]).where(F.col("fold").isNull()).count() == 0
    report = {r.metric: r.value for r in spark.read.parquet(paths["eval_report"]).collect()}
    assert {"BaselinePosRate", "PR_AUC", "ROC_AUC", "P@10%"} <= set(report)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(flow.usage_features(spark, SF))
    assert "l_extendedprice" not in plan and "l_comment" not in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_no_single_partition_exchange_in_stage_plans(spark):
    for df in (flow.merged(spark, SF), flow.scored(spark, SF)):
        assert "SinglePartition" not in _plan(df).split("Subquery")[0]


def test_modelling_frame_reads_only_the_tables_its_features_need(spark):
    from campaignlens import schemas as S

    plan = _plan(flow.modelling_frame(spark, SF, S.SELECTED_FEATURES))
    assert "lineitem.parquet" not in plan and "events.parquet" not in plan
    plan_all = _plan(flow.modelling_frame(spark, SF, S.SELECTED_FEATURES + ["total_used_gb", "recency"]))
    assert "lineitem.parquet" in plan_all and "events.parquet" in plan_all


def test_partial_merge_equals_full_merge_on_shared_columns(spark):
    full = flow.merged(spark, SF, fill=True)
    part = flow.merged(spark, SF, fill=True, columns=["recency", "num_interactions"])
    assert "total_used_gb" not in part.columns and "recency" in part.columns
    cols = part.columns
    assert full.select(*[F.col(f"`{c}`") for c in cols]).exceptAll(part).count() == 0
    assert part.count() == full.count()
