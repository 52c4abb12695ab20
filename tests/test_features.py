"""Group-shape edge cases of the usage and interaction aggregates (T8-T13)."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from campaignlens.operators import features

D = dt.date


def usage_frame(spark, rows):
    return spark.createDataFrame(
        rows, "rating_account_id long, billed_period_month_d date, has_used_roaming int, used_gb double"
    )


def test_usage_group_shapes(spark):
    rows = [
        (1, D(2024, 4, 1), 1, 5.0),                       # one row: std null
        (2, D(2024, 4, 1), None, None), (2, D(2024, 5, 1), None, None),  # all null: sum 0, flags 0
        (3, D(2024, 4, 1), 0, None), (3, D(2024, 5, 1), 1, 2.0), (3, D(2024, 6, 1), 0, 7.0),  # first null
        (4, None, 0, 9.0), (4, D(2024, 4, 1), 0, 3.0),     # null month sorts last
        (None, D(2024, 4, 1), 1, 1.0),                     # null key dropped
    ]
    out = {r.rating_account_id: r for r in features.usage_features(usage_frame(spark, rows)).collect()}
    assert set(out) == {1, 2, 3, 4}
    assert out[1].std_used_gb is None and out[1].total_used_gb == 5.0 and out[1].usage_increase == 0
    assert out[2].total_used_gb == 0.0 and out[2].roaming_months == 0 and out[2].roaming_ratio == 0.0
    assert out[2].usage_trend is None and out[2].usage_increase == 0
    assert out[3].usage_trend == 5.0 and out[3].usage_increase == 1
    assert out[4].usage_trend == 6.0 and out[4].usage_month_count == 1


def test_interaction_features_fill_and_patterns(spark):
    rows = [
        ("a", "produkte&services-tarifdetails", 2, 10),
        ("a", "PROLONGATION", 1, 5),
        ("a", None, 4, None),
        ("b", "rechnungsanfragen", 3, None),
        (None, "prolongation", 9, 1),
    ]
    df = spark.createDataFrame(rows, "customer_id string, type_subtype string, n long, days_since_last int")
    out = {r.customer_id: r for r in features.interaction_features(df).collect()}
    assert set(out) == {"a", "b"}
    a, b = out["a"], out["b"]
    assert (a.num_interactions, a.num_unique_interactions, a.recency) == (7, 2, 5)
    assert (a.interact_tarifdetails, a.interact_prolongations, a.interact_tarifwechsel) == (2, 1, 0)
    assert b.recency == 0 and b.interact_rechnungsanfragen == 3


def test_merge_keeps_rows_and_drops_orphan_interactions(spark):
    from campaignlens.plans import flow

    sf = "/root/testdata/sf0.001"
    merged = flow.merged(spark, sf)
    core = flow.inputs(spark, sf).core
    assert merged.count() == core.count()


def test_null_customer_key_keeps_its_row_unmatched(spark):
    # T23: right sides have no null keys; a contract without customer keeps its row, no interactions.
    core = spark.createDataFrame(
        [(1, "a"), (2, None), (3, "a")], "rating_account_id long, customer_id string"
    )
    inter = spark.createDataFrame(
        [("a", "prolongation", 2, 3)], "customer_id string, type_subtype string, n long, days_since_last int"
    )
    out = {r.rating_account_id: r for r in features.merge_features(
        core, None, features.interaction_features(inter)).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].num_interactions == 2 and out[3].num_interactions == 2
    assert out[2].num_interactions is None and out[2].recency is None


def test_usage_plans_a_hash_aggregate_with_and_without_ties(spark):
    rows = [(1, D(2024, 4, 1), 0, 1.0), (1, D(2024, 5, 1), 1, 4.0)]
    usage = usage_frame(spark, rows).withColumn("t", F.lit(7).cast("long"))
    for ties in ({}, {"t": 12}):
        for df in (features.usage_features(usage, ties), features.usage_trend(usage, ties)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_first_and_last_follow_period_then_ties(spark):
    rnd = random.Random(4)
    rows = [
        (rnd.randrange(6), rnd.choice([None, D(1, 1, 1), D(2024, 4, 1), D(2024, 5, 1), D(9999, 12, 31)]),
         rnd.choice([None, 0, 5, 10**12 - 2]), rnd.choice([None, 0, 3]), rnd.choice([None, float(rnd.randrange(99))]))
        for _ in range(300)
    ]
    rows = list({(r[0], r[1], r[2], r[3]): r for r in rows}.values())  # a total order inside each account
    df = spark.createDataFrame(rows, "rating_account_id long, billed_period_month_d date, t1 long, t2 int, used_gb double")
    df = df.withColumn("has_used_roaming", F.lit(0))
    got = {r.rating_account_id: (r.first_used_gb, r.last_used_gb)
           for r in features.usage_trend(df, {"t1": 12, "t2": 3}).collect()}
    first_none = lambda x: (x is not None, x or 0)
    for k in got:
        mine = sorted((r for r in rows if r[0] == k and r[4] is not None),
                      key=lambda r: (r[1] is None, r[1] or D(1, 1, 1), first_none(r[2]), first_none(r[3])))
        assert got[k] == (mine[0][4], mine[-1][4])


def test_tie_that_does_not_fit_ends_the_query(spark):
    df = usage_frame(spark, [(1, D(2024, 4, 1), 0, 1.0)]).withColumn("t", F.lit(1000))
    with pytest.raises(Exception, match="does not fit"):
        features.usage_trend(df, {"t": 3}).collect()


def test_nan_volumes_are_missing_as_in_pandas(spark):
    values = [float("nan"), 2.0, None, 5.0]
    rows = [(1, D(2024, 1 + i, 1), 0, v) for i, v in enumerate(values)] + [(2, D(2024, 1, 1), 0, float("nan"))]
    out = {r.rating_account_id: r for r in features.usage_features(usage_frame(spark, rows)).collect()}
    p = pd.Series(values, dtype=float)
    a = out[1]
    assert (a.total_used_gb, a.avg_used_gb, a.min_used_gb, a.max_used_gb) == (p.sum(), p.mean(), p.min(), p.max())
    assert a.std_used_gb == pytest.approx(p.std()) and a.usage_trend == 3.0 and a.usage_increase == 1
    assert out[2].total_used_gb == 0.0 and out[2].avg_used_gb is None and out[2].usage_trend is None


def test_interaction_sums_beyond_32_bits(spark):
    rows = [("a", "prolongation", 2_000_000_000, 10), ("a", "prolongation", 2_000_000_000, 5)]
    df = spark.createDataFrame(rows, "customer_id string, type_subtype string, n long, days_since_last int")
    r = features.interaction_features(df).first()
    assert r.num_interactions == r.interact_prolongations == 4_000_000_000
    assert features.pattern_counts(df).first().interact_prolongations == 4_000_000_000
    assert features.fill_interactions(features.interaction_features(df)).first().num_interactions == 4_000_000_000
