"""Features from merged states against the one-pass features, and backfills of single months."""

import os
import random

import pytest
from pyspark.sql import functions as F

from campaignlens.operators import features
from campaignlens.sources import sinks

COLUMNS = "rating_account_id long, billed_period_month_d string, has_used_roaming int, used_gb double, t long"
TIES = {"t": 6}


def usage_rows(spark, n=2500, seed=3, offset=0.0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        month = rnd.choice([None, *[f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3, 4) for d in (1, 15)]])
        gb = rnd.choice([None, float("nan"), offset + rnd.random() * 50, offset + 1.5])
        account = None if rnd.random() < 0.02 else 0 if rnd.random() < 0.33 else rnd.randrange(1, 200)
        rows.append((account, month, rnd.choice([0, 1, None]), gb, i))
    rows += [(900, "2024-01-01", 1, None, 1), (901, None, 0, 3.0, 1), (902, "2024-03-01", 0, 4.0, 2)]
    return spark.createDataFrame(rows, COLUMNS)


def close(a, b):
    rows = {r.rating_account_id: r for r in a.collect()}
    want = b.collect()
    assert len(rows) == len(want)
    for w in want:
        got = rows[w.rating_account_id]
        for c in w.asDict():
            x, y = got[c], w[c]
            assert (x is None) == (y is None), (c, x, y)
            assert x is None or x == pytest.approx(y, rel=1e-9, abs=1e-9), (c, x, y)


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_merged_states_equal_the_one_pass_features(spark, offset):
    usage = usage_rows(spark, offset=offset)
    close(features.merge_usage_states(features.usage_states(usage, TIES)), features.usage_features(usage, TIES))


def test_any_backfill_gives_the_features_of_the_new_rows(spark, tmp_path):
    usage, path = usage_rows(spark), f"{tmp_path}/states"
    month = features.STATE_MONTH
    sinks.write_stage(features.usage_states(usage, TIES), path, partition_by=[month])
    day = F.to_date("billed_period_month_d")
    current = usage
    for lo, hi, seed in (("2024-02-01", "2024-03-01", 8), ("2024-01-01", "2024-04-01", 9), ("2024-06-01", "2024-07-01", 1)):
        inside = (day >= F.lit(lo).cast("date")) & (day < F.lit(hi).cast("date"))
        fresh = usage_rows(spark, 400, seed).where(inside)
        sinks.backfill_date_range(features.usage_states(fresh, TIES), path, month, lo, hi)
        touched = [r[0] for r in fresh.select(F.trunc(day, "MM")).distinct().collect()]
        current = current.where(~F.coalesce(F.trunc(day, "MM").isin(touched or [None]), F.lit(False))).unionByName(fresh)
        close(features.merge_usage_states(spark.read.parquet(path)), features.usage_features(current, TIES))


def test_states_are_one_row_per_account_and_month(spark):
    states = features.usage_states(usage_rows(spark), TIES)
    assert states.groupBy("rating_account_id", features.STATE_MONTH).count().where("count > 1").count() == 0
    assert states.where("rating_account_id IS NULL").count() == 0


def test_empty_states(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert features.merge_usage_states(features.usage_states(empty, TIES)).count() == 0


def test_states_are_dealt_once_and_meet_by_account_once(spark, tmp_path):
    states = features.usage_states(usage_rows(spark), TIES)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    sinks.write_stage(states, f"{tmp_path}/states", partition_by=[features.STATE_MONTH])
    months = [d for d in os.listdir(f"{tmp_path}/states") if d.startswith(features.STATE_MONTH)]
    assert months and all(len([f for f in os.listdir(f"{tmp_path}/states/{d}") if f.endswith(".parquet")]) <= features.STATE_SLICES for d in months)
    merged = features.merge_usage_states(spark.read.parquet(f"{tmp_path}/states"))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_" in plan.split("Exchange hashpartitioning")[0]
