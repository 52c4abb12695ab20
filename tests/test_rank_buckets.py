"""The value-bucket order against plain windows: types, ties, missing values, skew and plans."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from campaignlens.operators import clean, evaluate, profile, rank
from campaignlens.operators.rank import grouped, with_position, with_prefix_sums


def same_positions(df, order, **kw):
    got = with_position(df, order, "pos", **kw).select("k", "pos")
    want = df.select("k", F.row_number().over(Window.orderBy(*order)).cast("long").alias("pos"))
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def typed(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        rows.append((
            i,
            rnd.choice([None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1e-300, 1.7e308, rnd.random(), 3.5]),
            rnd.choice([None, "", "a", "customer 1", "customer 12", "customer 2", "é", "zz\x00", "customer " + "9" * 40]),
            rnd.choice([None, Decimal(5), Decimal(10) ** 30, Decimal(-3)]),
            rnd.choice([None, True, False]),
            rnd.choice([None, 2**62, 2**62 + 1, -5, 7]),
        ))
    df = spark.createDataFrame(rows, "k long, x double, s string, d decimal(38,0), b boolean, l long")
    return df.withColumns({
        "day": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("k") % 40).cast("int")),
        "ts": F.timestamp_seconds(F.col("k") % 77),
        "ntz": F.expr("timestamp_ntz'2024-03-31 00:30:00' + make_interval(0, 0, 0, 0, 0, cast(k % 300 as int))"),
        "bin": F.col("s").cast("binary"),
    })


@pytest.mark.parametrize("column", ["x", "s", "d", "b", "l", "day", "ts", "ntz", "bin"])
def test_every_type_and_direction(spark, column):
    df = typed(spark)
    c = F.col(column)
    for first in (c.asc_nulls_last(), c.desc_nulls_first()):
        assert same_positions(df, [first, F.col("k").desc()], num_partitions=12)


def test_expressions_and_many_columns(spark):
    df = typed(spark)
    order = [F.md5(F.concat(F.lit("7:"), F.col("k").cast("string"))).asc(), F.col("k")]
    assert same_positions(df, order)
    assert same_positions(df, [F.col("b").desc(), (F.col("k") % 3).asc(), F.col("s").desc(), F.col("k").asc()])


def test_runs_are_even_under_ties_and_skew(spark):
    rows = [(i, 0.5 if i % 3 else (1e9 if i == 0 else i / 1e6), 1) for i in range(30_000)]
    df = spark.createDataFrame(rows, "k long, score double, y long")
    g = grouped(df, [F.col("score").desc(), F.col("k").asc()], ["y"], groups=20)
    sizes = [r["count"] for r in g.rows.groupBy("_g").count().collect()]
    assert max(sizes) <= 2 * 30_000 / 20 and sum(sizes) == 30_000
    assert sorted(g.before_n) == g.before_n and len(sizes) == len(g.before_n)


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "k long, x double")
    assert with_position(empty, [F.col("x").desc()], "p").count() == 0
    assert with_prefix_sums(empty, [F.col("x").desc()], ["k"]).count() == 0
    one = spark.createDataFrame([(1, None)], "k long, x double")
    assert [r.p for r in with_position(one, [F.col("x").desc(), F.col("k").asc()], "p").collect()] == [1]


def test_order_objects_and_plain_columns_agree(spark):
    df = typed(spark)
    a = with_position(df, [rank.Order(F.col("x"), descending=True, nulls_last=True), rank.Order(F.col("k"))], "pos")
    b = with_position(df, [F.col("x").desc(), F.col("k").asc()], "pos")
    assert a.select("k", "pos").exceptAll(b.select("k", "pos")).count() == 0


def test_double_sums(spark):
    rows = [(i, (i * 7) % 101, 0.25 * i) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, g long, v double")
    got = with_prefix_sums(df, [F.col("g"), F.col("k")], ["v"]).select("k", "cum_v")
    w = Window.orderBy("g", "k").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.k: r.c for r in df.select("k", F.sum("v").over(w).alias("c")).collect()}
    assert all(abs(r.cum_v - want[r.k]) < 1e-6 for r in got.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_sampling_in_the_plans(spark):
    rows = [(i, i % 2, (i * 37 % 1000) / 1000) for i in range(500)]
    scored = spark.createDataFrame(rows, "rating_account_id long, has_done_upselling int, score double")
    plans = [plan(evaluate.gains_curve(scored)), plan(profile.describe_numeric(scored, ["score"]))]
    numbers = scored.select(F.coalesce(F.col("score"), clean.median_of(scored, F.col("score"))).alias("x"))
    plans.append(plan(numbers))
    for p in plans:
        assert "InPandas" not in p and "InArrow" not in p and "ArrowEvalPython" not in p
        assert "rangepartitioning" not in p and "SinglePartition" not in p.split("HashAggregate")[0]


def test_unused_median_starts_no_job(spark, monkeypatch):
    core = spark.createDataFrame(
        [(1, "c", 30, 400, 10, 1, 0, "5", 20.0, "iPhone", 0)],
        "rating_account_id long, customer_id string, age int, contract_lifetime_days int, remaining_binding_days int, "
        "has_special_offer int, is_magenta1_customer int, available_gb string, gross_mrc double, smartphone_brand string, "
        "has_done_upselling int",
    )
    monkeypatch.setattr(clean, "median_of", lambda *a: pytest.fail("the median was computed"))
    assert clean.process_core(core, impute=False).first().available_gb == 5.0


def test_same_rows_when_recomputed(spark):
    df = typed(spark)
    out = with_position(df, [F.col("x").desc(), F.col("k").asc()], "pos").select("k", "pos")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, out.repartition(3).collect()))
