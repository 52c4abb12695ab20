"""The distributed rank, prefix sum and lag against plain single-task windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from campaignlens.operators.rank import with_position, with_prefix_sums, with_previous


def _scores(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    # Few distinct scores (heavy ties) and one value holding a third of the rows.
    rows = [(i, rnd.choice([0.1, 0.2, 0.35, 0.5, 0.9]) if i % 3 else 0.42, int(rnd.random() < 0.2))
            for i in range(n)]
    return spark.createDataFrame(rows, "k long, score double, y int")


def test_position_equals_row_number(spark):
    df = _scores(spark)
    order = [F.col("score").desc(), F.col("k").asc()]
    got = with_position(df, order, "pos").select("k", "pos")
    want = df.select("k", F.row_number().over(Window.orderBy(*order)).alias("pos"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_prefix_sums_equal_running_window(spark):
    df = _scores(spark)
    order = [F.col("score").desc(), F.col("k").asc()]
    got = with_prefix_sums(df, order, ["y"]).select("k", "position", "cum_y")
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", F.row_number().over(Window.orderBy(*order)).alias("position"),
                     F.sum("y").over(w).alias("cum_y"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_single_partition_exchange_over_rows(spark):
    df = _scores(spark)
    plan = with_position(df, [F.col("score").desc(), F.col("k").asc()], "pos")._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step is the window over the per-partition summary.
    assert plan.count("SinglePartition") <= 1


def test_previous_equals_lag_with_hot_group(spark):
    rnd = random.Random(3)
    # Customer "hot" holds a third of all contracts.
    rows = [("hot" if i % 3 == 0 else f"c{i % 97}", rnd.randint(1, 50), i, rnd.randint(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, life int, k long, y int")
    order = [F.col("life"), F.col("k")]
    got = with_previous(df, ["g"], order, ["y"], num_partitions=16).select("k", "prev_y")
    want = df.select("k", F.lag("y").over(Window.partitionBy("g").orderBy("life", "k")).alias("prev_y"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_previous_keeps_nulls_and_types(spark):
    rows = [("a", 1, 1, None), ("a", 2, 2, 1), ("a", 3, 3, 0), ("b", 1, 4, 1), (None, 1, 5, 0), ("b", 2, 6, None)]
    df = spark.createDataFrame(rows, "g string, life int, k long, y int")
    got = with_previous(df, ["g"], [F.col("life"), F.col("k")], ["y"], num_partitions=3)
    assert dict(got.dtypes)["prev_y"] == "int"
    want = df.select("k", F.lag("y").over(Window.partitionBy("g").orderBy("life", "k")).alias("prev_y"))
    got = got.select("k", "prev_y")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_carry_across_arrow_batches(spark):
    # Tiny Arrow batches: every stored partition spans many batches, so the carried values are exercised.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = _scores(spark, n=600)
        order = [F.col("score").desc(), F.col("k").asc()]
        got = with_prefix_sums(df, order, ["y"], num_partitions=4).select("k", "position", "cum_y")
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        want = df.select("k", F.row_number().over(Window.orderBy(*order)).alias("position"),
                         F.sum("y").over(w).alias("cum_y"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        rows = [("hot" if i % 3 == 0 else f"c{i % 13}", i % 17, i, i % 2) for i in range(600)]
        g = spark.createDataFrame(rows, "g string, life int, k long, y int")
        got = with_previous(g, ["g"], [F.col("life"), F.col("k")], ["y"], num_partitions=4).select("k", "prev_y")
        want = g.select("k", F.lag("y").over(Window.partitionBy("g").orderBy("life", "k")).alias("prev_y"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
