"""Fold invariants: disjoint by customer, balanced, deterministic."""

from pyspark.sql import functions as F

from campaignlens.plans import flow
from campaignlens.operators import split

SF = "/root/testdata/sf0.01"


def test_folds_are_group_disjoint_and_balanced(spark):
    scored = flow.scored(spark, SF)
    assert split.fold_leakage(scored).first().n_customers_multi_fold == 0
    bal = split.fold_balance(scored).collect()
    sizes = [r.n_rows for r in bal]
    rates = [r.pos_rate for r in bal]
    assert len(bal) == 5
    assert max(sizes) - min(sizes) <= 0.05 * max(sizes)
    assert max(rates) - min(rates) < 0.02


def test_folds_are_deterministic(spark):
    a = flow.folds(spark, SF).select("customer_id", "fold")
    b = flow.folds(spark, SF).select("customer_id", "fold")
    assert a.exceptAll(b).count() == 0


def test_exact_sample_size(spark):
    core = flow.inputs(spark, SF).core
    n = core.select("customer_id").distinct().count()
    assert split.sample_exact(core, "customer_id", 0.5, 42).count() == n // 2


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0)], "k string, n int")
    got = sorted((r.k, r.copy_no) for r in split.repeat_rows(df, "n").collect())
    assert got == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]


def test_repeat_rows_spreads_a_large_row_over_tasks(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("hot", 2500), ("a", 3), ("b", 0)], "k string, n long")
    out = split.repeat_rows(df, "n", chunk=100, num_partitions=8)
    got = out.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.min("copy_no").alias("lo"),
                               F.max("copy_no").alias("hi"), F.count_distinct("copy_no").alias("d"))
    rows = {r.k: (r.c, r.lo, r.hi, r.d) for r in got.collect()}
    assert rows == {"hot": (2500, 1, 2500, 2500), "a": (3, 1, 3, 3)}
    tasks = out.where(F.col("k") == "hot").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


def with_nulls(spark):
    rows = [(i, None if i % 5 < 2 else f"c{i % 7}", i, i % 2) for i in range(60)]
    return spark.createDataFrame(
        rows, "rating_account_id long, customer_id string, contract_lifetime_days int, has_done_upselling int"
    )


def test_contracts_without_customer_get_folds(spark):
    core = with_nulls(spark)
    folded = split.assign_folds(core)
    parts = split.train_test(folded)
    assert folded.columns == core.columns + ["fold"]
    assert folded.where(F.col("fold").isNull()).count() == 0
    assert parts["X_train"].count() + parts["X_test"].count() == 60
    assert parts["y_train"].count() + parts["y_test"].count() == 60
    assert split.fold_leakage(folded).first().n_customers_multi_fold == 0
    # Each of the 24 lone contracts is a group of its own.
    assert split.customer_folds(core).where(F.col("customer_id").isNull()).count() == 24


def test_customer_named_like_an_account_stays_apart(spark):
    core = spark.createDataFrame([(5, None, 1), (6, "account 5", 0)], "rating_account_id long, customer_id string, has_done_upselling int")
    assert split.customer_folds(core).count() == 2


def test_class_weights_read_the_rows_once(spark):
    w = split.class_weights(with_nulls(spark))
    assert {r.has_done_upselling: r.weight for r in w.collect()} == {0: 1.0, 1: 1.0}
    plan = split.class_weights(flow.inputs(spark, SF).core)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # orders and customer, once each


def test_copy_numbers_are_64_bit(spark):
    df = spark.createDataFrame([("a", 2)], "k string, n int")
    assert dict(split.repeat_rows(df, "n").dtypes)["copy_no"] == "bigint"


def test_heavy_customer_leaves_the_other_folds_even(spark):
    rows = [(i, "hot" if i < 10_000 else f"c{i % 5000}", int(i % 11 == 0)) for i in range(30_000)]
    df = spark.createDataFrame(rows, "rating_account_id long, customer_id string, has_done_upselling int")
    bal = {r.fold: r for r in split.fold_balance(split.assign_folds(df)).collect()}
    assert sorted((r.n_rows for r in bal.values()), reverse=True) == [10_000, 5000, 5000, 5000, 5000]
    rates = [r.pos_rate for r in bal.values()]
    assert max(rates) - min(rates) < 0.01
    assert split.fold_leakage(split.assign_folds(df)).first().n_customers_multi_fold == 0


def test_heavy_groups_fill_the_emptiest_fold():
    heavy = [("a", 50, 5), ("b", 40, 1), ("c", 30, 9), ("d", 20, 0)]
    fold_of, loads = split.place_heavy(heavy, 3)
    assert fold_of == {"a": 0, "b": 1, "c": 2, "d": 2} and loads == [50, 40, 50]
    assert split.room([50, 40, 50], 40) == [10.0, 20.0, 10.0]
    assert split.room([100, 0, 0], 50) == [0.0, 25.0, 25.0]
    turns = split.deal_slots([10.0, 20.0, 10.0], 8)
    assert sorted(turns) == [0, 0, 1, 1, 1, 1, 2, 2] and turns[:4].count(1) == 2


def test_only_heavy_groups(spark):
    rows = [(i, "ab"[i % 2], i % 3 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "rating_account_id long, customer_id string, has_done_upselling boolean")
    df = df.withColumn("has_done_upselling", F.col("has_done_upselling").cast("int"))
    folds = {r.customer_id: r.fold for r in split.customer_folds(df).collect()}
    assert sorted(folds.values()) == [0, 1]


def test_fold_table_is_a_hash_aggregate(spark):
    df = with_nulls(spark)
    plan = (
        df.select(split.group_key().alias("_group"), "customer_id", "has_done_upselling")
        .groupBy("_group", "customer_id").agg(F.count(F.lit(1)), F.sum("has_done_upselling"))
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "SortAggregate" not in plan
