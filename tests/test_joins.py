"""Salted hot-key left join equals the plain left join."""

from pyspark.sql import functions as F

from campaignlens.operators.joins import hot_key_left_join, hot_keys, hot_keys_from_counts
from campaignlens.plans import flow
from campaignlens.plans.profile_queries import brand_rates
from tests.conftest import SF_SMALL


def frames(spark):
    # "hot" holds a third of the left rows; one key has no right row; one left key is null.
    left = spark.createDataFrame(
        [("hot" if i % 3 == 0 else (None if i == 1 else f"c{i % 50}"), i) for i in range(3000)],
        "customer_id string, k long",
    )
    right = spark.createDataFrame([("hot", 7)] + [(f"c{i}", i) for i in range(49)], "customer_id string, v int")
    return left, right


def test_hot_key_join_matches_plain_join(spark):
    left, right = frames(spark)
    want = left.join(right, "customer_id", "left")
    for partitions in (None, 1, 4, 1000):
        got = hot_key_left_join(left, right, "customer_id", partitions=partitions)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_salts_follow_the_share_of_a_partition(spark):
    left, _ = frames(spark)
    # 2999 rows with a key over 8 partitions: 375 rows each; "hot" (1000 rows) fills 2.7 of them.
    assert {r.customer_id: (r._rows, r._salts) for r in hot_keys(left, "customer_id", 8).collect()} == {"hot": (1000, 3)}
    many = {r.customer_id: r._salts for r in hot_keys(left, "customer_id", 600).collect()}
    assert many["hot"] == 201 and len(many) == 51 and sum(many.values()) <= 2 * 600
    assert hot_keys(left, "customer_id", 2).count() == 0


def test_many_hot_keys_are_all_salted(spark):
    counts = spark.createDataFrame([(f"k{i}", 500) for i in range(2000)], "customer_id string, n long")
    got = hot_keys_from_counts(counts, "customer_id", "n", partitions=4000)
    assert got.count() == 2000 and {r._salts for r in got.select("_salts").distinct().collect()} == {2}


def test_registered_query_runs_the_salted_path(spark):
    core = flow.inputs(spark, SF_SMALL).core
    hot = hot_keys_from_counts(brand_rates(core), "smartphone_brand", "brand_rows")
    assert hot.count() == 5 and hot.agg(F.min("_salts")).first()[0] >= 2
    assert "xxhash64" in str(
        hot_key_left_join(core, brand_rates(core), "smartphone_brand", hot=hot)._jdf.queryExecution().executedPlan().toString()
    )


def test_rows_without_a_key_spread_over_the_tasks(spark):
    from pyspark.sql import functions as F

    from campaignlens.operators.joins import hot_key_left_join

    left = spark.range(100_000).select(
        F.col("id"), F.when(F.col("id") % 10 < 6, F.lit(None)).otherwise((F.col("id") % 5000).cast("string")).alias("c")
    )
    right = spark.range(5000).select(F.col("id").cast("string").alias("c"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_key_left_join(left, right, "c")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 100_000 and max(sizes) <= 2 * 100_000 / 8
        assert joined.where("c IS NULL AND v IS NOT NULL").count() == 0
        assert joined.where("c IS NOT NULL AND v IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
