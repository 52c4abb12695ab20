"""Column semantics that must equal the reference's pandas behaviour."""

import math

from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.functions import bucketize, coerce_numeric, contains_pattern, one_hot, ratio_fill_zero
from campaignlens.operators import clean


def test_binding_bucket_edges(spark):
    # Right-closed intervals, out of range -> null (measured with an interval cut).
    values = [-1001, -1000, -999, -1, 0, 30, 31, 90, 91, 180, 181, 1000, 1001]
    expected = [None, None, "Expired", "Expired", "0-30", "0-30", "31-90", "31-90", "91-180", "91-180",
                ">180", ">180", None]
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = [r.b for r in df.select(bucketize("x", S.BINDING_EDGES, S.BINDING_LABELS).alias("b")).collect()]
    assert got == expected


def test_label_text_is_kept_verbatim(spark):
    df = spark.createDataFrame([(30.0,), (50.0,), (70.0,), (0.0,), (70.5,)], "x double")
    got = [r.b for r in df.select(bucketize("x", S.MRC_EDGES, S.MRC_LABELS).alias("b")).collect()]
    assert got == ["Low (<30€)", "Mid (30-50€)", "High (>50€)", None, None]


def test_notebook_age_edges_differ_at_46_and_61(spark):
    df = spark.createDataFrame([(45,), (46,), (60,), (61,)], "x int")
    asset = [r.b for r in df.select(bucketize("x", S.AGE_EDGES, S.AGE_LABELS).alias("b")).collect()]
    nb = [r.b for r in df.select(bucketize("x", S.AGE_EDGES_NOTEBOOK, S.AGE_LABELS).alias("b")).collect()]
    assert asset == ["25-45", "46-60", "46-60", ">60"]
    assert nb == ["25-45", "25-45", "46-60", "46-60"]


def test_numeric_text_coercion(spark):
    texts = [" 12 ", "x", None, "nan", "1e3", "1d", "2F", "1e400", "-1e400", ".5", "5.", "+7", "1_0", "", "inf", "0x1A"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.v for r in df.select(coerce_numeric("s").alias("v")).collect()]
    want = [12.0, None, None, None, 1000.0, None, None, None, None, 0.5, 5.0, 7.0, None, None, math.inf, None]
    assert got == want


def test_one_hot_drops_first_level_and_zeros_for_missing(spark):
    df = spark.createDataFrame([("Huawei",), ("iPhone",), (None,), ("OnePlus",)], "smartphone_brand string")
    cols = one_hot("smartphone_brand", S.BRAND_LEVELS)
    out = df.select(*cols)
    assert out.columns == [f"smartphone_brand_{b}" for b in ["OnePlus", "Samsung", "Xiaomi", "iPhone"]]
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(0, 0, 0, 0), (0, 0, 0, 1), (0, 0, 0, 0), (1, 0, 0, 0)]


def test_pattern_is_case_insensitive_and_null_safe(spark):
    df = spark.createDataFrame([("produkte&services-Tarifwechsel",), (None,), ("prolongation",)], "t string")
    got = [r.m for r in df.select(contains_pattern("t", "tarifwechsel").alias("m")).collect()]
    assert got == [True, False, False]


def test_ratio_fill(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 2)], "a long, b long")
    got = [r.r for r in df.select(ratio_fill_zero("a", "b").alias("r")).collect()]
    assert got[0] == 0.0 and math.isinf(got[1]) and got[2] == 0.5


def test_process_core_dummies_sum_to_at_most_one(spark):
    from campaignlens.plans import flow

    pc = flow.processed_core(spark, "/root/testdata/sf0.001")
    assert len(pc.columns) == 33
    for src in clean.ONE_HOT_SOURCES:
        names = [c for c in pc.columns if c.startswith(src + "_") and c != src + "_bucket"]
        total = sum(F.col(f"`{c}`") for c in names)
        assert pc.where(total > 1).count() == 0


def test_median_is_exact_and_interpolated(spark):
    df = spark.createDataFrame([("0",), ("10",), ("20",), ("50",), (None,), ("n/a",)], "available_gb string")
    gb = coerce_numeric("available_gb")
    got = df.select(clean.median_of(df, gb).alias("m")).first().m
    assert got == 15.0


def test_category_levels_in_code_point_order(spark):
    df = spark.createDataFrame([(b,) for b in ["iPhone", None, "Xiaomi", "OnePlus", "iPhone"]], "b string")
    got = [(r.level, r.position) for r in clean.category_levels(df, "b").orderBy("position").collect()]
    assert got == [("OnePlus", 1), ("Xiaomi", 2), ("iPhone", 3)]
