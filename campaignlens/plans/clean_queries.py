"""Registered queries: scans, cleaning and feature stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.functions import bucketize, coerce_numeric, membership_flag, missing_flag
from campaignlens.operators import clean, features
from campaignlens.plans import flow
from campaignlens.plans.oracle_views import with_views
from campaignlens.plans.registry import register, round_doubles, sql_round

USAGE_DOUBLES = [
    "total_used_gb", "avg_used_gb", "std_used_gb", "min_used_gb", "max_used_gb",
    "roaming_ratio", "usage_trend",
]


@register("scan_core", sql=with_views("SELECT * FROM core_data"))
def scan_core(spark, sf_dir):
    return flow.inputs(spark, sf_dir).core


@register(
    "coerce_numeric",
    sql=with_views("SELECT rating_account_id, available_gb AS available_gb_raw, gb AS available_gb FROM core_gb"),
)
def coerce_numeric_q(spark, sf_dir):
    core = flow.inputs(spark, sf_dir).core
    return core.select(
        S.KEY, F.col("available_gb").alias("available_gb_raw"), coerce_numeric("available_gb").alias("available_gb")
    )


@register(
    "missing_flag",
    sql=with_views("SELECT rating_account_id, CAST(gb IS NULL AS INTEGER) AS available_gb_missing FROM core_gb"),
)
def missing_flag_q(spark, sf_dir):
    core = flow.inputs(spark, sf_dir).core
    return core.select(S.KEY, missing_flag(coerce_numeric("available_gb")).alias("available_gb_missing"))


@register(
    "impute_median",
    sql=with_views(
        "SELECT rating_account_id, coalesce(gb, (SELECT median(gb) FROM core_gb)) AS available_gb, "
        "(SELECT median(gb) FROM core_gb) AS median_available_gb FROM core_gb"
    ),
)
def impute_median_q(spark, sf_dir):
    core = flow.inputs(spark, sf_dir).core
    gb = coerce_numeric("available_gb")
    med = clean.median_of(core, gb)
    return core.select(S.KEY, F.coalesce(gb, med).alias("available_gb"), med.alias("median_available_gb"))


@register(
    "premium_flag",
    sql=with_views(
        "SELECT rating_account_id, smartphone_brand, "
        "CAST(coalesce(smartphone_brand IN ('iPhone', 'Samsung'), false) AS INTEGER) AS is_premium_device "
        "FROM core_data"
    ),
)
def premium_flag_q(spark, sf_dir):
    core = flow.inputs(spark, sf_dir).core
    return core.select(
        S.KEY, "smartphone_brand", membership_flag("smartphone_brand", S.PREMIUM_BRANDS).alias("is_premium_device")
    )


_BUCKET_SELECT = (
    "SELECT rating_account_id, remaining_binding_days_bucket, mrc_bucket, contract_term_bucket, age_bucket "
    "FROM pc_buckets"
)


@register("buckets", sql=with_views(_BUCKET_SELECT))
def buckets_q(spark, sf_dir):
    core = flow.inputs(spark, sf_dir).core
    return core.select(S.KEY, *[e.alias(n) for n, e in clean.bucket_columns().items()])


@register(
    "buckets_notebook_age",
    sql=with_views("SELECT rating_account_id, age, age_bucket FROM pc_buckets", age_edges=(46, 61)),
)
def buckets_notebook_age_q(spark, sf_dir):
    core = flow.inputs(spark, sf_dir).core
    return core.select(S.KEY, "age", bucketize("age", S.AGE_EDGES_NOTEBOOK, S.AGE_LABELS).alias("age_bucket"))


_ONE_HOT_NAMES = clean.one_hot_names()


@register(
    "one_hot",
    sql=with_views("SELECT rating_account_id, " + ", ".join(f'"{c}"' for c in _ONE_HOT_NAMES) + " FROM processed_core"),
)
def one_hot_q(spark, sf_dir):
    return flow.processed_core(spark, sf_dir, impute=False).select(S.KEY, *[F.col(f"`{c}`") for c in _ONE_HOT_NAMES])


@register("processed_core", sql=with_views("SELECT * FROM processed_core"))
def processed_core_q(spark, sf_dir):
    return round_doubles(flow.processed_core(spark, sf_dir))


@register("usage_features", sql=sql_round(with_views("SELECT * FROM usage_features"), USAGE_DOUBLES))
def usage_features_q(spark, sf_dir):
    return round_doubles(flow.usage_features(spark, sf_dir))


@register(
    "usage_trend",
    sql=sql_round(
        with_views(
            "SELECT rating_account_id, first_used_gb, last_used_gb, "
            "CAST(coalesce(last_used_gb > first_used_gb, false) AS INTEGER) AS usage_increase, "
            "last_used_gb - first_used_gb AS usage_trend FROM usage_agg"
        ),
        ["usage_trend"],
    ),
)
def usage_trend_q(spark, sf_dir):
    ins = flow.inputs(spark, sf_dir)
    return round_doubles(features.usage_trend(ins.usage, ins.usage_ties))


@register(
    "pattern_counts",
    sql=with_views(
        "SELECT customer_id, interact_prolongations, interact_tarifdetails, interact_tarifwechsel, "
        "interact_rechnungsanfragen FROM interaction_features"
    ),
)
def pattern_counts_q(spark, sf_dir):
    return features.pattern_counts(flow.inputs(spark, sf_dir).interactions)


@register("interaction_features", sql=with_views("SELECT * FROM interaction_features"))
def interaction_features_q(spark, sf_dir):
    return flow.interaction_features(spark, sf_dir)


@register("merge_features", sql=sql_round(with_views("SELECT * FROM merged"), USAGE_DOUBLES))
def merge_features_q(spark, sf_dir):
    return round_doubles(flow.merged(spark, sf_dir))


@register("merge_filled", sql=sql_round(with_views("SELECT * FROM merged_filled"), USAGE_DOUBLES))
def merge_filled_q(spark, sf_dir):
    return round_doubles(flow.merged(spark, sf_dir, fill=True))
