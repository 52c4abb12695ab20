"""Contract cleaning: numeric coercion, imputation, flags, buckets, one-hot.

All steps are narrow projections except the median, a distributed exact
order statistic (one number) that is computed only where it is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators.rank import with_position
from campaignlens.functions import (
    bucketize,
    coerce_numeric,
    membership_flag,
    missing_flag,
    one_hot,
)

BUCKET_COLUMNS = [
    "remaining_binding_days_bucket",
    "mrc_bucket",
    "contract_term_bucket",
    "age_bucket",
]
ONE_HOT_SOURCES = BUCKET_COLUMNS + ["smartphone_brand"]


def median_of(df: DataFrame, c: Column, method: str = "exact") -> Column:
    """Global median of ``c`` as a constant (``exact``) or a scalar-subquery column.

    ``exact`` interpolates between the two middle values: distinct values are
    counted in one pass and stored, and the distributed order statistics of
    ``profile.exact_quantiles_counted`` pick the middle, so no task holds the
    distribution whatever its size; one number comes back.  ``builtin`` is Spark's ``median`` (one value->count
    map merged in one task: fine for a handful of distinct values).
    ``approx`` is the percentile sketch.
    """
    if method == "exact":
        from campaignlens.operators.profile import exact_quantiles_counted

        values = df.select(c.alias("value")).where(F.col("value").isNotNull())
        distinct = values.groupBy("value").agg(F.count(F.lit(1)).alias("c"))
        counted = distinct.select(F.lit("m").alias("column_name"), "value", "c")
        row = exact_quantiles_counted(counted, [0.5]).select("q0").first()
        return F.lit(row.q0 if row else None).cast("double")
    if method == "builtin":
        agg = F.median(c)
    elif method == "approx":
        agg = F.percentile_approx(c, 0.5, 10000).cast("double")
    else:
        raise ValueError(method)
    return df.select(agg.alias("m")).scalar()


def category_levels(df: DataFrame, c: str) -> DataFrame:
    """The domain of a category: ``(level, position)`` in code-point order, missing values left out.

    A frame, not a list: how many levels there are is up to the data.
    """
    levels = df.where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("level")).distinct()
    return with_position(levels, [F.col("level").asc()], name="position")


def bucket_columns(age_edges: Sequence[float] = S.AGE_EDGES) -> dict[str, Column]:
    return {
        "remaining_binding_days_bucket": bucketize(
            "remaining_binding_days", S.BINDING_EDGES, S.BINDING_LABELS
        ),
        "mrc_bucket": bucketize("gross_mrc", S.MRC_EDGES, S.MRC_LABELS),
        "contract_term_bucket": bucketize("contract_lifetime_days", S.TERM_EDGES, S.TERM_LABELS),
        "age_bucket": bucketize("age", age_edges, S.AGE_LABELS),
    }


def domains(brand_levels: Sequence[str] = S.BRAND_LEVELS) -> dict[str, list[str]]:
    return {
        "remaining_binding_days_bucket": list(S.BINDING_LABELS),
        "mrc_bucket": list(S.MRC_LABELS),
        "contract_term_bucket": list(S.TERM_LABELS),
        "age_bucket": list(S.AGE_LABELS),
        "smartphone_brand": list(brand_levels),
    }


def process_core(
    core: DataFrame,
    *,
    median_value: float | Column | None = None,
    median_method: str = "exact",
    age_edges: Sequence[float] = S.AGE_EDGES,
    brand_levels: Sequence[str] = S.BRAND_LEVELS,
    impute: bool = True,
) -> DataFrame:
    """Cleaned contracts with engineered columns.

    Output: the input columns (``available_gb`` now a median-imputed double),
    ``available_gb_missing``, ``is_premium_device``, four bucket labels and
    one indicator per non-first level of the four buckets and the brand.
    ``median_value`` lets a caller impute with a value fitted elsewhere (for
    example on the training folds only); by default it is the median of the
    whole input, as in the reference step.  ``brand_levels`` is the brand
    domain; it becomes columns, so it is given (``category_levels`` lists one).
    The median is a job of its own over the whole table; a caller that does not
    read ``available_gb`` leaves it missing with ``impute=False``.
    """
    gb = coerce_numeric("available_gb")
    if not impute:
        fill = F.lit(None).cast("double")
    elif median_value is None:
        fill = median_of(core, gb, median_method)
    elif isinstance(median_value, Column):
        fill = median_value
    else:
        fill = F.lit(float(median_value))

    out_cols = [F.coalesce(gb, fill).alias("available_gb") if c == "available_gb" else F.col(f"`{c}`")
                for c in core.columns]
    buckets = bucket_columns(age_edges)
    staged = core.select(
        *out_cols,
        missing_flag(gb).alias("available_gb_missing"),
        membership_flag("smartphone_brand", S.PREMIUM_BRANDS).alias("is_premium_device"),
        *[expr.alias(name) for name, expr in buckets.items()],
    )
    dom = domains(brand_levels)
    dummies = [d for src in ONE_HOT_SOURCES for d in one_hot(src, dom[src], drop_first=True)]
    return staged.select("*", *dummies)


def one_hot_names(brand_levels: Sequence[str] = S.BRAND_LEVELS) -> list[str]:
    dom = domains(brand_levels)
    return [f"{src}_{lvl}" for src in ONE_HOT_SOURCES for lvl in dom[src][1:]]
