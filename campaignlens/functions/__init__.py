from campaignlens.functions.columns import (
    bucketize,
    clip,
    coerce_numeric,
    contains_pattern,
    membership_flag,
    missing_flag,
    one_hot,
    ratio_fill_zero,
)

__all__ = [
    "bucketize",
    "clip",
    "coerce_numeric",
    "contains_pattern",
    "membership_flag",
    "missing_flag",
    "one_hot",
    "ratio_fill_zero",
]
