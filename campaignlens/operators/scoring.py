"""Transparent rule score and its rescaling to a base rate.

The weights are the generator's propensity rule; the score needs no model
fit, so every ranking metric can be checked against SQL with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.functions import clip, coerce_numeric


def rule_score_column() -> Column:
    """Weighted sum of predicates (a missing input counts as false), in [0, 1].

    The weights are summed as integer hundredths and divided once, so equal
    sums are equal doubles (ties stay ties).
    """
    total = None
    for pred, weight in S.RULE_TERMS:
        term = F.when(F.coalesce(F.expr(pred), F.lit(False)), F.lit(round(weight * 100))).otherwise(F.lit(0))
        total = term if total is None else total + term
    return clip(total.cast("double") / F.lit(100.0), 0.0, 1.0)


def score_contracts(core: DataFrame, name: str = "score") -> DataFrame:
    """``(key, customer, label, score)`` from the raw contracts.

    A missing data volume counts as false in the rule, so no imputation (and
    no pass for its median) is needed.
    """
    valued = core.withColumn("available_gb_value", coerce_numeric("available_gb"))
    return valued.select(S.KEY, S.CUSTOMER, S.LABEL, rule_score_column().alias(name))


def with_rule_score(processed: DataFrame, name: str = "score") -> DataFrame:
    """Score contracts of the cleaned table; an imputed volume counts as missing."""
    gb = F.when(F.col("available_gb_missing") == 0, F.col("available_gb"))
    return processed.withColumn("available_gb_value", gb).withColumn(name, rule_score_column()).drop(
        "available_gb_value"
    )


def calibrate_to_rate(df: DataFrame, score: str = "score", rate: float = S.RULE_BASE_RATE,
                      name: str = "calibrated_score") -> DataFrame:
    """``clip(score * rate / mean(score), 0, 1)``; the mean is a scalar subquery."""
    mean = df.select(F.avg(score)).scalar()
    factor = F.when(mean != 0, F.lit(rate) / mean).otherwise(F.lit(1.0))
    return df.withColumn(name, clip(F.col(score) * factor, 0.0, 1.0))
