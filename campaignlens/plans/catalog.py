"""All registered queries, imported once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campaignlens.plans import clean_queries, eval_queries, model_queries, profile_queries  # noqa: F401
from campaignlens.plans.registry import REGISTRY, Query


def registry() -> dict[str, Query]:
    return dict(REGISTRY)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY["eval_report"].build(spark, sf_dir)
