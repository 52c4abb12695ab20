"""Scans of the input tables.

The pipeline consumes three tables: ``core_data`` (one row per contract),
``usage_info`` (one row per contract and billing period) and
``customer_interactions`` (one row per customer and subtype).  Production
deployments read them with ``read_table`` and a declared schema.  The test
tables are TPC-H-like; ``derive_inputs`` maps them onto the three inputs
with plain projections, one join and one aggregation, so that their size
grows with the scale factor.  Only the needed columns are selected, so the
Parquet scans carry a pruned ``ReadSchema``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the test views: the reference dates for the two day counts.
LIFETIME_AS_OF = "2001-08-02"
INTERACTION_AS_OF = "2024-01-31"
# Tie columns of the usage view with their digits (part, supplier, line number).
USAGE_TIE_COLUMNS = {"tie_1": 12, "tie_2": 10, "tie_3": 6}


@dataclass
class Inputs:
    core: DataFrame
    usage: DataFrame
    interactions: DataFrame
    usage_ties: dict[str, int]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with an optional declared schema (no inference)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts: one row per order, customer attributes from ``customer``."""
    o = raw(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("o_orderkey")
    brand = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "iPhone")
        .when(F.col("o_orderpriority") == "2-HIGH", "Samsung")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Huawei")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Xiaomi")
        .otherwise("OnePlus")
    )
    gb = (
        F.when(k % 7 == 6, F.lit(None).cast("string"))
        .when(k % 101 == 0, F.lit("n/a"))
        .otherwise(((k % 7) * 10).cast("string"))
    )
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        k.alias("rating_account_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.lit(18) + k % 83).cast("int").alias("age"),
        F.datediff(F.lit(LIFETIME_AS_OF).cast("date"), F.col("o_orderdate").cast("date"))
        .cast("int")
        .alias("contract_lifetime_days"),
        ((k * 37) % 2103 - 1051).cast("int").alias("remaining_binding_days"),
        (k % 10 < 3).cast("int").alias("has_special_offer"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("is_magenta1_customer"),
        gb.alias("available_gb"),
        (F.lit(5) + F.floor("o_totalprice").cast("bigint") % 66).cast("double").alias("gross_mrc"),
        brand.alias("smartphone_brand"),
        ((F.col("o_orderstatus") == "P") & (k % 5 == 0)).cast("int").alias("has_done_upselling"),
    )


def derive_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage rows: one per line item; the ship date plays the billing period."""
    li = raw(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("rating_account_id"),
        F.col("l_shipdate").alias("billed_period_month_d"),
        (F.col("l_returnflag") == "R").cast("int").alias("has_used_roaming"),
        F.col("l_quantity").alias("used_gb"),
        F.col("l_partkey").alias("tie_1"),
        F.col("l_suppkey").alias("tie_2"),
        F.col("l_linenumber").alias("tie_3"),
    )


def derive_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction rows: events counted per user and mapped subtype.

    One subtype is null and one carries an upper-case letter on purpose, to
    exercise the case-insensitive, null-safe pattern match downstream.
    """
    ev = raw(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    et = F.col("event_type")
    subtype = (
        F.when(et == "click", "produkte&services-tarifdetails")
        .when(et == "view", "produkte&services-Tarifwechsel")
        .when(et == "purchase", "prolongation")
        .when(et == "error", "rechnungsanfragen")
    )
    since = F.datediff(F.lit(INTERACTION_AS_OF).cast("date"), F.col("ts").cast("date"))
    return (
        ev.select(
            F.col("user_id").cast("string").alias("customer_id"),
            subtype.alias("type_subtype"),
            since.alias("since"),
        )
        .groupBy("customer_id", "type_subtype")
        .agg(F.count(F.lit(1)).alias("n"), F.min("since").cast("int").alias("days_since_last"))
    )


def derive_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        core=derive_core(spark, sf_dir),
        usage=derive_usage(spark, sf_dir),
        interactions=derive_interactions(spark, sf_dir),
        usage_ties=dict(USAGE_TIE_COLUMNS),
    )
