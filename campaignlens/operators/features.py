"""Per-contract usage and per-customer interaction features, and the merge.

Each aggregate is a single ``groupBy`` with partial (map-side) aggregation,
so a hot key is combined before the shuffle.  The ordered first/last values
are ``min_by``/``max_by`` over a fixed-width order key inside the same aggregate;
the four pattern counts are conditional sums inside the interaction
aggregate.  No self-join and no sort is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.functions import contains_pattern, ratio_fill_zero
from campaignlens.operators.joins import hot_key_left_join, hot_keys, shuffle_partitions

NO_TIES: Mapping[str, int] = MappingProxyType({})


# Seven digits for the period's day: every date shifted to be positive, a missing period after all of them.
_DAY_SHIFT = 1_000_000
_MISSING_DAY = 9_999_999
_DAY_DIGITS = 7
_KEY_DIGITS = 38


def period_order_key(month: Column, ties: Mapping[str, int]) -> Column:
    """Order of a usage row inside its contract as one ``decimal(38,0)``.

    Missing periods last, then the period, then the tie columns (missing
    first).  ``ties`` maps each tie column to its number of digits; a value
    that does not fit ends the query instead of spoiling the order.  A decimal
    is a fixed-width aggregation buffer, so ``min_by``/``max_by`` over it are
    hash aggregates with and without ties.
    """
    if sum(ties.values()) + _DAY_DIGITS > _KEY_DIGITS:
        raise ValueError("the tie columns have too many digits")
    dec = f"decimal({_KEY_DIGITS},0)"
    day = F.coalesce(F.unix_date(month).cast("long") + F.lit(_DAY_SHIFT), F.lit(_MISSING_DAY))
    key, below = day.cast(dec), sum(ties.values())
    key = key * F.lit(Decimal(10**below)).cast(dec)
    for name, digits in ties.items():
        below -= digits
        c = F.col(name).cast("long")
        fits = c.isNull() | ((c >= 0) & (c + 1 < F.lit(Decimal(10**digits))))
        place = F.when(fits, F.coalesce(c + 1, F.lit(0))).otherwise(
            F.raise_error(F.lit(f"{name} does not fit {digits} digits")).cast("long")
        )
        key = key + place.cast(dec) * F.lit(Decimal(10**below)).cast(dec)
    return key.cast(dec)


def first_last_exprs(value: str, month: Column, ties: Mapping[str, int]) -> tuple[Column, Column]:
    """First and last non-missing ``value`` in period order (two aggregates)."""
    v = F.col(value)
    key = F.when(v.isNotNull(), period_order_key(month, ties))
    return F.min_by(v, key), F.max_by(v, key)


def _usage_rows(usage: DataFrame) -> DataFrame:
    """Usage rows of an account; a NaN volume is a missing one."""
    gb = F.col("used_gb").cast("double")
    return usage.where(F.col(S.KEY).isNotNull()).withColumn("used_gb", F.when(~F.isnan(gb), gb))


def usage_features(usage: DataFrame, ties: Mapping[str, int] = NO_TIES) -> DataFrame:
    """Usage statistics and first-vs-last trend per ``rating_account_id``.

    Null keys are dropped like a pandas group-by does; a group with only
    missing values sums to 0; ``std`` is the sample deviation (null for one
    row).
    """
    month = F.to_date("billed_period_month_d")
    first, last = first_last_exprs("used_gb", month, ties)
    agg = (
        _usage_rows(usage)
        .groupBy(S.KEY)
        .agg(
            F.coalesce(F.sum("used_gb"), F.lit(0.0)).alias("total_used_gb"),
            F.avg("used_gb").alias("avg_used_gb"),
            F.stddev_samp("used_gb").alias("std_used_gb"),
            F.min("used_gb").alias("min_used_gb"),
            F.max("used_gb").alias("max_used_gb"),
            F.count(month).cast("long").alias("usage_month_count"),
            F.coalesce(F.sum("has_used_roaming"), F.lit(0)).cast("long").alias("roaming_months"),
            first.alias("_first"),
            last.alias("_last"),
        )
    )
    return agg.select(
        S.KEY,
        "total_used_gb",
        "avg_used_gb",
        "std_used_gb",
        "min_used_gb",
        "max_used_gb",
        "usage_month_count",
        "roaming_months",
        ratio_fill_zero("roaming_months", "usage_month_count").alias("roaming_ratio"),
        (F.col("roaming_months") > 0).cast("int").alias("had_roaming"),
        F.coalesce(F.col("_last") > F.col("_first"), F.lit(False)).cast("int").alias("usage_increase"),
        (F.col("_last") - F.col("_first")).alias("usage_trend"),
    )


# The partition column of stored usage states: the first day of the period's month.
STATE_MONTH = "month_dt"
# Tasks that share a month's rows: a month is stored in at most so many files.
STATE_SLICES = 16


def usage_states(usage: DataFrame, ties: Mapping[str, int] = NO_TIES) -> DataFrame:
    """Mergeable usage states per account and month.

    A state holds the number, mean and squared deviations of the volumes, their
    extremes, the counted periods and roaming rows, and the first and last
    volume with their order keys.  States of different months merge to the
    statistics of all their rows (``merge_usage_states``), so a month can be
    replaced without reading the others' rows.  Rows without a period form a
    state of their own.

    The rows are dealt once, by month and a slice of the accounts; the states
    are made where they land, and a writer that partitions by month finds a
    month in at most ``STATE_SLICES`` tasks.
    """
    month = F.to_date("billed_period_month_d")
    v = F.col("used_gb")
    key = F.when(v.isNotNull(), period_order_key(month, ties))
    return (
        _usage_rows(usage)
        .select(
            S.KEY, month.alias("billed_period_month_d"), "used_gb", "has_used_roaming", *ties,
            F.trunc(month, "MM").alias(STATE_MONTH), F.pmod(F.xxhash64(S.KEY), F.lit(STATE_SLICES)).cast("int").alias("_slice"),
        )
        .repartition(shuffle_partitions(usage), STATE_MONTH, "_slice")
        .groupBy(S.KEY, STATE_MONTH, "_slice")
        .agg(
            F.count(v).alias("n"),
            F.avg(v).alias("mean"),
            (F.var_pop(v) * F.count(v)).alias("m2"),
            F.sum(v).alias("total"),
            F.min(v).alias("low"),
            F.max(v).alias("high"),
            F.count(month).alias("periods"),
            F.coalesce(F.sum("has_used_roaming"), F.lit(0)).cast("long").alias("roaming"),
            F.min(key).alias("first_key"),
            F.min_by(v, key).alias("first"),
            F.max(key).alias("last_key"),
            F.max_by(v, key).alias("last"),
        )
        .drop("_slice")
    )


def _chan(a: Column, b: Column) -> Column:
    """Two ``(n, mean, m2)`` states merged after Chan; the second has rows."""
    n = a["n"] + b["n"]
    d = b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"),
        (a["mean"] + d * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).alias("m2"),
    )


def merge_usage_states(states: DataFrame) -> DataFrame:
    """The columns of ``usage_features`` from states of any number of months per account.

    The moments are merged one month after the other (an account has at most
    one state a month, so its list is as long as the calendar); everything else
    is a plain aggregate over the states, which meet by account before they are
    combined: hardly two of one account lie in one task, so combining them
    earlier would only shuffle wider rows.
    """
    moment = F.struct(F.col(STATE_MONTH).alias("month"), F.col("n").cast("double").alias("n"), "mean", "m2")
    merged = states.repartition(S.KEY).groupBy(S.KEY).agg(
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("total_used_gb"),
        F.array_sort(F.collect_list(F.when(F.col("n") > 0, moment))).alias("_moments"),
        F.min("low").alias("min_used_gb"),
        F.max("high").alias("max_used_gb"),
        F.sum("periods").alias("usage_month_count"),
        F.sum("roaming").alias("roaming_months"),
        F.min_by("first", "first_key").alias("_first"),
        F.max_by("last", "last_key").alias("_last"),
    )
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    m = merged.withColumn("_m", F.aggregate("_moments", zero, _chan))
    n = F.col("_m.n")
    return m.select(
        S.KEY,
        "total_used_gb",
        F.when(n > 0, F.col("_m.mean")).alias("avg_used_gb"),
        F.when(n > 1, F.sqrt(F.greatest(F.col("_m.m2"), F.lit(0.0)) / (n - 1))).alias("std_used_gb"),
        "min_used_gb",
        "max_used_gb",
        "usage_month_count",
        "roaming_months",
        ratio_fill_zero("roaming_months", "usage_month_count").alias("roaming_ratio"),
        (F.col("roaming_months") > 0).cast("int").alias("had_roaming"),
        F.coalesce(F.col("_last") > F.col("_first"), F.lit(False)).cast("int").alias("usage_increase"),
        (F.col("_last") - F.col("_first")).alias("usage_trend"),
    )


def usage_trend(usage: DataFrame, ties: Mapping[str, int] = NO_TIES) -> DataFrame:
    """First and last usage per contract with the increase flag and delta."""
    month = F.to_date("billed_period_month_d")
    first, last = first_last_exprs("used_gb", month, ties)
    agg = _usage_rows(usage).groupBy(S.KEY).agg(
        first.alias("first_used_gb"), last.alias("last_used_gb")
    )
    return agg.select(
        S.KEY,
        "first_used_gb",
        "last_used_gb",
        F.coalesce(F.col("last_used_gb") > F.col("first_used_gb"), F.lit(False))
        .cast("int")
        .alias("usage_increase"),
        (F.col("last_used_gb") - F.col("first_used_gb")).alias("usage_trend"),
    )


def pattern_sum(pattern: str, value: str = "n") -> Column:
    """Sum of ``value`` over rows whose subtype matches ``pattern`` (0 if none)."""
    return F.coalesce(
        F.sum(F.when(contains_pattern("type_subtype", pattern), F.col(value))), F.lit(0)
    )


def pattern_counts(
    interactions: DataFrame, patterns: Sequence[tuple[str, str]] = S.INTERACTION_PATTERNS
) -> DataFrame:
    """Per customer, the summed ``n`` for each subtype pattern, one pass."""
    return (
        interactions.where(F.col(S.CUSTOMER).isNotNull())
        .groupBy(S.CUSTOMER)
        .agg(*[pattern_sum(p).cast("long").alias(name) for p, name in patterns])
    )


def interaction_features(
    interactions: DataFrame, patterns: Sequence[tuple[str, str]] = S.INTERACTION_PATTERNS
) -> DataFrame:
    """Totals, distinct subtypes, recency and pattern counts per customer.

    Every column is a 64-bit integer with missing values filled with 0, as the
    reference step does (its later fill of recency with 999 never applies).
    """
    return (
        interactions.where(F.col(S.CUSTOMER).isNotNull())
        .groupBy(S.CUSTOMER)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("num_interactions"),
            F.count_distinct("type_subtype").cast("long").alias("num_unique_interactions"),
            F.coalesce(F.min("days_since_last"), F.lit(0)).cast("long").alias("recency"),
            *[pattern_sum(p).cast("long").alias(name) for p, name in patterns],
        )
    )


def merge_features(core: DataFrame, usage_agg: DataFrame | None, interaction_agg: DataFrame | None) -> DataFrame:
    """Contracts left-joined with usage (1:1) and interactions (n:1).

    Both right sides are unique on their key.  The account join is 1:1 and
    left to Spark (broadcast when AQE measures a side under the threshold,
    else sort-merge).  The customer join is n:1, so the rows of customers
    with very many contracts are salted and spread over several reducers
    (``joins.hot_key_left_join``).  The hot customers are counted on
    ``core`` alone: the account join is 1:1, so the counts are the same, and
    the count pass does not recompute the usage aggregate.  A side passed as
    ``None`` is left out (its columns are not needed downstream).
    """
    out = core
    cols = list(core.columns)
    if usage_agg is not None:
        out = out.join(usage_agg, on=S.KEY, how="left")
        cols += [c for c in usage_agg.columns if c != S.KEY]
    if interaction_agg is not None:
        out = hot_key_left_join(out, interaction_agg, S.CUSTOMER, hot=hot_keys(core, S.CUSTOMER))
        cols += [c for c in interaction_agg.columns if c != S.CUSTOMER]
    return out.select(*[F.col(f"`{c}`") for c in cols])


def fill_interactions(merged: DataFrame, recency_fill: int = S.RECENCY_FILL) -> DataFrame:
    """Notebook fills after the merge: counts -> 0, recency -> 999, as 64-bit integers.

    Only the interaction columns present are filled.
    """
    fills = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in S.INTERACTION_COUNT_COLUMNS
             if c in merged.columns}
    if "recency" in merged.columns:
        fills["recency"] = F.coalesce(F.col("recency"), F.lit(recency_fill)).cast("long")
    return merged.withColumns(fills)
