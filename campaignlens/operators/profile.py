"""Data profiling and checks: missing values, value counts, describe,
histograms, key uniqueness, stage parity, month-count rule and drift.

Column-wise profiles reshape the table into long ``(column_name, value)``
rows with ``explode`` and aggregate once; the partial aggregation collapses
hot values before the shuffle.  Quantiles are exact without a global
percentile buffer: distinct values with counts are ordered by the
distributed prefix sum and the needed order statistics are picked by
cumulative-count ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlens.operators.rank import with_prefix_sums


def _is_floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _missing(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    return (col.isNull() | F.isnan(col)) if _is_floating(df, c) else col.isNull()


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count, null_share)`` for every column, one pass."""
    columns = list(columns or df.columns)
    agg = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("null_count"))
        for i, c in enumerate(columns)
    ]
    return agg.select("_n", F.inline(F.array(*rows))).select(
        "column_name", "null_count", F.try_divide(F.col("null_count").cast("double"), F.col("_n")).alias("null_share")
    )


def schema_summary(df: DataFrame) -> DataFrame:
    """``(column_name, dtype, non_null, n_rows)`` for every column, one pass."""
    agg = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(~_missing(df, f.name)).alias(f"_c{i}") for i, f in enumerate(df.schema.fields)],
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"_c{i}").alias("non_null"),
            F.col("_n").alias("n_rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return agg.select(F.inline(F.array(*rows)))


def long_values(df: DataFrame, columns: Sequence[str], value_type: str = "string",
                extra: Sequence[str] = ()) -> DataFrame:
    """One row per (input row, column): ``(column_name, value, *extra)``."""
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast(value_type).alias("value"))
            for c in columns
        ])
    )
    return df.select(pairs.alias("_p"), *extra).select("_p.*", *extra)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, n, share)``; missing values are left out of both."""
    long = long_values(df, columns).where(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # One row per profiled column: a bounded frame, broadcast.
    totals = F.broadcast(counts.groupBy("column_name").agg(F.sum("n").alias("_t")))
    return counts.join(totals, "column_name").select(
        "column_name", "value", "n", (F.col("n") / F.col("_t")).alias("share")
    )


def crosstab_label_rate(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Row-normalised feature x label table: ``(feature, value, share_0, share_1)``."""
    long = long_values(df, features, extra=[label]).where(
        F.col("value").isNotNull() & F.col(label).isNotNull()
    )
    return long.groupBy(F.col("column_name").alias("feature"), "value").agg(
        F.avg((F.col(label) == 0).cast("double")).alias("share_0"),
        F.avg((F.col(label) == 1).cast("double")).alias("share_1"),
    )


def exact_quantiles(long: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per ``column_name``.

    ``long`` holds ``(column_name, value)`` with non-missing numeric values.
    Returns ``(column_name, q0, q1, ...)``.  Distinct values are counted
    first, so a value repeated on a third of the rows is one row here.
    """
    dv = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c"))
    return exact_quantiles_counted(dv, quantiles)


def exact_quantiles_counted(dv: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """``exact_quantiles`` over distinct values with counts ``(column_name, value, c)``."""
    seq = with_prefix_sums(dv, [F.col("column_name").asc(), F.col("value").asc()], ["c"], position="_p")
    # Totals from the stored sequence, not by recomputing the input.
    per_col = seq.groupBy("column_name").agg(F.sum("c").alias("_n"))
    before = Window.orderBy("column_name").rowsBetween(Window.unboundedPreceding, -1)
    wanted_cols = [F.col("column_name"), F.col("_n")]
    for i, q in enumerate(quantiles):
        h = (F.col("_n") - 1) * F.lit(float(q))
        wanted_cols += [
            (F.col("_off") + F.floor(h) + 1).alias(f"_lo{i}"),
            (F.col("_off") + F.ceil(h) + 1).alias(f"_hi{i}"),
            (h - F.floor(h)).alias(f"_f{i}"),
        ]
    # One row per profiled column: bounded by the column count, broadcast.
    wanted = F.broadcast(
        per_col.select("column_name", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
        .select(*wanted_cols)
    )
    hit = seq.join(wanted, "column_name")
    lo_prev = F.col("cum_c") - F.col("c")

    def covers(pos: str) -> Column:
        return (lo_prev < F.col(pos)) & (F.col(pos) <= F.col("cum_c"))

    picks = []
    for i in range(len(quantiles)):
        picks += [
            F.max(F.when(covers(f"_lo{i}"), F.col("value"))).alias(f"_vlo{i}"),
            F.max(F.when(covers(f"_hi{i}"), F.col("value"))).alias(f"_vhi{i}"),
            F.max(f"_f{i}").alias(f"_ff{i}"),
        ]
    got = hit.groupBy("column_name").agg(*picks)
    return got.select(
        "column_name",
        *[(F.col(f"_vlo{i}") + (F.col(f"_vhi{i}") - F.col(f"_vlo{i}")) * F.col(f"_ff{i}")).alias(f"q{i}")
          for i in range(len(quantiles))],
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``count, mean, std, min, 25%, 50%, 75%, max`` per numeric column (exact).

    The input is read once: distinct values with their counts are stored
    (checkpoint), and every statistic comes from that table.  The sample
    deviation uses the two-pass form ``sum(c * (v - mean)^2) / (n - 1)``
    over the stored counts (null for a single value, like ``stddev_samp``).
    """
    from campaignlens.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    long = long_values(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    dv = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True)
    first = dv.groupBy("column_name").agg(
        F.sum("c").alias("count"),
        (F.sum(F.col("c") * F.col("value")) / F.sum("c")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row per described column: a bounded frame, broadcast.
    spread = dv.join(F.broadcast(first.select("column_name", "mean")), "column_name").groupBy("column_name").agg(
        F.sum(F.col("c") * (F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean"))).alias("_ss")
    )
    stats = first.join(spread, "column_name").select(
        "column_name", "count", "mean",
        F.sqrt(F.try_divide(F.col("_ss"), (F.col("count") - 1).cast("double"))).alias("std"),
        "min", "max",
    )
    qs = exact_quantiles_counted(dv, [0.25, 0.5, 0.75]).select(
        "column_name", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75")
    )
    return stats.join(qs, "column_name").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``count, unique, top, freq`` per text column; ties for top go to the smallest value."""
    long = long_values(df, columns).where(F.col("value").isNotNull())
    dv = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c"))
    return dv.groupBy("column_name").agg(
        F.sum("c").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("c")).alias("nc"), F.col("value").alias("v"))).alias("top"),
        F.max("c").alias("freq"),
    )


def histograms(df: DataFrame, specs: Sequence[tuple[str, int]]) -> DataFrame:
    """Equal-width histograms of several columns of one frame, all bins listed.

    Each histogram spans its column's min and max; the maximum falls in the
    last bin; a constant column is widened by 0.5 on both sides.  All
    columns are reshaped by one ``explode``, so the input is read twice (the
    ranges, then the counts) whatever the number of columns.  Output:
    ``(column_name, bin, bin_lo, bin_hi, n)``.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(int(b)).alias("bins"),
                 F.col(f"`{c}`").cast("double").alias("x"))
        for c, b in specs
    ]))
    vals = df.select(pairs.alias("_p")).select("_p.*").where(F.col("x").isNotNull() & ~F.isnan("x"))
    # One row per histogram: a bounded frame, broadcast into both uses.
    rng = F.broadcast(
        vals.groupBy("column_name")
        .agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.max("bins").alias("bins"))
        .select(
            "column_name", "bins",
            F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
            F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"),
        )
    )
    nb = F.col("bins").cast("double")
    idx = F.least(F.floor((F.col("x") - F.col("lo")) * (nb / (F.col("hi") - F.col("lo")))),
                  F.col("bins") - 1).cast("int")
    counts = vals.drop("bins").join(rng, "column_name").groupBy("column_name", idx.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spine = rng.select("column_name", "lo", "hi", "bins",
                       F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / nb
    return spine.join(counts, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def key_uniqueness(df: DataFrame, table_name: str, keys: Sequence[str]) -> DataFrame:
    """Row count vs distinct non-null key count: ``is_unique`` = 1 if equal."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("n_distinct"),
    ).select(
        F.lit(table_name).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        "n_rows",
        "n_distinct",
        (F.col("n_rows") == F.col("n_distinct")).cast("int").alias("is_unique"),
    )


def stage_parity(left: DataFrame, right: DataFrame, stage: str) -> DataFrame:
    """Shape and content comparison of two versions of one stage.

    Row and column counts, schema equality and the rows each side has that
    the other lacks (duplicates counted).
    """
    same_schema = int([(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in right.schema])
    common = [c for c in left.columns if c in set(right.columns)]
    sel = [F.col(f"`{c}`") for c in common]
    # One pass over either side: equal rows meet in one group with both counts.
    both = left.select(*sel, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*sel, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_row = both.groupBy(*sel).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return per_row.agg(
        total(F.col("_l")).alias("left_rows"),
        total(F.col("_r")).alias("right_rows"),
        total(F.greatest(F.col("_l") - F.col("_r"), F.lit(0))).alias("only_left"),
        total(F.greatest(F.col("_r") - F.col("_l"), F.lit(0))).alias("only_right"),
    ).select(
        F.lit(stage).alias("stage"),
        "left_rows",
        "right_rows",
        F.lit(len(left.columns)).alias("left_columns"),
        F.lit(len(right.columns)).alias("right_columns"),
        F.lit(same_schema).alias("same_schema"),
        "only_left",
        "only_right",
    )


# Buckets of rows that two stages are compared by.
PARITY_BUCKETS = 4096
_BUCKET = "_bucket"


def _bucketed(df: DataFrame, columns: Sequence[str], types: Sequence[T.DataType], buckets: int) -> DataFrame:
    """The common columns in common types, with a bucket and two 64-bit hashes of the row."""
    cols = [F.col(f"`{c}`").cast(t).alias(c) for c, t in zip(columns, types)]
    row = df.select(*cols)
    named = [F.col(f"`{c}`") for c in columns]
    first, second = F.xxhash64(*named), F.xxhash64(F.lit("again"), *named)
    return row.withColumns({"_h1": first, "_h2": second}).withColumn(_BUCKET, F.pmod("_h1", F.lit(buckets)))


def bucket_digests(rows: DataFrame) -> DataFrame:
    """An order-free digest per bucket: rows, and the sums of the halves of both hashes (they fit 64 bits)."""
    halves = []
    for h in ("_h1", "_h2"):
        halves += [F.sum(F.col(h).bitwiseAND(F.lit((1 << 32) - 1))), F.sum(F.shiftrightunsigned(h, 32))]
    return rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), *[s.alias(f"s{i}") for i, s in enumerate(halves)])


def differing_buckets(left: DataFrame, right: DataFrame) -> tuple[list[int], int, int]:
    """Buckets whose digests differ, and the rows of either side (the digests are one row per bucket)."""
    sides = [{r[_BUCKET]: tuple(r)[1:] for r in bucket_digests(df).collect()} for df in (left, right)]
    differ = sorted(b for b in sides[0].keys() | sides[1].keys() if sides[0].get(b) != sides[1].get(b))
    return differ, *(sum(d[0] for d in side.values()) for side in sides)


def _is_listed(differ: Sequence[int], buckets: int) -> Column:
    """Whether a row's bucket is listed: one character of a constant text per bucket, so a look costs the same for any number of them."""
    marks = bytearray(b"0" * buckets)
    for b in differ:
        marks[b] = ord("1")
    at = F.col(_BUCKET).cast("int") + 1
    return F.substring(F.lit(bytes(marks)), at, F.lit(1)) == F.lit(b"1")


def stage_parity_by_digest(left: DataFrame, right: DataFrame, stage: str, buckets: int = PARITY_BUCKETS) -> DataFrame:
    """``stage_parity`` by digests: rows are compared only in buckets whose digests differ.

    Either side is read once for its digests, which are all that is shuffled
    where the stages are equal; the rows of differing buckets are read again
    and compared one by one.
    """
    same_schema = int([(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in right.schema])
    common = [c for c in left.columns if c in set(right.columns)]
    pick = [F.col(f"`{c}`") for c in common]
    types = [f.dataType for f in left.select(*pick).unionByName(right.select(*pick)).schema.fields]
    sides = [_bucketed(df, common, types, buckets) for df in (left, right)]
    differ, n_left, n_right = differing_buckets(*sides)
    if differ:
        rest = [s.where(_is_listed(differ, buckets)).select(*pick) for s in sides] if len(differ) < buckets else [s.select(*pick) for s in sides]
        met = stage_parity(*rest, stage).select("only_left", "only_right")
    else:
        met = left.sparkSession.range(1).select(F.lit(0).cast("long").alias("only_left"), F.lit(0).cast("long").alias("only_right"))
    return met.select(
        F.lit(stage).alias("stage"),
        F.lit(n_left).cast("long").alias("left_rows"),
        F.lit(n_right).cast("long").alias("right_rows"),
        F.lit(len(left.columns)).alias("left_columns"),
        F.lit(len(right.columns)).alias("right_columns"),
        F.lit(same_schema).alias("same_schema"),
        "only_left",
        "only_right",
    )


def month_count_violations(usage_agg: DataFrame, key: str, max_months: int = 4) -> DataFrame:
    """Contracts with more billing periods than allowed."""
    return usage_agg.where(F.col("usage_month_count") > max_months).select(key, "usage_month_count")


def population_stability(
    expected: DataFrame,
    actual: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    bins: int = 10,
    eps: float = 1e-6,
) -> DataFrame:
    """PSI per feature between two samples (see ``population_stability_by``)."""
    both = expected.select(*numeric, *categorical, F.lit("e").alias("_side")).unionByName(
        actual.select(*numeric, *categorical, F.lit("a").alias("_side"))
    )
    return population_stability_by(both, F.col("_side") == "a", numeric, categorical, bins, eps)


def population_stability_by(
    df: DataFrame,
    is_actual: Column,
    numeric: Sequence[str],
    categorical: Sequence[str],
    bins: int = 10,
    eps: float = 1e-6,
) -> DataFrame:
    """PSI per feature: sum over bins of ``(a - e) * ln(a / e)`` on shares.

    One frame holds both samples; ``is_actual`` tells the rows of the
    actual sample (true) from the expected one (false; null counts as
    expected).  Numeric features use equal-width bins over the range of
    both samples; categorical features use their values.  Shares are
    floored at ``eps``.  All features are reshaped by one ``explode``; the
    input is read twice (the numeric ranges, then the bins).
    """
    side = F.when(F.coalesce(is_actual, F.lit(False)), F.lit("a")).otherwise(F.lit("e"))
    numeric, categorical = list(numeric), list(categorical)
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("x"),
                 F.lit(None).cast("string").alias("s"))
        for c in numeric
    ] + [
        F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("double").alias("x"),
                 F.col(f"`{c}`").cast("string").alias("s"))
        for c in categorical
    ]
    long = (
        df.select(F.explode(F.array(*pairs)).alias("_p"), side.alias("_side"))
        .select("_p.*", "_side")
        .where(F.col("s").isNotNull() | (F.col("x").isNotNull() & ~F.isnan("x")))
    )
    rng = long.where(F.col("x").isNotNull()).groupBy("column_name").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi")
    )
    numeric_bucket = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))),
                F.lit(bins - 1))
    ).cast("string")
    bucket = F.when(F.col("x").isNotNull(), numeric_bucket).otherwise(F.col("s"))
    # One row per numeric feature: a bounded frame, broadcast.
    binned = long.join(F.broadcast(rng), "column_name", "left").select("column_name", bucket.alias("bucket"), "_side")
    counts = binned.groupBy("column_name", "bucket").agg(
        F.count_if(F.col("_side") == "e").alias("ne"), F.count_if(F.col("_side") == "a").alias("na")
    )
    # One row per feature: a bounded frame, broadcast.
    totals = F.broadcast(counts.groupBy("column_name").agg(F.sum("ne").alias("te"), F.sum("na").alias("ta")))
    shares = counts.join(totals, "column_name").select(
        "column_name",
        F.greatest(F.try_divide(F.col("ne").cast("double"), F.col("te")), F.lit(eps)).alias("pe"),
        F.greatest(F.try_divide(F.col("na").cast("double"), F.col("ta")), F.lit(eps)).alias("pa"),
    )
    return shares.groupBy(F.col("column_name").alias("feature")).agg(
        F.sum((F.col("pa") - F.col("pe")) * F.log(F.col("pa") / F.col("pe"))).alias("psi")
    )


def distribution_distances(df: DataFrame, is_actual: Column, numeric: Sequence[str]) -> DataFrame:
    """Kolmogorov-Smirnov and Wasserstein distance per numeric column between two samples of one frame.

    ``is_actual`` tells the rows of the actual sample from the expected one
    (null counts as expected); missing values and NaN are left out.  Distinct
    values are counted per side in one pass, and both empirical distribution
    functions come from one prefix sum over the merged values: the first
    distance is their largest gap, the second the area between them.  Output:
    ``(feature, n_expected, n_actual, ks, wasserstein)``; the distances are
    null where a side has no value.
    """
    side = F.coalesce(is_actual, F.lit(False)).cast("int")
    long = long_values(df.withColumn("_side", side), numeric, "double", extra=["_side"])
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = long.groupBy("column_name", "value").agg(
        F.sum(F.lit(1) - F.col("_side")).alias("ne"), F.sum("_side").cast("long").alias("na")
    )
    order = [F.col("column_name").asc(), F.col("value").asc()]
    curve = with_prefix_sums(counts, order, ["ne", "na"], previous=["value"], within=["column_name"])
    totals = curve.groupBy("column_name").agg(F.sum("ne").alias("te"), F.sum("na").alias("ta"))
    before = Window.orderBy("column_name").rowsBetween(Window.unboundedPreceding, -1)
    # One row per profiled column: bounded by the column count, broadcast.
    lead = F.broadcast(totals.select(
        "column_name", "te", "ta",
        F.coalesce(F.sum("te").over(before), F.lit(0)).alias("oe"), F.coalesce(F.sum("ta").over(before), F.lit(0)).alias("oa"),
    ))

    def gap(e: Column, a: Column) -> Column:
        return F.abs(F.try_divide(e.cast("double"), F.col("te")) - F.try_divide(a.cast("double"), F.col("ta")))

    e, a = F.col("cum_ne") - F.col("oe"), F.col("cum_na") - F.col("oa")
    stepped = curve.join(lead, "column_name").select(
        "column_name", "te", "ta", gap(e, a).alias("here"),
        (gap(e - F.col("ne"), a - F.col("na")) * (F.col("value") - F.col("prev_value"))).alias("area"),
    )
    some = (F.col("te") > 0) & (F.col("ta") > 0)
    return stepped.groupBy(F.col("column_name").alias("feature"), "te", "ta").agg(
        F.max("here").alias("ks"), F.coalesce(F.sum("area"), F.lit(0.0)).alias("wasserstein")
    ).select(
        "feature", F.col("te").alias("n_expected"), F.col("ta").alias("n_actual"), "ks",
        F.when(some, F.col("wasserstein")).alias("wasserstein"),
    )
