"""Registered queries: profiling, data checks, label history, id-level sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators import clean, features, joins, labels, profile, split
from campaignlens.plans import flow
from campaignlens.plans.eval_queries import GROUP_SQL, eval_sql
from campaignlens.plans.oracle_views import ONE_HOT_SQL, PROCESSED_CORE_SQL, with_views
from campaignlens.plans.registry import register, round_doubles, sql_round
from campaignlens.sources.sinks import stage_roundtrip

MERGED_COLUMNS = (
    [f.name for f in S.CORE_SCHEMA.fields]
    + ["available_gb_missing", "is_premium_device"]
    + clean.BUCKET_COLUMNS
    + clean.one_hot_names()
    + S.USAGE_OUTPUT[1:]
    + S.INTERACTION_FEATURES
)
MERGED_DOUBLES = {
    "available_gb", "gross_mrc", "total_used_gb", "avg_used_gb", "std_used_gb", "min_used_gb",
    "max_used_gb", "roaming_ratio", "usage_trend",
}
DESCRIBE_NUMERIC = [
    "age", "contract_lifetime_days", "remaining_binding_days", "gross_mrc", "available_gb",
    "total_used_gb", "avg_used_gb", "std_used_gb", "usage_month_count", "roaming_ratio", "usage_trend",
    "num_interactions", "recency",
]
DESCRIBE_TEXT = ["customer_id", "smartphone_brand", "remaining_binding_days_bucket", "mrc_bucket",
                 "contract_term_bucket", "age_bucket"]
PSI_NUMERIC = ["age", "gross_mrc", "contract_lifetime_days", "remaining_binding_days"]
PSI_CATEGORICAL = ["smartphone_brand", "mrc_bucket"]


def _q(c: str) -> str:
    return '"' + c + '"'


def _long_sql(source: str, columns: list[str], extra: str = "", where: str = "") -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST({_q(c)} AS VARCHAR) AS value{extra} FROM {source}{where}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


# -- missing values, value counts, crosstab ---------------------------------------------

_NULL_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_q(c)} IS NULL"
    + (f" OR isnan({_q(c)})" if c in MERGED_DOUBLES else "")
    + f") AS null_count, count(*) FILTER (WHERE {_q(c)} IS NULL"
    + (f" OR isnan({_q(c)})" if c in MERGED_DOUBLES else "")
    + ") / count(*) AS null_share FROM merged"
    for c in MERGED_COLUMNS
)


@register("null_profile", sql=sql_round(with_views(_NULL_SQL), ["null_share"]))
def null_profile(spark, sf_dir):
    return round_doubles(profile.null_profile(flow.merged(spark, sf_dir)))


def _vc_sql(where: str = "") -> str:
    long = _long_sql("processed_core", S.PROFILE_COLUMNS, where=where)
    return sql_round(
        with_views(
            f"SELECT column_name, value, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY column_name) "
            f"AS share FROM ({long}) WHERE value IS NOT NULL GROUP BY column_name, value"
        ),
        ["share"],
    )


@register("value_counts", sql=_vc_sql())
def value_counts(spark, sf_dir):
    return round_doubles(profile.value_counts(flow.processed_core(spark, sf_dir), S.PROFILE_COLUMNS))


@register("positive_distribution", sql=_vc_sql(" WHERE has_done_upselling = 1"))
def positive_distribution(spark, sf_dir):
    pc = flow.processed_core(spark, sf_dir).where(F.col(S.LABEL) == 1)
    return round_doubles(profile.value_counts(pc, S.PROFILE_COLUMNS))


@register(
    "crosstab_label_rate",
    sql=sql_round(
        with_views(
            "SELECT column_name AS feature, value, avg(CAST(has_done_upselling = 0 AS DOUBLE)) AS share_0, "
            "avg(CAST(has_done_upselling = 1 AS DOUBLE)) AS share_1 FROM ("
            + _long_sql("processed_core", S.CROSSTAB_FEATURES, extra=", has_done_upselling")
            + ") WHERE value IS NOT NULL AND has_done_upselling IS NOT NULL GROUP BY column_name, value"
        ),
        ["share_0", "share_1"],
    ),
)
def crosstab_label_rate(spark, sf_dir):
    return round_doubles(profile.crosstab_label_rate(flow.processed_core(spark, sf_dir, impute=False), S.CROSSTAB_FEATURES, S.LABEL))


# -- describe ----------------------------------------------------------------------------

_DESC_NUM_SQL = (
    "SELECT column_name, count(*) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, "
    "quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, "
    "max(value) AS max FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({_q(c)} AS DOUBLE) AS value FROM merged_filled" for c in DESCRIBE_NUMERIC
    )
    + ") WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY column_name"
)


@register(
    "describe_numeric",
    sql=sql_round(with_views(_DESC_NUM_SQL), ["mean", "std", "min", "p25", "p50", "p75", "max"]),
)
def describe_numeric(spark, sf_dir):
    return round_doubles(profile.describe_numeric(flow.merged(spark, sf_dir, fill=True), DESCRIBE_NUMERIC))


@register(
    "describe_text",
    sql=with_views(
        "SELECT column_name, sum(c) AS count, count(*) AS unique, "
        "arg_min(value, struct_pack(nc := -c, v := value)) AS top, max(c) AS freq FROM ("
        "SELECT column_name, value, count(*) AS c FROM ("
        + _long_sql("processed_core", DESCRIBE_TEXT)
        + ") WHERE value IS NOT NULL GROUP BY column_name, value) GROUP BY column_name"
    ).replace("SELECT column_name, sum(c) AS count", "SELECT column_name, CAST(sum(c) AS BIGINT) AS count"),
)
def describe_text(spark, sf_dir):
    return profile.describe_text(flow.processed_core(spark, sf_dir, impute=False), DESCRIBE_TEXT)


# -- histograms --------------------------------------------------------------------------

_HIST_SOURCES = {"core": "core_data", "usage": "usage_features", "interactions": "interaction_features"}


def _hist_sql(view: str, column: str, bins: int) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""
SELECT '{column}' AS column_name, CAST(b.bin AS INTEGER) AS bin, r.lo + b.bin * ((r.hi - r.lo) / CAST({bins} AS DOUBLE)) AS bin_lo,
  r.lo + (b.bin + 1) * ((r.hi - r.lo) / CAST({bins} AS DOUBLE)) AS bin_hi, coalesce(c.n, 0) AS n
FROM (SELECT CASE WHEN min({x}) = max({x}) THEN min({x}) - 0.5 ELSE min({x}) END AS lo,
             CASE WHEN min({x}) = max({x}) THEN max({x}) + 0.5 ELSE max({x}) END AS hi
      FROM {view} WHERE {column} IS NOT NULL) r
CROSS JOIN (SELECT unnest(range(0, {bins})) AS bin) b
LEFT JOIN (
  SELECT CAST(least(floor(({x} - r2.lo) * (CAST({bins} AS DOUBLE) / (r2.hi - r2.lo))), {bins - 1}) AS INTEGER) AS bin,
         count(*) AS n
  FROM {view}, (SELECT CASE WHEN min({x}) = max({x}) THEN min({x}) - 0.5 ELSE min({x}) END AS lo,
                       CASE WHEN min({x}) = max({x}) THEN max({x}) + 0.5 ELSE max({x}) END AS hi
                FROM {view} WHERE {column} IS NOT NULL) r2
  WHERE {column} IS NOT NULL GROUP BY 1) c ON c.bin = b.bin"""


@register(
    "histogram",
    sql=sql_round(
        with_views(" UNION ALL ".join(_hist_sql(_HIST_SOURCES[s], c, b) for s, c, b in S.HISTOGRAMS)),
        ["bin_lo", "bin_hi"],
    ),
)
def histogram(spark, sf_dir):
    src = {
        "core": lambda: flow.inputs(spark, sf_dir).core,
        "usage": lambda: flow.usage_features(spark, sf_dir),
        "interactions": lambda: flow.interaction_features(spark, sf_dir),
    }
    # One multi-column histogram per source frame (each source read twice).
    out = None
    for source in dict.fromkeys(s for s, _, _ in S.HISTOGRAMS):
        h = profile.histograms(src[source](), [(c, b) for s, c, b in S.HISTOGRAMS if s == source])
        out = h if out is None else out.unionByName(h)
    return round_doubles(out)


# -- keys, parity, month rule -------------------------------------------------------------

_KEY_SPECS = [
    ("core_data", [S.KEY]),
    ("core_data", [S.CUSTOMER]),
    ("usage_info", [S.KEY, "billed_period_month_d"]),
    ("customer_interactions", [S.CUSTOMER, "type_subtype"]),
]


def _key_sql(table: str, keys: list[str]) -> str:
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns, (SELECT count(*) FROM {table}) AS n_rows, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {table} WHERE {nn})) AS n_distinct"
    )


@register(
    "key_uniqueness",
    sql=with_views(
        "SELECT *, CAST(n_rows = n_distinct AS INTEGER) AS is_unique FROM ("
        + " UNION ALL ".join(_key_sql(t, k) for t, k in _KEY_SPECS)
        + ")"
    ),
)
def key_uniqueness(spark, sf_dir):
    ins = flow.inputs(spark, sf_dir)
    tables = {"core_data": ins.core, "usage_info": ins.usage, "customer_interactions": ins.interactions}
    out = None
    for t, k in _KEY_SPECS:
        part = profile.key_uniqueness(tables[t], t, k)
        out = part if out is None else out.unionByName(part)
    return out


_PARITY_SQL = with_views(
    "SELECT 'processed_core' AS stage, (SELECT count(*) FROM processed_core) AS left_rows, "
    "(SELECT count(*) FROM processed_core_nb) AS right_rows, 33 AS left_columns, 33 AS right_columns, "
    "1 AS same_schema, "
    "(SELECT count(*) FROM (SELECT * FROM processed_core EXCEPT ALL SELECT * FROM processed_core_nb)) AS only_left, "
    "(SELECT count(*) FROM (SELECT * FROM processed_core_nb EXCEPT ALL SELECT * FROM processed_core)) AS only_right",
    extra=[
        ("pc_buckets_nb", PROCESSED_CORE_SQL.format(a1=46, a2=61)),
        ("processed_core_nb", ONE_HOT_SQL.replace("FROM pc_buckets", "FROM pc_buckets_nb")),
    ],
)


@register("stage_parity", sql=_PARITY_SQL)
def stage_parity(spark, sf_dir):
    """The stored stage (written and read back) against the notebook's recomputation."""
    stored = stage_roundtrip(flow.processed_core(spark, sf_dir), "processed_core")
    notebook = flow.processed_core(spark, sf_dir, age_edges=S.AGE_EDGES_NOTEBOOK)
    return profile.stage_parity(stored, notebook, "processed_core")


_EQUAL_PARITY = (
    "SELECT 'core' AS stage, (SELECT count(*) FROM core_data) AS left_rows, (SELECT count(*) FROM core_data) AS right_rows, "
    "11 AS left_columns, 11 AS right_columns, 1 AS same_schema, 0 AS only_left, 0 AS only_right"
)


@register("stage_parity_digests", sql=f"{_PARITY_SQL}\nUNION ALL SELECT * FROM ({with_views(_EQUAL_PARITY)})")
def stage_parity_digests(spark, sf_dir):
    """Parity by bucket digests: a stage against another version of it, and a stored table against its source."""
    stored = stage_roundtrip(flow.processed_core(spark, sf_dir), "processed_core")
    notebook = flow.processed_core(spark, sf_dir, age_edges=S.AGE_EDGES_NOTEBOOK)
    core = flow.inputs(spark, sf_dir).core
    equal = profile.stage_parity_by_digest(stage_roundtrip(core, "core"), core, "core")
    return profile.stage_parity_by_digest(stored, notebook, "processed_core").unionByName(equal)


@register(
    "month_count_check",
    sql=with_views("SELECT rating_account_id, usage_month_count FROM usage_features WHERE usage_month_count > 4"),
)
def month_count_check(spark, sf_dir):
    return profile.month_count_violations(flow.usage_features(spark, sf_dir), S.KEY)


# -- drift ----------------------------------------------------------------------------------

def _psi_sql() -> str:
    num = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, side FROM pcf" for c in PSI_NUMERIC
    )
    cat = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, side FROM pcf" for c in PSI_CATEGORICAL
    )
    return f"""
SELECT column_name AS feature, sum((pa - pe) * ln(pa / pe)) AS psi FROM (
  SELECT column_name, greatest(coalesce(ne / nullif(te, 0), 0.0), 1e-6) AS pe,
         greatest(coalesce(na / nullif(ta, 0), 0.0), 1e-6) AS pa
  FROM (
    SELECT column_name, bucket, count(*) FILTER (WHERE side = 'e') AS ne, count(*) FILTER (WHERE side = 'a') AS na,
      sum(count(*) FILTER (WHERE side = 'e')) OVER (PARTITION BY column_name) AS te,
      sum(count(*) FILTER (WHERE side = 'a')) OVER (PARTITION BY column_name) AS ta
    FROM (
      SELECT n.column_name, CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE
          least(floor((n.value - r.lo) * (CAST(10 AS DOUBLE) / (r.hi - r.lo))), 9) END AS BIGINT)::VARCHAR AS bucket, n.side
      FROM (SELECT * FROM ({num}) WHERE value IS NOT NULL AND NOT isnan(value)) n
      JOIN (SELECT column_name, min(value) AS lo, max(value) AS hi FROM ({num})
            WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY column_name) r USING (column_name)
      UNION ALL
      SELECT column_name, value AS bucket, side FROM ({cat}) WHERE value IS NOT NULL
    ) GROUP BY column_name, bucket
  )
) GROUP BY column_name"""


_PSI_CTES_BODY = _psi_sql()


@register(
    "drift_psi",
    sql=eval_sql(
        _PSI_CTES_BODY.replace(
            "FROM pcf",
            "FROM (SELECT p.*, CASE WHEN f.fold = 0 THEN 'a' ELSE 'e' END AS side FROM processed_core p "
            f"LEFT JOIN folds f ON {GROUP_SQL.replace('customer_id', 'p.customer_id')} = f.grp)",
        ),
        ["psi"],
    ),
)
def drift_psi(spark, sf_dir):
    pcf = split.attach_folds(flow.processed_core(spark, sf_dir, impute=False), flow.folds(spark, sf_dir))
    return round_doubles(
        profile.population_stability_by(pcf, F.col("fold") == 0, PSI_NUMERIC, PSI_CATEGORICAL)
    )


_DISTANCE_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, side FROM pcf" for c in PSI_NUMERIC
)
_DISTANCE_SQL = f"""
SELECT feature, CAST(max(te) AS BIGINT) AS n_expected, CAST(max(ta) AS BIGINT) AS n_actual, max(abs(e / te - a / ta)) AS ks,
  coalesce(sum(abs(e / te - a / ta) * (following - v)), 0.0) AS wasserstein
FROM (
  SELECT feature, v, lead(v) OVER w AS following, CAST(sum(ne) OVER w AS DOUBLE) AS e, CAST(sum(na) OVER w AS DOUBLE) AS a,
    sum(ne) OVER (PARTITION BY feature) AS te, sum(na) OVER (PARTITION BY feature) AS ta
  FROM (SELECT feature, v, count(*) FILTER (WHERE side = 'e') AS ne, count(*) FILTER (WHERE side = 'a') AS na
        FROM ({_DISTANCE_LONG}) WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY feature, v)
  WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)
) GROUP BY feature"""


@register(
    "drift_distances",
    sql=eval_sql(
        _DISTANCE_SQL.replace(
            "FROM pcf",
            "FROM (SELECT p.*, CASE WHEN f.fold = 0 THEN 'a' ELSE 'e' END AS side FROM processed_core p "
            f"LEFT JOIN folds f ON {GROUP_SQL.replace('customer_id', 'p.customer_id')} = f.grp)",
        ),
        ["ks", "wasserstein"],
    ),
)
def drift_distances(spark, sf_dir):
    """Drift without bins: the test fold against the training folds."""
    pcf = split.attach_folds(flow.processed_core(spark, sf_dir, impute=False), flow.folds(spark, sf_dir))
    return round_doubles(profile.distribution_distances(pcf, F.col("fold") == 0, PSI_NUMERIC))


# -- label history ---------------------------------------------------------------------------

_LAG_SQL = (
    "SELECT rating_account_id, customer_id, contract_lifetime_days, has_done_upselling, "
    "lag(has_done_upselling) OVER (PARTITION BY customer_id ORDER BY contract_lifetime_days NULLS LAST, "
    "rating_account_id) AS prev_label FROM core_data WHERE customer_id IS NOT NULL"
)
_TRANSITIONS_SQL = (
    "SELECT customer_id, CAST(bool_or(coalesce(prev_label = 0 AND has_done_upselling = 1, false)) AS INTEGER) "
    f"AS has_transition_0_to_1 FROM ({_LAG_SQL}) GROUP BY customer_id"
)
_CONTRACT_COLS = ", ".join("c." + c for c in labels.CONTRACT_VIEW)


@register("label_transitions", sql=with_views(_TRANSITIONS_SQL))
def label_transitions(spark, sf_dir):
    return labels.customer_transitions(flow.inputs(spark, sf_dir).core)


@register(
    "label_shift",
    sql=with_views(
        "SELECT *, CAST(coalesce(prev_label = 0 AND has_done_upselling = 1, false) AS INTEGER) AS transition_0_to_1 "
        f"FROM ({_LAG_SQL})"
    ),
)
def label_shift(spark, sf_dir):
    return labels.label_shift(flow.inputs(spark, sf_dir).core)


@register(
    "transition_contracts",
    sql=with_views(
        f"SELECT t.has_transition_0_to_1, {_CONTRACT_COLS} FROM ({_TRANSITIONS_SQL}) t "
        "RIGHT JOIN core_data c ON t.customer_id = c.customer_id"
    ),
)
def transition_contracts(spark, sf_dir):
    return labels.transition_contracts(flow.inputs(spark, sf_dir).core)


@register(
    "transition_members",
    sql=with_views(
        f"SELECT {_CONTRACT_COLS} FROM core_data c WHERE c.customer_id IN "
        f"(SELECT customer_id FROM ({_TRANSITIONS_SQL}) WHERE has_transition_0_to_1 = 1)"
    ),
)
def transition_members(spark, sf_dir):
    return labels.transition_members(flow.inputs(spark, sf_dir).core)


# -- id-level sets ------------------------------------------------------------------------------

@register(
    "distinct_customers",
    sql=with_views("SELECT DISTINCT customer_id FROM core_data WHERE customer_id IS NOT NULL"),
)
def distinct_customers(spark, sf_dir):
    return split.distinct_values(flow.inputs(spark, sf_dir).core, S.CUSTOMER)


@register(
    "sample_customers",
    sql=with_views(
        "SELECT customer_id FROM (SELECT customer_id, row_number() OVER (ORDER BY md5('42:' || customer_id), "
        "customer_id) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT customer_id FROM core_data "
        "WHERE customer_id IS NOT NULL)) WHERE rn <= floor(n * CAST(0.5 AS DOUBLE))"
    ),
)
def sample_customers(spark, sf_dir):
    return split.sample_exact(flow.inputs(spark, sf_dir).core, S.CUSTOMER, 0.5, S.SPLIT_SEED)


@register(
    "repeat_rows",
    sql=with_views(
        "SELECT i.customer_id, i.type_subtype, i.n, i.days_since_last, CAST(g.copy_no AS BIGINT) AS copy_no "
        "FROM customer_interactions i, LATERAL (SELECT unnest(range(1, i.n + 1)) AS copy_no) g WHERE i.n >= 1"
    ),
)
def repeat_rows(spark, sf_dir):
    return split.repeat_rows(flow.inputs(spark, sf_dir).interactions, "n")


@register(
    "account_month_spine",
    sql=with_views(
        "SELECT rating_account_id, CAST(unnest(generate_series(DATE '2024-04-01', DATE '2024-07-01', "
        "INTERVAL 1 MONTH)) AS DATE) AS billed_period_month_d FROM (SELECT DISTINCT rating_account_id "
        "FROM core_data WHERE rating_account_id IS NOT NULL)"
    ),
)
def account_month_spine(spark, sf_dir):
    return split.month_spine(flow.inputs(spark, sf_dir).core, S.KEY, "2024-04-01", "2024-07-01")


# -- domains, schema, split outputs, salted join --------------------------------------------


@register(
    "category_levels",
    sql=with_views(
        "SELECT level, row_number() OVER (ORDER BY level) AS position FROM "
        "(SELECT DISTINCT smartphone_brand AS level FROM core_data WHERE smartphone_brand IS NOT NULL)"
    ),
)
def category_levels(spark, sf_dir):
    """The brand domain in code-point order."""
    return clean.category_levels(flow.inputs(spark, sf_dir).core, "smartphone_brand")


def _summary_sql() -> str:
    parts = [
        f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS dtype, "
        f"count({f.name}) AS non_null, count(*) AS n_rows FROM core_data"
        for f in S.CORE_SCHEMA.fields
    ]
    return with_views(" UNION ALL ".join(parts))


@register("schema_summary", sql=_summary_sql())
def schema_summary(spark, sf_dir):
    """Type and non-missing count of every contract column."""
    return profile.schema_summary(flow.inputs(spark, sf_dir).core)


_SPLIT_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS output, count(*) AS n_rows, "
    f"{'count(has_done_upselling)' if name.startswith('y') else 'NULL::BIGINT'} AS n_labels "
    f"FROM scored_all WHERE fold {op} 0"
    for name, op in (("X_train", "<>"), ("X_test", "="), ("y_train", "<>"), ("y_test", "="))
)


@register("split_outputs", sql=eval_sql(_SPLIT_SQL))
def split_outputs(spark, sf_dir):
    """Rows and labels in each of the four outputs of the split."""
    out = None
    for name, part in split.train_test(flow.contract_folds(spark, sf_dir)).items():
        labels_in = F.count(S.LABEL) if S.LABEL in part.columns else F.lit(None).cast("long")
        row = part.agg(F.count(F.lit(1)).alias("n_rows"), labels_in.alias("n_labels"))
        row = row.select(F.lit(name).alias("output"), "n_rows", "n_labels")
        out = row if out is None else out.unionByName(row)
    return out


def brand_rates(core):
    """Contracts and positives of every brand (one row per brand)."""
    return core.where(F.col("smartphone_brand").isNotNull()).groupBy("smartphone_brand").agg(
        F.count(F.lit(1)).alias("brand_rows"), F.coalesce(F.sum(S.LABEL), F.lit(0)).cast("long").alias("brand_positives")
    )


@register(
    "brand_rate_join",
    sql=with_views(
        "SELECT c.rating_account_id, c.smartphone_brand, b.brand_rows, b.brand_positives FROM core_data c LEFT JOIN ("
        "SELECT smartphone_brand, count(*) AS brand_rows, CAST(coalesce(sum(has_done_upselling), 0) AS BIGINT) "
        "AS brand_positives FROM core_data GROUP BY 1) b ON c.smartphone_brand = b.smartphone_brand"
    ),
)
def brand_rate_join(spark, sf_dir):
    """Every contract with its brand's counts: five keys hold all rows, so every key is salted."""
    core = flow.inputs(spark, sf_dir).core
    rates = brand_rates(core)
    hot = joins.hot_keys_from_counts(rates, "smartphone_brand", "brand_rows")
    return joins.hot_key_left_join(core.select(S.KEY, "smartphone_brand"), rates, "smartphone_brand", hot=hot).select(
        S.KEY, "smartphone_brand", "brand_rows", "brand_positives"
    )
