"""DuckDB text of the three input views over the test tables.

The independent engine derives the inputs from the same Parquet tables as
``campaignlens.sources.tables`` does on Spark; every oracle query starts
with these common table expressions.
"""

from __future__ import annotations

CORE_SQL = """
SELECT o_orderkey AS rating_account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CAST(18 + o_orderkey % 83 AS INTEGER) AS age,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS contract_lifetime_days,
  CAST((o_orderkey * 37) % 2103 - 1051 AS INTEGER) AS remaining_binding_days,
  CAST(o_orderkey % 10 < 3 AS INTEGER) AS has_special_offer,
  CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS is_magenta1_customer,
  CASE WHEN o_orderkey % 7 = 6 THEN NULL WHEN o_orderkey % 101 = 0 THEN 'n/a'
       ELSE CAST((o_orderkey % 7) * 10 AS VARCHAR) END AS available_gb,
  CAST(5 + CAST(floor(o_totalprice) AS BIGINT) % 66 AS DOUBLE) AS gross_mrc,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'iPhone' WHEN '2-HIGH' THEN 'Samsung'
       WHEN '3-MEDIUM' THEN 'Huawei' WHEN '4-NOT SPECIFIED' THEN 'Xiaomi'
       ELSE 'OnePlus' END AS smartphone_brand,
  CAST(o_orderstatus = 'P' AND o_orderkey % 5 = 0 AS INTEGER) AS has_done_upselling
FROM orders JOIN customer ON o_custkey = c_custkey
"""

USAGE_SQL = """
SELECT l_orderkey AS rating_account_id, l_shipdate AS billed_period_month_d,
  CAST(l_returnflag = 'R' AS INTEGER) AS has_used_roaming, l_quantity AS used_gb,
  l_partkey AS tie_1, l_suppkey AS tie_2, l_linenumber AS tie_3
FROM lineitem
"""

INTERACTIONS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS customer_id,
  CASE event_type WHEN 'click' THEN 'produkte&services-tarifdetails'
       WHEN 'view' THEN 'produkte&services-Tarifwechsel'
       WHEN 'purchase' THEN 'prolongation' WHEN 'error' THEN 'rechnungsanfragen'
       ELSE NULL END AS type_subtype,
  count(*) AS n,
  CAST(min(date_diff('day', CAST(ts AS DATE), DATE '2024-01-31')) AS INTEGER) AS days_since_last
FROM events GROUP BY 1, 2
"""

# Cleaned contracts, the same steps as operators.clean.process_core.
PROCESSED_CORE_SQL = """
SELECT c.* EXCLUDE (available_gb, gb),
  coalesce(gb, (SELECT median(gb) FROM core_gb)) AS available_gb,
  CAST(gb IS NULL AS INTEGER) AS available_gb_missing,
  CAST(coalesce(smartphone_brand IN ('iPhone', 'Samsung'), false) AS INTEGER) AS is_premium_device,
  CASE WHEN remaining_binding_days > -1000 AND remaining_binding_days <= -1 THEN 'Expired'
       WHEN remaining_binding_days > -1 AND remaining_binding_days <= 30 THEN '0-30'
       WHEN remaining_binding_days > 30 AND remaining_binding_days <= 90 THEN '31-90'
       WHEN remaining_binding_days > 90 AND remaining_binding_days <= 180 THEN '91-180'
       WHEN remaining_binding_days > 180 AND remaining_binding_days <= 1000 THEN '>180' END
    AS remaining_binding_days_bucket,
  CASE WHEN gross_mrc > 0 AND gross_mrc <= 30 THEN 'Low (<30€)'
       WHEN gross_mrc > 30 AND gross_mrc <= 50 THEN 'Mid (30-50€)'
       WHEN gross_mrc > 50 AND gross_mrc <= 70 THEN 'High (>50€)' END AS mrc_bucket,
  CASE WHEN contract_lifetime_days > 0 AND contract_lifetime_days <= 365 THEN '<1y'
       WHEN contract_lifetime_days > 365 AND contract_lifetime_days <= 730 THEN '1-2y'
       WHEN contract_lifetime_days > 730 AND contract_lifetime_days <= 1095 THEN '2-3y'
       WHEN contract_lifetime_days > 1095 AND contract_lifetime_days <= 1825 THEN '3-5y' END
    AS contract_term_bucket,
  CASE WHEN age > 0 AND age <= 25 THEN '<25' WHEN age > 25 AND age <= {a1} THEN '25-45'
       WHEN age > {a1} AND age <= {a2} THEN '46-60' WHEN age > {a2} AND age <= 100 THEN '>60' END
    AS age_bucket
FROM core_gb c
"""

ONE_HOT_SQL = """
SELECT *,
  CAST(coalesce(remaining_binding_days_bucket = '0-30', false) AS INTEGER) AS "remaining_binding_days_bucket_0-30",
  CAST(coalesce(remaining_binding_days_bucket = '31-90', false) AS INTEGER) AS "remaining_binding_days_bucket_31-90",
  CAST(coalesce(remaining_binding_days_bucket = '91-180', false) AS INTEGER) AS "remaining_binding_days_bucket_91-180",
  CAST(coalesce(remaining_binding_days_bucket = '>180', false) AS INTEGER) AS "remaining_binding_days_bucket_>180",
  CAST(coalesce(mrc_bucket = 'Mid (30-50€)', false) AS INTEGER) AS "mrc_bucket_Mid (30-50€)",
  CAST(coalesce(mrc_bucket = 'High (>50€)', false) AS INTEGER) AS "mrc_bucket_High (>50€)",
  CAST(coalesce(contract_term_bucket = '1-2y', false) AS INTEGER) AS "contract_term_bucket_1-2y",
  CAST(coalesce(contract_term_bucket = '2-3y', false) AS INTEGER) AS "contract_term_bucket_2-3y",
  CAST(coalesce(contract_term_bucket = '3-5y', false) AS INTEGER) AS "contract_term_bucket_3-5y",
  CAST(coalesce(age_bucket = '25-45', false) AS INTEGER) AS "age_bucket_25-45",
  CAST(coalesce(age_bucket = '46-60', false) AS INTEGER) AS "age_bucket_46-60",
  CAST(coalesce(age_bucket = '>60', false) AS INTEGER) AS "age_bucket_>60",
  CAST(coalesce(smartphone_brand = 'OnePlus', false) AS INTEGER) AS "smartphone_brand_OnePlus",
  CAST(coalesce(smartphone_brand = 'Samsung', false) AS INTEGER) AS "smartphone_brand_Samsung",
  CAST(coalesce(smartphone_brand = 'Xiaomi', false) AS INTEGER) AS "smartphone_brand_Xiaomi",
  CAST(coalesce(smartphone_brand = 'iPhone', false) AS INTEGER) AS "smartphone_brand_iPhone"
FROM pc_buckets
"""

USAGE_AGG_SQL = """
SELECT rating_account_id,
  coalesce(sum(used_gb), 0.0) AS total_used_gb,
  avg(used_gb) AS avg_used_gb,
  stddev_samp(used_gb) AS std_used_gb,
  min(used_gb) AS min_used_gb,
  max(used_gb) AS max_used_gb,
  CAST(count(CAST(billed_period_month_d AS DATE)) AS BIGINT) AS usage_month_count,
  CAST(coalesce(sum(has_used_roaming), 0) AS BIGINT) AS roaming_months,
  arg_min(used_gb, struct_pack(n := billed_period_month_d IS NULL, m := CAST(billed_period_month_d AS DATE),
          t1 := tie_1, t2 := tie_2, t3 := tie_3)) FILTER (WHERE used_gb IS NOT NULL) AS first_used_gb,
  arg_max(used_gb, struct_pack(n := billed_period_month_d IS NULL, m := CAST(billed_period_month_d AS DATE),
          t1 := tie_1, t2 := tie_2, t3 := tie_3)) FILTER (WHERE used_gb IS NOT NULL) AS last_used_gb
FROM usage_info WHERE rating_account_id IS NOT NULL GROUP BY rating_account_id
"""

USAGE_FEATURES_SQL = """
SELECT rating_account_id, total_used_gb, avg_used_gb, std_used_gb, min_used_gb, max_used_gb,
  usage_month_count, roaming_months,
  CASE WHEN usage_month_count <> 0 THEN CAST(roaming_months AS DOUBLE) / usage_month_count
       WHEN roaming_months > 0 THEN 'inf'::DOUBLE ELSE 0.0 END AS roaming_ratio,
  CAST(roaming_months > 0 AS INTEGER) AS had_roaming,
  CAST(coalesce(last_used_gb > first_used_gb, false) AS INTEGER) AS usage_increase,
  last_used_gb - first_used_gb AS usage_trend
FROM usage_agg
"""

INTERACTION_FEATURES_SQL = """
SELECT customer_id,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS num_interactions,
  CAST(count(DISTINCT type_subtype) AS BIGINT) AS num_unique_interactions,
  CAST(coalesce(min(days_since_last), 0) AS BIGINT) AS recency,
  CAST(coalesce(sum(n) FILTER (WHERE regexp_matches(type_subtype, 'prolongation', 'i')), 0) AS BIGINT) AS interact_prolongations,
  CAST(coalesce(sum(n) FILTER (WHERE regexp_matches(type_subtype, 'tarifdetails', 'i')), 0) AS BIGINT) AS interact_tarifdetails,
  CAST(coalesce(sum(n) FILTER (WHERE regexp_matches(type_subtype, 'tarifwechsel', 'i')), 0) AS BIGINT) AS interact_tarifwechsel,
  CAST(coalesce(sum(n) FILTER (WHERE regexp_matches(type_subtype, 'rechnungsanfragen', 'i')), 0) AS BIGINT) AS interact_rechnungsanfragen
FROM customer_interactions WHERE customer_id IS NOT NULL GROUP BY customer_id
"""

MERGED_SQL = """
SELECT p.*, u.* EXCLUDE (rating_account_id), i.* EXCLUDE (customer_id)
FROM processed_core p
LEFT JOIN usage_features u ON p.rating_account_id = u.rating_account_id
LEFT JOIN interaction_features i ON p.customer_id = i.customer_id
"""

MERGED_FILLED_SQL = """
SELECT * REPLACE (
  CAST(coalesce(num_interactions, 0) AS BIGINT) AS num_interactions,
  CAST(coalesce(num_unique_interactions, 0) AS BIGINT) AS num_unique_interactions,
  CAST(coalesce(recency, 999) AS BIGINT) AS recency,
  CAST(coalesce(interact_prolongations, 0) AS BIGINT) AS interact_prolongations,
  CAST(coalesce(interact_tarifdetails, 0) AS BIGINT) AS interact_tarifdetails,
  CAST(coalesce(interact_tarifwechsel, 0) AS BIGINT) AS interact_tarifwechsel,
  CAST(coalesce(interact_rechnungsanfragen, 0) AS BIGINT) AS interact_rechnungsanfragen)
FROM merged
"""


def with_views(
    body: str, age_edges: tuple[int, int] = (45, 60), extra: list[tuple[str, str]] | None = None
) -> str:
    """Prefix ``body`` with every input and stage view it may reference."""
    a1, a2 = age_edges
    ctes = [
        ("core_data", CORE_SQL),
        ("usage_info", USAGE_SQL),
        ("customer_interactions", INTERACTIONS_SQL),
        (
            "core_gb",
            "SELECT *, CASE WHEN isnan(TRY_CAST(available_gb AS DOUBLE)) THEN NULL "
            "ELSE TRY_CAST(available_gb AS DOUBLE) END AS gb FROM core_data",
        ),
        ("pc_buckets", PROCESSED_CORE_SQL.format(a1=a1, a2=a2)),
        ("processed_core", ONE_HOT_SQL),
        ("usage_agg", USAGE_AGG_SQL),
        ("usage_features", USAGE_FEATURES_SQL),
        ("interaction_features", INTERACTION_FEATURES_SQL),
        ("merged", MERGED_SQL),
        ("merged_filled", MERGED_FILLED_SQL),
    ] + list(extra or [])
    text = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in ctes)
    return f"WITH {text}\n{body.strip()}"
