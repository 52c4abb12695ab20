"""Table schemas, bucket edges, label domains and feature lists.

Everything below the "fixed values" marker must equal the reference's
definitions for results to match; it is stated plainly, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's definitions)
# ---------------------------------------------------------------------------

CORE_SCHEMA = T.StructType(
    [
        T.StructField("rating_account_id", T.LongType(), False),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("age", T.IntegerType(), True),
        T.StructField("contract_lifetime_days", T.IntegerType(), True),
        T.StructField("remaining_binding_days", T.IntegerType(), True),
        T.StructField("has_special_offer", T.IntegerType(), True),
        T.StructField("is_magenta1_customer", T.IntegerType(), True),
        T.StructField("available_gb", T.StringType(), True),
        T.StructField("gross_mrc", T.DoubleType(), True),
        T.StructField("smartphone_brand", T.StringType(), True),
        T.StructField("has_done_upselling", T.IntegerType(), True),
    ]
)

USAGE_SCHEMA = T.StructType(
    [
        T.StructField("rating_account_id", T.LongType(), True),
        T.StructField("billed_period_month_d", T.DateType(), True),
        T.StructField("has_used_roaming", T.IntegerType(), True),
        T.StructField("used_gb", T.DoubleType(), True),
    ]
)

INTERACTIONS_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("type_subtype", T.StringType(), True),
        T.StructField("n", T.LongType(), True),
        T.StructField("days_since_last", T.IntegerType(), True),
    ]
)

# Depth of the forests that compare feature sets (own bound: trees on raw columns grow with the rows).
COMPARE_MAX_DEPTH = 15

KEY = "rating_account_id"
CUSTOMER = "customer_id"
LABEL = "has_done_upselling"

# Interval buckets: (lo, hi] per label, values outside every interval -> null.
BINDING_EDGES = [-1000, -1, 30, 90, 180, 1000]
BINDING_LABELS = ["Expired", "0-30", "31-90", "91-180", ">180"]
MRC_EDGES = [0, 30, 50, 70]
MRC_LABELS = ["Low (<30€)", "Mid (30-50€)", "High (>50€)"]
TERM_EDGES = [0, 365, 730, 1095, 1825]
TERM_LABELS = ["<1y", "1-2y", "2-3y", "3-5y"]
AGE_EDGES = [0, 25, 45, 60, 100]
AGE_EDGES_NOTEBOOK = [0, 25, 46, 61, 100]
AGE_LABELS = ["<25", "25-45", "46-60", ">60"]

# Brands in code-point order (the order a categorical takes); the first
# level is the one "drop first" removes.
BRAND_LEVELS = ["Huawei", "OnePlus", "Samsung", "Xiaomi", "iPhone"]
PREMIUM_BRANDS = ["iPhone", "Samsung"]

# Interaction subtype patterns (case-insensitive regex) and output names.
INTERACTION_PATTERNS = [
    ("prolongation", "interact_prolongations"),
    ("tarifdetails", "interact_tarifdetails"),
    ("tarifwechsel", "interact_tarifwechsel"),
    ("rechnungsanfragen", "interact_rechnungsanfragen"),
]

# Evaluation settings.
TOP_K_FRACTIONS = [0.05, 0.10, 0.20]
DECISION_THRESHOLD = 0.50
NOTEBOOK_THRESHOLD = 0.55
PROMOTION_MIN_AUC = 0.70
BUDGET_FRACTION = 0.10
N_FOLDS = 5
SPLIT_SEED = 42
RECENCY_FILL = 999

# Random forest of the training step.
RF_PARAMS = {"num_trees": 300, "min_leaf": 50, "seed": 42}
RF_NOTEBOOK_TREES = 100

# Logistic regression of the training step.
LR_C = 1.0
LR_MAX_ITER = 1000

# Manual feature selection of the training step, in order.
SELECTED_FEATURES = [
    "remaining_binding_days_bucket_0-30",
    "remaining_binding_days_bucket_31-90",
    "remaining_binding_days_bucket_91-180",
    "remaining_binding_days_bucket_>180",
    "mrc_bucket_Mid (30-50€)",
    "mrc_bucket_High (>50€)",
    "contract_term_bucket_1-2y",
    "contract_term_bucket_2-3y",
    "contract_term_bucket_3-5y",
    "age_bucket_25-45",
    "age_bucket_46-60",
    "age_bucket_>60",
    "available_gb",
    "available_gb_missing",
    "has_special_offer",
    "is_magenta1_customer",
    "is_premium_device",
]

# Notebook feature sets.
CORE_RAW = [
    "age",
    "contract_lifetime_days",
    "remaining_binding_days",
    "gross_mrc",
    "available_gb",
    "available_gb_missing",
    "has_special_offer",
    "is_magenta1_customer",
    "is_premium_device",
]
CORE_WITH_BUCKETS = SELECTED_FEATURES
USAGE_FEATURES = [
    "total_used_gb",
    "avg_used_gb",
    "std_used_gb",
    "min_used_gb",
    "max_used_gb",
    "roaming_months",
    "roaming_ratio",
    "had_roaming",
    "usage_increase",
    "usage_trend",
]
INTERACTION_FEATURES = [
    "num_interactions",
    "num_unique_interactions",
    "recency",
    "interact_prolongations",
    "interact_tarifdetails",
    "interact_tarifwechsel",
    "interact_rechnungsanfragen",
]
INTERACTION_COUNT_COLUMNS = [
    "num_interactions",
    "num_unique_interactions",
    "interact_prolongations",
    "interact_tarifdetails",
    "interact_tarifwechsel",
    "interact_rechnungsanfragen",
]

# Rule score of the generator: (predicate, weight) pairs, summed and clipped to [0, 1].
RULE_TERMS = [
    ("age < 45", 0.2),
    ("contract_lifetime_days >= 300 AND contract_lifetime_days <= 1460", 0.15),
    ("remaining_binding_days < 60", 0.1),
    ("is_magenta1_customer = 1", 0.1),
    ("available_gb_value <= 20", 0.2),
    ("gross_mrc < 35", 0.1),
]
RULE_BASE_RATE = 0.07

# Columns of the label-history view.
CONTRACT_VIEW = [
    KEY,
    CUSTOMER,
    "age",
    "contract_lifetime_days",
    "remaining_binding_days",
    "has_special_offer",
    "is_magenta1_customer",
    LABEL,
]

# Output names of the usage aggregate, in order.
USAGE_OUTPUT = [
    "rating_account_id",
    "total_used_gb",
    "avg_used_gb",
    "std_used_gb",
    "min_used_gb",
    "max_used_gb",
    "usage_month_count",
    "roaming_months",
    "roaming_ratio",
    "had_roaming",
    "usage_increase",
    "usage_trend",
]

# Columns of the notebook's profiles.
PROFILE_COLUMNS = [
    "remaining_binding_days_bucket", "mrc_bucket", "contract_term_bucket", "age_bucket",
    "smartphone_brand", "is_magenta1_customer", "available_gb",
]
CROSSTAB_FEATURES = [
    "is_magenta1_customer", "has_special_offer", "mrc_bucket", "remaining_binding_days_bucket",
    "contract_term_bucket", "age_bucket",
]
# (source view, column, bins) of the notebook's histograms.
HISTOGRAMS = [
    ("core", "remaining_binding_days", 30),
    ("core", "gross_mrc", 30),
    ("core", "age", 30),
    ("usage", "avg_used_gb", 10),
    ("interactions", "num_interactions", 20),
]


def feature_sets() -> dict[str, list[str]]:
    """The notebook's feature sets: each core view alone, with usage, with interactions, with both."""
    both = list(dict.fromkeys(CORE_RAW + CORE_WITH_BUCKETS))
    return {
        "core_raw": CORE_RAW,
        "core_with_buckets": CORE_WITH_BUCKETS,
        "core_raw+usage": CORE_RAW + USAGE_FEATURES,
        "core_raw+interactions": CORE_RAW + INTERACTION_FEATURES,
        "core_with_buckets+usage": CORE_WITH_BUCKETS + USAGE_FEATURES,
        "core_with_buckets+interactions": CORE_WITH_BUCKETS + INTERACTION_FEATURES,
        "core_raw+usage+interactions": CORE_RAW + USAGE_FEATURES + INTERACTION_FEATURES,
        "core_with_buckets+usage+interactions": CORE_WITH_BUCKETS + USAGE_FEATURES + INTERACTION_FEATURES,
        "raw+buckets": both,
    }
