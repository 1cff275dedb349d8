"""Column contracts and fixed values of the transaction domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
REQUIRED_COLUMNS = (
    "transaction_id", "timestamp", "customer_id", "amount", "customer_tier", "is_fraud",
)
NON_FEATURE_COLUMNS = ("transaction_id", "customer_id", "timestamp", "is_fraud")
CATEGORY_COLUMNS = (
    "card_type", "card_tier", "currency", "merchant_category",
    "merchant_country", "device_type", "os", "ip_country",
)
HIGH_CARDINALITY_COLUMNS = ("merchant_name", "merchant_city")
BEHAVIOUR_COLUMNS = (
    "tx_count_last_1h", "tx_count_last_24h", "time_since_last_tx_min",
    "avg_amount_last_30d", "amount_ratio_vs_avg", "distance_from_home_km",
    "is_new_device", "is_new_merchant",
)
CUSTOMER_TIERS = ("INSPIRE", "MASS", "PRIORITY", "PRIVATE")
FLAG_VALUES = {"Y": 1, "N": 0, "N/A": 0}
STATUS_VALUES = {"APPROVED": 1, "DECLINED": 0}
RISK_BANDS = ((0.30, "LOW"), (0.60, "MEDIUM"))
TOP_RISK_BAND = "HIGH"
MODEL_FEATURES = (
    "is_weekend", "card_bin", "card_type", "card_tier", "account_age_days",
    "amount", "currency", "mcc_code", "merchant_category", "merchant_country",
    "device_type", "os", "ip_country", "distance_from_home_km", "cvv_match",
    "is_3d_secure", "transaction_status", "tx_count_last_1h",
    "tx_count_last_24h", "time_since_last_tx_min", "avg_amount_last_30d",
    "amount_ratio_vs_avg", "is_new_device", "is_new_merchant",
    "transaction_hour", "transaction_day_of_week", "is_night_transaction",
    "amount_log", "segment_encoded", "customer_tx_count", "customer_avg_amount",
)
LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
SCORE_BOUNDS = (0.01, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 0.9, 0.95, 0.99)
AMOUNT_BOUNDS = (50000.0, 100000.0, 250000.0, 500000.0, 1000000.0, 5000000.0, 10000000.0, 50000000.0)
REGRESSION_TOLERANCE = {"pr_auc": 0.02, "f1": 0.03, "recall": 0.02}
MIN_RECALL, MAX_THRESHOLD = 0.95, 0.70
DRIFT_WINDOW, DRIFT_REFERENCE_ROWS, DRIFT_WARMUP_ROWS, DRIFT_ALERT = 500, 2000, 100, 0.2
DRIFT_BINS, CATEGORY_LIMIT = 10, 12
BATCH_ROWS = (1, 1000)
# texts that a CSV reader of the dataframe world takes for a missing value
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# where a drift reference comes from, and why a snapshot is as it is
MODE_TRAIN, MODE_WARMUP, MODE_MISSING = "train_parquet", "warmup_window", "missing"
REASON_UPDATED, REASON_WARMUP = "updated_from_live_traffic", "waiting_for_warmup_window"
REASON_CURRENT, REASON_OVERLAP = "waiting_for_current_window", "feature_overlap_missing"
REASON_TRANSFORM, REASON_LOADED = "transform_unavailable", "reference_loaded_from_"
# --- end of fixed values ----------------------------------------------------

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", _S), T.StructField("timestamp", T.TimestampType()),
    T.StructField("hour_of_day", _I), T.StructField("is_weekend", _I),
    T.StructField("customer_id", _S), T.StructField("card_bin", _I),
    T.StructField("card_type", _S), T.StructField("card_tier", _S),
    T.StructField("account_age_days", _I), T.StructField("amount", _D),
    T.StructField("currency", _S), T.StructField("merchant_name", _S),
    T.StructField("mcc_code", _I), T.StructField("merchant_category", _S),
    T.StructField("merchant_city", _S), T.StructField("merchant_country", _S),
    T.StructField("device_type", _S), T.StructField("os", _S),
    T.StructField("ip_country", _S), T.StructField("distance_from_home_km", _D),
    T.StructField("cvv_match", _S), T.StructField("is_3d_secure", _S),
    T.StructField("transaction_status", _S), T.StructField("tx_count_last_1h", _I),
    T.StructField("tx_count_last_24h", _I), T.StructField("time_since_last_tx_min", _D),
    T.StructField("avg_amount_last_30d", _D), T.StructField("amount_ratio_vs_avg", _D),
    T.StructField("is_new_device", _I), T.StructField("is_new_merchant", _I),
    T.StructField("customer_tier", _S), T.StructField("is_fraud", _I),
])

# a request carries the time as text and no label
REQUEST_SCHEMA = T.StructType([
    T.StructField(f.name, _S if f.name == "timestamp" else f.dataType)
    for f in TRANSACTION_SCHEMA if f.name != "is_fraud"
])

CUSTOMER_STATS_SCHEMA = T.StructType([
    T.StructField("customer_id", _S), T.StructField("customer_tx_count", _L),
    T.StructField("customer_avg_amount", _D),
])
CODES_SCHEMA = T.StructType([
    T.StructField("column", _S), T.StructField("value", _S), T.StructField("code", _I),
])
