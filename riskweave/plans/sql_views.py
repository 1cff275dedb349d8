"""SQL twins of the adapters, used only to check results."""

from __future__ import annotations

TIER = ("CASE user_id % 4 WHEN 0 THEN 'INSPIRE' WHEN 1 THEN 'MASS' "
        "WHEN 2 THEN 'PRIORITY' ELSE 'PRIVATE' END")
LABEL = "CASE WHEN event_type = 'error' AND value > 20 THEN 1 ELSE 0 END"
SCORE = f"((event_id * 7919 + user_id * 104729) % 1000 + 500 * ({LABEL})) / CAST(1500.0 AS DOUBLE)"
SPREAD = "(((event_id % 2147483647) * 2654435761) % 4294967296)"
K = "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS DOUBLE)"

TX = f"""tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, ts AS "timestamp",
    CAST(user_id AS VARCHAR) AS customer_id, value AS amount, {TIER} AS customer_tier,
    event_type AS merchant_category,
    CASE event_id % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' ELSE 'POS' END AS device_type,
    CASE WHEN event_id % 5 > 2 THEN 'iOS' WHEN event_id % 5 > 0 THEN 'Android' END AS os,
    CASE event_id % 10 WHEN 0 THEN 'N' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL ELSE 'Y' END AS cvv_match,
    CASE event_id % 7 WHEN 0 THEN 'N' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL ELSE 'Y' END AS is_3d_secure,
    CASE WHEN event_id % 9 = 0 THEN 'DECLINED' ELSE 'APPROVED' END AS transaction_status,
    CASE WHEN event_id % 11 <> 0 THEN {K} END AS distance_from_home_km,
    {LABEL} AS is_fraud
  FROM events)"""
TX_COLUMNS = (
    "transaction_id", "timestamp", "customer_id", "amount", "customer_tier", "merchant_category",
    "device_type", "os", "cvv_match", "is_3d_secure", "transaction_status",
    "distance_from_home_km", "is_fraud")

DIRTY = f"""dirty AS (
  SELECT CAST(event_id - CASE WHEN event_id % 101 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS transaction_id,
    CASE WHEN event_id % 89 <> 0 THEN ts END AS ts_ok,
    CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
    value - 5.0 AS amount,
    CASE WHEN event_id % 71 = 0 THEN 'GOLD' ELSE {TIER} END AS tier_upper,
    CAST(event_id % 26 AS INT) AS hour_of_day,
    CASE WHEN event_id % 29 = 0 THEN 2 ELSE CAST(event_id % 2 AS INT) END AS is_new_device,
    CAST(event_id % 1000 - 3 AS INT) AS account_age_days,
    CASE WHEN event_id % 83 = 0 THEN 2 WHEN event_id % 79 <> 0 THEN {LABEL} END AS is_fraud,
    event_id
  FROM events)"""

SCORED = f"""scored AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_id AS row_id, ts AS "timestamp",
    {TIER} AS segment, value AS amount, {LABEL} AS label, {SCORE} AS score
  FROM events)"""

ORDERS = """ord AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_orderdate AS "timestamp",
    CAST(o_custkey AS VARCHAR) AS customer_id, o_totalprice AS amount,
    c_mktsegment AS customer_tier, o_orderpriority AS merchant_category, n_name AS merchant_country,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fraud
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

LOG = f"""log AS (
  SELECT event_id AS request_id, ts, event_type AS path,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
    CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN '500'
         WHEN event_type = 'error' THEN '422' ELSE '200' END AS status,
    value / 100.0 AS latency_s, {SCORE} AS score, value AS amount,
    CASE WHEN {SPREAD} % 10000 < 3000 THEN 'candidate' ELSE 'stable' END AS slot
  FROM events)"""


def parts(view: str, ratio: float = 0.8) -> str:
    """Rows of ``view`` with their chronological part."""
    return f"""parts AS (
  SELECT * EXCLUDE (_k, _n), CASE WHEN _k < CAST(floor(CAST(_n AS DOUBLE) * CAST({ratio} AS DOUBLE)) AS BIGINT)
    THEN 'train' ELSE 'test' END AS part
  FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", transaction_id) - 1 AS _k,
               count(*) OVER () AS _n FROM {view}))"""


def quantile(table: str, column: str, num: int, den: int, where: str = "true") -> str:
    """Interpolated quantile at num/den as a scalar subquery."""
    ranked = (f"(SELECT {column} AS v, row_number() OVER (ORDER BY {column}) - 1 AS k, "
              f"count(*) OVER () AS n FROM {table} WHERE {column} IS NOT NULL AND {where})")
    low = f"({num} * (n - 1)) // {den}"
    rest = f"CAST(({num} * (n - 1)) % {den} AS DOUBLE) / {den}"
    return (f"(SELECT lo + (hi - lo) * rest FROM (SELECT "
            f"max(v) FILTER (WHERE k = {low}) AS lo, "
            f"max(v) FILTER (WHERE k = least({low} + 1, n - 1)) AS hi, max({rest}) AS rest FROM {ranked}))")


def risk_band(score: str) -> str:
    return f"CASE WHEN {score} < 0.30 THEN 'LOW' WHEN {score} < 0.60 THEN 'MEDIUM' ELSE 'HIGH' END"
