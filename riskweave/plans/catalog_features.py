"""Queries on feature state, transform and behavioural history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import behaviour as B
from riskweave.operators import features as FX
from riskweave.operators import split as SP
from riskweave.plans import prepare as P
from riskweave.plans import sql_views as V
from riskweave.plans.registry import query
from riskweave.session import scratch_path, settle
from riskweave.sources import adapters as A
from riskweave.sources import tables as TB

_ORDERS = f"{V.ORDERS}, {V.parts('ord')}, train AS (SELECT * FROM parts WHERE part = 'train'), " \
          "test AS (SELECT * FROM parts WHERE part = 'test')"
_CODED = ("customer_tier", "merchant_category", "merchant_country")


def _codes(columns, table="train") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS code
  FROM (SELECT DISTINCT {c} FROM {table} WHERE {c} IS NOT NULL)""" for c in columns)


_STATS = """stats AS (SELECT customer_id, count(amount) AS customer_tx_count,
  CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) / count(amount) AS customer_avg_amount FROM train GROUP BY customer_id)"""


def _orders_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    # joined once; the split, the fit and the transform read the narrow table
    return SP.chrono_split(settle(A.order_transactions(spark, sf), "orders"))


@query("customer_stats", "A1", f"WITH {_ORDERS}, {_STATS} SELECT * FROM stats")
def customer_stats(spark: SparkSession, sf: str) -> DataFrame:
    return FX.customer_stats(_orders_split(spark, sf)[0])


@query("category_codes", "A4 D5", f"WITH {_ORDERS} {_codes(_CODED)}")
def category_codes(spark: SparkSession, sf: str) -> DataFrame:
    return FX.category_codes(_orders_split(spark, sf)[0], _CODED)


def _code_of(c: str) -> str:
    return f"""coalesce((SELECT code FROM codes WHERE codes."column" = '{c}' AND codes.value = t.{c}), -1)"""


@query("transform_test", "M12 J1 J2 J3 F3 F4 F5 F7 P14", f"""WITH {_ORDERS}, {_STATS}, codes AS ({_codes(_CODED)})
SELECT t.transaction_id, t.customer_id, "timestamp", amount, is_fraud,
  {_code_of("merchant_category")} AS merchant_category, {_code_of("merchant_country")} AS merchant_country,
  CAST(hour("timestamp") AS INT) AS transaction_hour, CAST(isodow("timestamp") - 1 AS INT) AS transaction_day_of_week,
  CASE WHEN hour("timestamp") >= 23 OR hour("timestamp") <= 5 THEN 1 ELSE 0 END AS is_night_transaction,
  ln(1 + greatest(amount, 0)) AS amount_log, {_code_of("customer_tier")} AS segment_encoded,
  coalesce(s.customer_tx_count, 0) AS customer_tx_count,
  coalesce(s.customer_avg_amount, {V.quantile("train", "amount", 1, 2)}) AS customer_avg_amount
FROM test t LEFT JOIN stats s ON t.customer_id = s.customer_id""")
def transform_test(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _orders_split(spark, sf)
    return FX.FeatureState.fit(train).transform(test)


_TX_CODED = ("customer_tier", "merchant_category", "device_type", "os")
_PREPARED = f"""{V.TX}, clean AS (SELECT * REPLACE (coalesce(os, 'UNKNOWN') AS os) FROM tx), {V.parts("clean")},
train AS (SELECT * FROM parts WHERE part = 'train'), test AS (SELECT * FROM parts WHERE part = 'test'),
{_STATS}, codes AS ({_codes(_TX_CODED)}), features AS (
  SELECT t.*, {_code_of("customer_tier")} AS segment_encoded, {_code_of("os")} AS os_code,
    {_code_of("device_type")} AS device_code,
    CASE WHEN hour("timestamp") >= 23 OR hour("timestamp") <= 5 THEN 1 ELSE 0 END AS is_night_transaction,
    ln(1 + greatest(amount, 0)) AS amount_log, coalesce(s.customer_tx_count, 0) AS customer_tx_count,
    coalesce(s.customer_avg_amount, {V.quantile("train", "amount", 1, 2)}) AS customer_avg_amount
  FROM test t LEFT JOIN stats s ON t.customer_id = s.customer_id)"""


@query("prepare_summary", "M12 P17 W1 A1 A2 A4 J1 J3 P12", f"""WITH {_PREPARED}
SELECT segment_encoded, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_fraud,
  CAST(sum(is_night_transaction) AS BIGINT) AS n_night,
  count(*) FILTER (WHERE customer_tx_count = 0) AS n_unseen,
  avg(amount_log) AS avg_amount_log, avg(customer_avg_amount) AS avg_customer_amount
FROM features GROUP BY 1""")
def prepare_summary(spark: SparkSession, sf: str) -> DataFrame:
    return P.tier_summary(P.prepare(A.transactions(spark, sf)).test)


@query("state_round_trip", "S4 D5 F22", f"""WITH {_PREPARED}
SELECT 'customer_stats' AS part, customer_id AS key, CAST(customer_tx_count AS DOUBLE) AS value FROM stats
UNION ALL SELECT "column", value, CAST(code AS DOUBLE) FROM codes
UNION ALL SELECT 'median', NULL, {V.quantile("train", "amount", 1, 2)}""")
def state_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "state")
    done = P.prepare(A.transactions(spark, sf))
    done.state.save(folder)
    back = FX.FeatureState.load(spark, folder)
    median = spark.createDataFrame([("median", None, back.median)], "part string, key string, value double")
    return back.stats.select(
        F.lit("customer_stats").alias("part"), F.col("customer_id").alias("key"),
        F.col("customer_tx_count").cast("double").alias("value")
    ).unionByName(back.codes.select(
        F.col("column").alias("part"), F.col("value").alias("key"), F.col("code").cast("double").alias("value"))
    ).unionByName(median)


_FEATURES = ("amount", "merchant_category", "merchant_country", "transaction_hour", "transaction_day_of_week",
             "is_night_transaction", "amount_log", "segment_encoded", "customer_tx_count", "customer_avg_amount")


@query("feature_list", "S5 D4 P12", "SELECT * FROM (VALUES " + ", ".join(
    f"('is_fraud', {i}, '{f}')" for i, f in enumerate(_FEATURES)) + ") AS v(target, position, feature)")
def feature_list(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "features")
    train, _ = _orders_split(spark, sf)
    TB.write_feature_list(spark, FX.feature_columns(FX.FeatureState.fit(train).transform(train)), folder)
    return TB.read_feature_list(spark, folder).select(
        "target", F.posexplode("features").alias("position", "feature"))


@query("numeric_projection", "P10 P11 P13 Q6", f"""WITH {V.TX}
SELECT transaction_id, amount, CAST(is_fraud AS DOUBLE) AS is_fraud, 0.0::DOUBLE AS card_bin,
  0.0::DOUBLE AS device_type FROM tx""")
def numeric_projection(spark: SparkSession, sf: str) -> DataFrame:
    tx = A.transactions(spark, sf)
    narrow = FX.project_features(tx, ["amount", "device_type", "is_fraud"], ["transaction_id"])
    return FX.align_features(narrow, ["amount", "is_fraud", "card_bin", "device_type"], ["transaction_id"])


@query("class_sample", "P18", f"""WITH {V.TX}
(SELECT transaction_id, is_fraud, amount FROM tx WHERE is_fraud = 0 ORDER BY transaction_id LIMIT 1)
UNION ALL (SELECT transaction_id, is_fraud, amount FROM tx WHERE is_fraud = 1 ORDER BY transaction_id LIMIT 1)""")
def class_sample(spark: SparkSession, sf: str) -> DataFrame:
    tx = A.transactions(spark, sf).select("transaction_id", "is_fraud", "amount")
    one = [tx.filter(F.col("is_fraud") == y).orderBy("transaction_id").limit(1) for y in (0, 1)]
    return one[0].unionByName(one[1])


@query("unseen_customers", "J11 U4", f"""WITH {_ORDERS}
SELECT DISTINCT customer_id FROM test WHERE customer_id NOT IN (SELECT customer_id FROM train)""")
def unseen_customers(spark: SparkSession, sf: str) -> DataFrame:
    return FX.unseen_customers(*_orders_split(spark, sf))


@query("seen_customers", "J11 U3", f"""WITH {_ORDERS}
SELECT customer_id FROM test INTERSECT SELECT customer_id FROM train""")
def seen_customers(spark: SparkSession, sf: str) -> DataFrame:
    return FX.seen_in_both(*_orders_split(spark, sf))


@query("class_weight", "A11", f"""WITH {_ORDERS}
SELECT negatives, positives, negatives / positives AS scale_pos_weight FROM (
  SELECT count(*) FILTER (WHERE is_fraud = 0) AS negatives, count(*) FILTER (WHERE is_fraud = 1) AS positives
  FROM train)""")
def class_weight(spark: SparkSession, sf: str) -> DataFrame:
    return FX.class_weight(_orders_split(spark, sf)[0])


def _behaviour_sql(view: str) -> str:
    earlier = """(PARTITION BY customer_id ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"""
    return f"""
SELECT transaction_id, tx_count_last_1h, tx_count_last_24h, time_since_last_tx_min, avg_amount_last_30d,
  amount / avg_amount_last_30d AS amount_ratio_vs_avg FROM (
SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS tx_count_last_1h,
  count(*) OVER (PARTITION BY customer_id ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS tx_count_last_24h,
  (epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER
    (PARTITION BY customer_id ORDER BY "timestamp", transaction_id)) / 60000000.0::DOUBLE AS time_since_last_tx_min,
  CASE WHEN count(amount) OVER {earlier} > 0 THEN CAST(sum(CAST(amount AS DECIMAL(28,6))) OVER {earlier} AS DOUBLE)
    / count(amount) OVER {earlier} END AS avg_amount_last_30d
FROM {view})"""


_BEHAVIOUR = ("transaction_id", "tx_count_last_1h", "tx_count_last_24h", "time_since_last_tx_min",
              "avg_amount_last_30d", "amount_ratio_vs_avg")


@query("behaviour_windows", "W4 W5 W6", f"WITH {V.TX} {_behaviour_sql('tx')}")
def behaviour_windows(spark: SparkSession, sf: str) -> DataFrame:
    tx = A.transactions(spark, sf).select("transaction_id", "customer_id", "timestamp", "amount")
    return B.behaviour(tx).select(*_BEHAVIOUR)


@query("behaviour_windows_ties", "W4 W5 W6", f"WITH {V.ORDERS} {_behaviour_sql('ord')}")
def behaviour_windows_ties(spark: SparkSession, sf: str) -> DataFrame:
    orders = A.order_transactions(spark, sf).select("transaction_id", "customer_id", "timestamp", "amount")
    return B.behaviour(orders).select(*_BEHAVIOUR)


@query("first_seen", "W7", f"""WITH {V.TX}
SELECT transaction_id,
  CASE WHEN row_number() OVER (PARTITION BY customer_id, device_type ORDER BY "timestamp", transaction_id) = 1
    THEN 1 ELSE 0 END AS is_new_device,
  CASE WHEN row_number() OVER (PARTITION BY customer_id, merchant_category ORDER BY "timestamp", transaction_id) = 1
    THEN 1 ELSE 0 END AS is_new_merchant FROM tx""")
def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    tx = A.transactions(spark, sf).select(
        "transaction_id", "customer_id", "timestamp", "device_type", "merchant_category")
    both = B.first_seen(B.first_seen(tx, "device_type", "is_new_device"), "merchant_category", "is_new_merchant")
    return both.select("transaction_id", "is_new_device", "is_new_merchant")


@query("codes_from_json", "S4 F22 J3", f"WITH {_ORDERS} {_codes(_CODED)}")
def codes_from_json(spark: SparkSession, sf: str) -> DataFrame:
    """The code tables through their JSON map form and back."""
    folder = scratch_path(spark, "maps")
    codes = FX.category_codes(_orders_split(spark, sf)[0], _CODED)
    entries = F.map_from_entries(F.collect_list(F.struct("value", "code")))
    per_column = codes.groupBy("column").agg(entries.alias("m"))
    tier = per_column.filter(F.col("column") == FX.TIER).select(F.to_json("m"))
    nested = per_column.filter(F.col("column") != FX.TIER).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("column", "m")))))
    tier.write.text(f"{folder}/tiers")
    nested.write.text(f"{folder}/categories")
    return FX.codes_from_json(spark, f"{folder}/tiers", f"{folder}/categories")
