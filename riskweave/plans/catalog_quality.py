"""Queries on profiling, validation, cleaning, split and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators import clean as C
from riskweave.operators import quality as Q
from riskweave.operators import split as SP
from riskweave.plans import sql_views as V
from riskweave.plans.registry import query
from riskweave.session import scratch_path
from riskweave.sources import adapters as A
from riskweave.sources import tables as TB

_NULLS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls FROM tx""" for c in V.TX_COLUMNS)


@query("profile_nulls", "A5", f"""WITH {V.TX} SELECT * FROM ({_NULLS}) WHERE nulls > 0""")
def profile_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return Q.null_counts(A.transactions(spark, sf))


_P99 = V.quantile("tx", "amount", 99, 100)
_AMOUNTS = f"""SELECT min(amount) AS min_amount, {V.quantile("tx", "amount", 1, 2)} AS median_amount,
  {_P99} AS p99, {V.quantile("tx", "amount", 999, 1000)} AS p999,
  count(*) FILTER (WHERE amount > {_P99}) AS rows_above_p99 FROM tx"""


@query("profile_amount", "A8 A2 J6", f"WITH {V.TX} {_AMOUNTS}")
def profile_amount(spark: SparkSession, sf: str) -> DataFrame:
    return Q.amount_profile(A.transactions(spark, sf))


_COUNTED = ("is_fraud", "customer_tier", "cvv_match", "is_3d_secure")
_COUNTS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n
  FROM tx WHERE {c} IS NOT NULL GROUP BY 2""" for c in _COUNTED)


@query("value_counts", "A6", f"WITH {V.TX} {_COUNTS}")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.value_counts_of(A.transactions(spark, sf), _COUNTED)


@query("value_counts_tier", "A6", f"""WITH {V.TX}
SELECT customer_tier AS value, count(*) AS n FROM tx GROUP BY 1""")
def value_counts_tier(spark: SparkSession, sf: str) -> DataFrame:
    return Q.value_counts(A.transactions(spark, sf), "customer_tier")


@query("class_distribution", "A7", f"""WITH {V.TX}
SELECT count(*) FILTER (WHERE is_fraud = 0) AS n_legit, count(*) FILTER (WHERE is_fraud = 1) AS n_fraud,
  avg(is_fraud) * 100 AS fraud_rate_pct FROM tx""")
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return Q.class_distribution(A.transactions(spark, sf))


_TYPES = {"timestamp": "timestamp", "amount": "double", "distance_from_home_km": "double", "is_fraud": "int"}
_DTYPES = " UNION ALL ".join(
    f"""SELECT 'dtype' AS metric, '{c}' AS "column", '{_TYPES.get(c, "string")}' AS key, CAST(NULL AS DOUBLE) AS value"""
    for c in V.TX_COLUMNS)
_AMOUNT_ROWS = " UNION ALL ".join(
    f"SELECT 'amount', 'amount', '{c}', CAST({c} AS DOUBLE) FROM amounts"
    for c in ("min_amount", "median_amount", "p99", "p999", "rows_above_p99"))


@query("dataset_profile", "A10 A5 A6 A7 A8 A9", f"""WITH {V.TX}, amounts AS ({_AMOUNTS})
{_DTYPES}
UNION ALL SELECT 'rows', NULL, NULL, CAST(count(*) AS DOUBLE) FROM tx
UNION ALL SELECT 'columns', NULL, NULL, {float(len(V.TX_COLUMNS))}
UNION ALL SELECT 'nulls', "column", NULL, CAST(nulls AS DOUBLE) FROM ({_NULLS}) WHERE nulls > 0
UNION ALL SELECT 'values', "column", value, CAST(n AS DOUBLE) FROM ({_COUNTS})
UNION ALL SELECT 'rate_pct', 'is_fraud', NULL, avg(is_fraud) * 100 FROM tx
UNION ALL SELECT 'timestamp_sample', 'timestamp', strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f'), NULL
  FROM (SELECT "timestamp" FROM tx WHERE "timestamp" IS NOT NULL ORDER BY "timestamp", transaction_id LIMIT 5)
UNION ALL SELECT 'first_time', 'timestamp', strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S.%f'), NULL FROM tx
UNION ALL SELECT 'last_time', 'timestamp', strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S.%f'), NULL FROM tx
UNION ALL {_AMOUNT_ROWS}""")
def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    return Q.dataset_profile(A.transactions(spark, sf))


@query("first_values", "O5", """SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IS NOT NULL ORDER BY o_orderkey LIMIT 5""")
def first_values(spark: SparkSession, sf: str) -> DataFrame:
    return Q.first_values(A.table(spark, sf, "orders"), "o_orderpriority", ["o_orderkey"])


@query("validate_report", "P3 P4 P5 P6 P7 U6", f"""WITH {V.DIRTY}
SELECT 'not_null' AS rule, 'timestamp' AS "column", count(*) - count(ts_ok) AS violations FROM dirty
UNION ALL SELECT 'not_negative', 'amount', count(*) FILTER (WHERE amount < 0) FROM dirty
UNION ALL SELECT 'binary', 'is_fraud', count(*) FILTER (WHERE is_fraud NOT IN (0, 1)) FROM dirty
UNION ALL SELECT 'not_null', 'customer_id', count(*) - count(customer_id) FROM dirty
UNION ALL SELECT 'unique', 'transaction_id', count(*) - count(DISTINCT transaction_id) FROM dirty""")
def validate_report(spark: SparkSession, sf: str) -> DataFrame:
    dirty = A.dirty_transactions(spark, sf)
    return Q.validation_report(dirty.withColumn("timestamp", X.parse_timestamp("timestamp")))


@query("unexpected_labels", "P5 U4", f"""WITH {V.DIRTY}
SELECT DISTINCT is_fraud FROM dirty WHERE is_fraud NOT IN (0, 1)""")
def unexpected_labels(spark: SparkSession, sf: str) -> DataFrame:
    return Q.unexpected_labels(A.dirty_transactions(spark, sf))


_FAULTS = (
    ("customer_id:required", "customer_id IS NULL"), ("timestamp:format", "ts_ok IS NULL"),
    ("amount:positive", "amount <= 0"), ("customer_tier:domain", "tier_upper = 'GOLD'"),
    ("account_age_days:not_negative", "account_age_days < 0"),
    ("is_new_device:range", "is_new_device NOT IN (0, 1)"),
    ("hour_of_day:range", "hour_of_day > 23"))
_ERRORS = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _FAULTS) + ")"


@query("quarantine_rows", "P8 F8 F10", f"""WITH {V.DIRTY}
SELECT transaction_id, amount, {_ERRORS} AS errors FROM dirty WHERE {_ERRORS} <> ''""")
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = Q.split_valid(A.dirty_transactions(spark, sf))
    return bad.select("transaction_id", "amount", F.array_join("errors", ",").alias("errors"))


@query("valid_rows", "P8 F10", f"""WITH {V.DIRTY}
SELECT transaction_id, customer_id, amount, tier_upper AS customer_tier, ts_ok AS "timestamp"
FROM dirty WHERE {_ERRORS} = ''""")
def valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = Q.split_valid(A.dirty_transactions(spark, sf))
    return good.select("transaction_id", "customer_id", "amount", "customer_tier",
                       X.parse_timestamp("timestamp").alias("timestamp"))


_AFTER = {"os": "0", "is_3d_secure": "0", "distance_from_home_km": "0"}
_IMPUTED = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls_before,
  {_AFTER.get(c, f'count(*) - count("{c}")')} AS nulls_after,
  {f'count(*) - count("{c}")' if c in _AFTER else '0'} AS resolved FROM tx""" for c in V.TX_COLUMNS)


@query("impute_report", "P16", f"WITH {V.TX} {_IMPUTED}")
def impute_report(spark: SparkSession, sf: str) -> DataFrame:
    return C.imputation_report(A.transactions(spark, sf))


_CLEAN_TX = """clean AS (
  SELECT transaction_id, "timestamp", customer_id, amount, customer_tier, merchant_category, device_type,
    coalesce(os, 'UNKNOWN') AS os, CASE WHEN cvv_match = 'Y' THEN 1 ELSE 0 END AS cvv_match,
    CASE WHEN is_3d_secure = 'Y' THEN 1 ELSE 0 END AS is_3d_secure,
    CASE WHEN transaction_status = 'APPROVED' THEN 1 ELSE 0 END AS transaction_status,
    coalesce(distance_from_home_km, 0) AS distance_from_home_km, is_fraud FROM tx)"""


@query("impute_clean", "P16 P17 F1 F2", f"WITH {V.TX}, {_CLEAN_TX} SELECT * FROM clean")
def impute_clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(A.transactions(spark, sf))


_FIRST_DIRTY = f"""WITH {V.DIRTY}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ts_ok NULLS FIRST, event_id) AS n FROM dirty)"""


def _dirty_typed(spark: SparkSession, sf: str) -> DataFrame:
    dirty = A.dirty_transactions(spark, sf)
    return dirty.withColumn("timestamp", X.parse_timestamp("timestamp"))


@query("clean_report", "P17 A3 A7", f"""{_FIRST_DIRTY}
SELECT 'before' AS side, count(*) AS n_rows, avg(is_fraud) * 100 AS fraud_rate_pct FROM firsts
UNION ALL SELECT 'after', count(*), avg(coalesce(is_fraud, 0)) * 100 FROM firsts WHERE n = 1""")
def clean_report(spark: SparkSession, sf: str) -> DataFrame:
    dirty = _dirty_typed(spark, sf)
    return C.clean_report(dirty, C.clean(dirty))


_LINE_ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("dedup_keep_first", "A3", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_LINE_ORDER)}) AS n FROM lineitem)
WHERE n = 1""")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    lines = A.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return C.keep_first(lines, ["l_orderkey"], _LINE_ORDER).drop("l_suppkey")


@query("duplicate_count", "P6", """SELECT count(*) - count(DISTINCT l_orderkey) AS violations FROM lineitem""")
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return Q.duplicate_rows(A.table(spark, sf, "lineitem"), "l_orderkey")


@query("chrono_split", "W1 U1 O1", f"""WITH {V.ORDERS}, {V.parts("ord")}
SELECT transaction_id, "timestamp", part FROM parts""")
def chrono_split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = SP.chrono_split(A.order_transactions(spark, sf))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))).select("transaction_id", "timestamp", "part")


@query("split_summary", "A9 W1 U1", f"""WITH {V.TX}, {V.parts("tx")}
SELECT part, count(*) AS n_rows, min("timestamp") AS first_time, max("timestamp") AS last_time,
  avg(is_fraud) * 100 AS fraud_rate_pct FROM parts GROUP BY part""")
def split_summary(spark: SparkSession, sf: str) -> DataFrame:
    return SP.split_summary(*SP.chrono_split(A.transactions(spark, sf)))


@query("csv_round_trip", "S1 F8 F9 P1 P2", f"""WITH {V.TX}
SELECT transaction_id, "timestamp", customer_id, amount, customer_tier, os,
  CASE WHEN cvv_match <> 'N/A' THEN cvv_match END AS cvv_match, distance_from_home_km, is_fraud FROM tx""")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    tx = A.transactions(spark, sf).select(
        "transaction_id", "timestamp", "customer_id", "amount", "customer_tier", "os", "cvv_match",
        "distance_from_home_km", "is_fraud")
    TB.write_transactions_csv(tx, path)
    back = TB.read_transactions_csv(spark, path, tx.columns)
    faults = Q.missing_columns(back) + Q.type_faults(back)
    if faults:
        raise ValueError(f"CSV lost columns or types: {faults}")
    return back


@query("parquet_round_trip", "S2 S3", f"""WITH {V.ORDERS}, {V.parts("ord")}
SELECT part, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_fraud, max(amount) AS max_amount
FROM parts GROUP BY part""")
def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "split")
    TB.write_split(*SP.chrono_split(A.order_transactions(spark, sf)), folder)
    train, test = TB.read_split(spark, folder)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("is_fraud").alias("n_fraud"), F.max("amount").alias("max_amount"))


_YN = "CASE WHEN {c} = 'Y' THEN 1 ELSE 0 END"


@query("scalar_functions", "F1 F2 F3 F4 F5 F6 F7 F9 F11 F12 F13 F14 F16 F17 F18 F20 F22", f"""WITH {V.TX}, {V.SCORED}
SELECT tx.transaction_id, {_YN.format(c="cvv_match")} AS cvv, {_YN.format(c="is_3d_secure")} AS secure,
  CASE WHEN transaction_status = 'APPROVED' THEN 1 ELSE 0 END AS status,
  CAST(hour(tx."timestamp") AS INT) AS hour, CAST(isodow(tx."timestamp") - 1 AS INT) AS weekday,
  CASE WHEN isodow(tx."timestamp") >= 6 THEN 1 ELSE 0 END AS weekend,
  CASE WHEN hour(tx."timestamp") >= 23 OR hour(tx."timestamp") <= 5 THEN 1 ELSE 0 END AS night,
  ln(1 + greatest(tx.amount - 5, 0)) AS amount_log,
  coalesce(TRY_CAST(os AS DOUBLE), -1) AS parsed,
  {V.risk_band("score")} AS band, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS decided,
  least(greatest(tx.amount / 100.0 - 1, 0), 1) AS clipped,
  CASE WHEN tx.amount > 1 THEN tx.amount / 100.0 ELSE tx.amount END AS fraction,
  greatest(tx.amount, 10.0) AS clamped, coalesce(os, 'UNKNOWN') AS os_label,
  CASE customer_tier WHEN 'INSPIRE' THEN 0 WHEN 'MASS' THEN 1 ELSE -1 END AS tier_code
FROM tx JOIN scored USING (transaction_id)""")
def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    tx = A.transactions(spark, sf).join(A.scored(spark, sf).select("transaction_id", "score"), "transaction_id")
    return tx.select(
        "transaction_id", X.flag("cvv_match").alias("cvv"), X.flag("is_3d_secure").alias("secure"),
        X.status("transaction_status").alias("status"), F.hour("timestamp").alias("hour"),
        X.monday_based_weekday("timestamp").alias("weekday"), X.is_weekend("timestamp").alias("weekend"),
        X.is_night(F.hour("timestamp")).alias("night"),
        X.amount_log(F.col("amount") - 5).alias("amount_log"), X.parse_double("os", -1.0).alias("parsed"),
        X.risk_band("score").alias("band"), X.decision("score", 0.5).alias("decided"),
        X.clip_unit(F.col("amount") / 100.0 - 1).alias("clipped"), X.as_fraction("amount").alias("fraction"),
        X.clamp_min("amount", 10.0).alias("clamped"), X.or_unknown("os").alias("os_label"),
        X.code_from("customer_tier", dict(zip(S.CUSTOMER_TIERS[:2], range(2))), -1).alias("tier_code"))
