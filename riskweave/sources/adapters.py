"""Transaction views over the star-schema tables, by plain arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import scalars as X


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, names: tuple[str, ...]) -> Column:
    return F.element_at(F.lit(list(names)), (index + 1).cast("int"))


def _yes_no(number: Column) -> Column:
    return F.when(number == 0, "N").when(number == 1, "N/A").when(number != 2, "Y")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(table(spark, sf_dir, "events"))


def transactions_of(events: DataFrame) -> DataFrame:
    """One transaction per event; ``events`` may be a stream."""
    e, u = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return events.select(
        e.cast("string").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        u.cast("string").alias("customer_id"),
        F.col("value").alias("amount"),
        _pick(u % 4, S.CUSTOMER_TIERS).alias("customer_tier"),
        F.col("event_type").alias("merchant_category"),
        _pick(e % 3, ("Desktop", "Mobile", "POS")).alias("device_type"),
        F.when(e % 5 > 2, "iOS").when(e % 5 > 0, "Android").alias("os"),
        _yes_no(e % 10).alias("cvv_match"),
        _yes_no(e % 7).alias("is_3d_secure"),
        F.when(e % 9 == 0, "DECLINED").otherwise("APPROVED").alias("transaction_status"),
        F.when(e % 11 != 0, k).alias("distance_from_home_km"),
        _error_label().alias("is_fraud"),
    )


def _error_label() -> Column:
    return ((F.col("event_type") == "error") & (F.col("value") > 20)).cast("int")


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_transactions_of(table(spark, sf_dir, "events"))


def dirty_transactions_of(events: DataFrame) -> DataFrame:
    """The same events as untyped requests with defects of every kind."""
    e = F.col("event_id")
    return events.select(
        (e - (e % 101 == 0).cast("int")).cast("string").alias("transaction_id"),
        F.when(e % 89 == 0, "not-a-time")
        .otherwise(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("timestamp"),
        F.when(e % 97 != 0, F.col("user_id").cast("string")).alias("customer_id"),
        (F.col("value") - 5.0).alias("amount"),
        F.when(e % 71 == 0, "GOLD").when(e % 2 == 1, F.lower(_pick(F.col("user_id") % 4, S.CUSTOMER_TIERS)))
        .otherwise(_pick(F.col("user_id") % 4, S.CUSTOMER_TIERS)).alias("customer_tier"),
        (e % 26).cast("int").alias("hour_of_day"),
        F.when(e % 29 == 0, 2).otherwise((e % 2).cast("int")).alias("is_new_device"),
        (e % 1000 - 3).cast("int").alias("account_age_days"),
        F.when(e % 83 == 0, 2).when(e % 79 != 0, _error_label()).alias("is_fraud"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled scores by formula, with many ties, for evaluation without a model."""
    label = _error_label()
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("event_id").alias("row_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _pick(F.col("user_id") % 4, S.CUSTOMER_TIERS).alias("segment"),
        F.col("value").alias("amount"),
        label.alias("label"),
        formula_score(F.col("event_id"), F.col("user_id"), label).alias("score"),
    )


def formula_score(event: Column, user: Column, label: Column) -> Column:
    """A score that leans towards the label, for jobs without a model."""
    return ((event * 7919 + user * 104729) % 1000 + 500 * label) / F.lit(1500.0)


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order: heavy time ties and unseen customers."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            F.col("o_orderdate").cast("timestamp").alias("timestamp"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_totalprice").alias("amount"),
            F.col("c_mktsegment").alias("customer_tier"),
            F.col("o_orderpriority").alias("merchant_category"),
            F.col("n_name").alias("merchant_country"),
            (F.col("o_orderstatus") == "F").cast("int").alias("is_fraud"),
        )
    )


def requests(spark: SparkSession, sf_dir: str, candidate_percent: float = 30.0) -> DataFrame:
    """Request log of the scoring service."""
    return request_log(table(spark, sf_dir, "events"), candidate_percent)


def request_log(events: DataFrame, candidate_percent: float = 30.0) -> DataFrame:
    e, kind = F.col("event_id"), F.col("event_type")
    return events.select(
        e.alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        kind.alias("path"),
        F.when((kind == "error") & (e % 4 == 0), 500).when(kind == "error", 422)
        .otherwise(200).cast("string").alias("status"),
        (F.col("value") / 100.0).alias("latency_s"),
        formula_score(e, F.col("user_id"), _error_label()).alias("score"),
        F.col("value").alias("amount"),
        X.traffic_slot(X.spread_key(e), candidate_percent).alias("slot"),
    )
