"""Feature state fitted on training rows only, and the transform that uses it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators.clean import encode_flags
from riskweave.operators.rank import exact_quantiles, prefix_sums
from riskweave.operators.skew import HOT_ROWS, hot_hashes, salted_left_join
from riskweave.session import settle

MAP_LIMIT = 1000
TIER = "customer_tier"


def customer_stats(df: DataFrame) -> DataFrame:
    """Count and mean of the finite amounts per customer, summed to six decimal places."""
    amount = X.finite_or_null("amount")
    return df.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(amount).alias("customer_tx_count"),
        F.try_divide(X.exact_sum(amount), F.count(amount)).alias("customer_avg_amount"))


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes 0..k-1 of the sorted distinct texts per column: ``(column, value, code)``."""
    present = [c for c in columns if c in df.columns]
    distinct = settle(
        df.select([F.col(c).cast("string").alias(c) for c in present])
        .unpivot([], present, "column", "value")
        .filter(F.col("value").isNotNull()).distinct().withColumn("one", F.lit(1)), "codes")
    return prefix_sums(distinct, ["column"], "value", ["one"]).select(
        "column", "value", (F.col("cum_one") - 1).cast("int").alias("code"))


@dataclass
class FeatureState:
    """What training rows say: customer table, median amount, code table."""

    stats: DataFrame
    median: float
    codes: DataFrame
    hot: dict[int, int] = field(default_factory=dict)
    _maps: dict[str, dict[str, int] | None] | None = None

    @classmethod
    def fit(cls, train: DataFrame, hot_rows: int = HOT_ROWS) -> FeatureState:
        stats = settle(customer_stats(train), "customer-stats")
        n, (median,) = exact_quantiles(
            train.select(X.finite_or_null("amount").alias("amount")), ["amount"], [(1, 2)])["amount"]
        if n == 0:
            raise ValueError("no amounts to fit on")
        codes = settle(category_codes(train, (TIER, *S.CATEGORY_COLUMNS)), "category-codes")
        hot = hot_hashes(stats, ["customer_id"], "customer_tx_count", min_rows=hot_rows)
        return cls(stats, median, codes, hot)

    def maps(self) -> dict[str, dict[str, int] | None]:
        """Code maps per column; None where a map is too big for a literal."""
        if self._maps is None:
            sizes = {r[0]: r[1] for r in self.codes.groupBy("column").count().collect()}
            small = [c for c, n in sizes.items() if n <= MAP_LIMIT]
            maps: dict[str, dict[str, int] | None] = {c: None for c in sizes}
            for c in small:
                maps[c] = {}
            for r in self.codes.filter(F.col("column").isin(small)).collect():
                maps[r["column"]][r["value"]] = r["code"]
            self._maps = maps
        return self._maps

    def transform(self, df: DataFrame) -> DataFrame:
        """Model features of ``df``; batch and stream frames alike."""
        if "timestamp" not in df.columns:
            raise KeyError("timestamp is required")
        df = encode_flags(df)
        text = isinstance(df.schema["timestamp"].dataType, T.StringType)
        time = X.parse_timestamp("timestamp") if text else F.col("timestamp").cast("timestamp")
        df = df.withColumn("timestamp", time)
        if "hour_of_day" in df.columns:
            df = df.withColumnRenamed("hour_of_day", "transaction_hour")
        else:
            df = df.withColumn("transaction_hour", F.hour("timestamp"))
        if not isinstance(df.schema["amount"].dataType, T.NumericType):
            df = df.withColumn("amount", X.parse_double("amount", 0.0))
        df = df.withColumns({
            "transaction_day_of_week": X.monday_based_weekday("timestamp"),
            "is_night_transaction": X.is_night("transaction_hour"),
            "amount_log": X.amount_log("amount"),
        })
        df = self._encode(df, TIER, "segment_encoded") if TIER in df.columns else df.withColumn(
            "segment_encoded", F.lit(-1))
        df = self._with_stats(df)
        for c in S.CATEGORY_COLUMNS:
            if c in df.columns and c in self.maps():
                df = self._encode(df, c, c)
        return df.drop(*S.HIGH_CARDINALITY_COLUMNS, TIER)

    def _encode(self, df: DataFrame, column: str, into: str) -> DataFrame:
        codes = self.maps().get(column, {})
        if codes is not None:
            return df.withColumn(into, X.code_from(column, codes, -1))
        wanted = self.codes.filter(F.col("column") == column).select(
            F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = df.join(wanted, F.col(column).cast("string") == F.col("_value"), "left")
        return joined.withColumn(into, F.coalesce("_code", F.lit(-1))).drop("_value", "_code")

    def _with_stats(self, df: DataFrame) -> DataFrame:
        df = df.drop("customer_tx_count", "customer_avg_amount")
        if "customer_id" in df.columns:
            df = df.withColumn("customer_id", F.col("customer_id").cast("string"))
            df = salted_left_join(df, self.stats, ["customer_id"], self.hot)
        else:
            df = df.withColumns({"customer_tx_count": F.lit(0), "customer_avg_amount": F.lit(None).cast("double")})
        return df.withColumns({
            "customer_tx_count": F.coalesce("customer_tx_count", F.lit(0)).cast("long"),
            "customer_avg_amount": F.coalesce("customer_avg_amount", F.lit(self.median)),
        })

    def save(self, folder: str) -> None:
        """Customer table and code table as parquet, median as a one-row table."""
        spark = self.stats.sparkSession
        self.stats.write.mode("overwrite").parquet(f"{folder}/customer_stats")
        self.codes.write.mode("overwrite").parquet(f"{folder}/category_codes")
        spark.createDataFrame([(self.median,)], "amount_median_train double").write.mode(
            "overwrite").parquet(f"{folder}/amount_median")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, hot_rows: int = HOT_ROWS) -> FeatureState:
        stats = spark.read.schema(S.CUSTOMER_STATS_SCHEMA).parquet(f"{folder}/customer_stats")
        codes = spark.read.schema(S.CODES_SCHEMA).parquet(f"{folder}/category_codes")
        median = spark.read.parquet(f"{folder}/amount_median").first()[0]
        hot = hot_hashes(stats, ["customer_id"], "customer_tx_count", min_rows=hot_rows)
        return cls(stats, median, codes, hot)


def state_from_json(spark: SparkSession, folder: str, stats: str, hot_rows: int = HOT_ROWS) -> FeatureState:
    """A published state: the JSON median, tier map and category maps of ``folder`` and the customer table at ``stats``."""
    median = spark.read.text(f"{folder}/amount_median_train.json", wholetext=True).select(
        F.get_json_object("value", "$.amount_median_train").try_cast("double")).first()[0]
    if median is None:
        raise ValueError("the median file holds no number")
    table = spark.read.schema(S.CUSTOMER_STATS_SCHEMA).parquet(stats)
    codes = codes_from_json(spark, f"{folder}/segment_label_map.json", f"{folder}/categorical_maps.json")
    return FeatureState(table, median, codes, hot_hashes(table, ["customer_id"], "customer_tx_count", min_rows=hot_rows))


def codes_from_json(spark: SparkSession, tier_map: str, category_maps: str) -> DataFrame:
    """Code table from the two JSON map files; codes are taken as stored."""
    def text(path: str) -> DataFrame:
        return spark.read.text(path, wholetext=True)

    tiers = text(tier_map).select(
        F.lit(TIER).alias("column"), F.explode(F.from_json("value", "map<string,int>")).alias("value", "code"))
    nested = text(category_maps).select(
        F.explode(F.from_json("value", "map<string,map<string,int>>")).alias("column", "m"))
    return tiers.unionByName(nested.select("column", F.explode("m").alias("value", "code")))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in S.NON_FEATURE_COLUMNS]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def project_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The ordered features; an error names those that are missing."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    return df.select(*keep, *features)


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Score-time alignment: missing features become 0, extra columns go."""
    numeric = set(numeric_columns(df))
    columns = [
        (F.col(c).cast("double") if c in numeric else F.lit(0.0)).alias(c) for c in features]
    return df.select(*keep, *columns)


def unseen_customers(train: DataFrame, test: DataFrame) -> DataFrame:
    return test.select("customer_id").distinct().join(
        train.select("customer_id").distinct(), "customer_id", "left_anti")


def seen_in_both(train: DataFrame, test: DataFrame) -> DataFrame:
    return test.select("customer_id").distinct().join(
        train.select("customer_id").distinct(), "customer_id", "left_semi")


def class_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"),
    ).withColumn("scale_pos_weight", F.try_divide(F.col("negatives"), F.col("positives")))


def with_class_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Adds the row weight that balances the classes."""
    row = class_weight(df, label).first()
    if not row["positives"]:
        raise ValueError("no positive rows")
    return df.withColumn("weight", F.when(F.col(label) == 1, row["scale_pos_weight"]).otherwise(1.0))
