"""Batch preparation: validate, clean, split, fit on train, transform both parts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators import clean, quality
from riskweave.operators.features import FeatureState, feature_columns
from riskweave.operators.split import chrono_split
from riskweave.session import settle
from riskweave.sources import tables


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    state: FeatureState
    features: list[str]


def prepare(raw: DataFrame, ratio: float = 0.8, check: bool = True) -> Prepared:
    """The cleaned rows are written once; split, fit and transform read them."""
    if check:
        quality.validate(raw)
    cleaned = settle(clean.clean(raw), "cleaned")
    train, test = chrono_split(cleaned, ratio)
    state = FeatureState.fit(train)
    train_x, test_x = state.transform(train), state.transform(test)
    return Prepared(train_x, test_x, state, feature_columns(train_x))


def run_preparation(raw: DataFrame, folder: str, ratio: float = 0.8) -> Prepared:
    """``prepare`` plus all files: both parts, feature list and feature state."""
    done = prepare(raw, ratio)
    tables.write_split(done.train, done.test, folder)
    tables.write_feature_list(raw.sparkSession, done.features, folder)
    done.state.save(folder)
    return done


def tier_summary(features: DataFrame) -> DataFrame:
    """Transformed rows per tier code."""
    return features.groupBy("segment_encoded").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("is_fraud").alias("n_fraud"),
        F.sum("is_night_transaction").alias("n_night"),
        F.count_if(F.col("customer_tx_count") == 0).alias("n_unseen"),
        F.avg("amount_log").alias("avg_amount_log"),
        F.avg("customer_avg_amount").alias("avg_customer_amount"))
