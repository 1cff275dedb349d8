"""Readers and writers of transaction files, feature lists and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators.drift import sample_rows

KEYS = ("transaction_id", "customer_id")


def _typed(name: str, kind: T.DataType) -> Column:
    # "N/A" in a flag is null like elsewhere and encodes to 0 either way
    text = F.when(~F.col(name).isin(*S.NA_TOKENS), F.col(name))
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.TimestampType):
        return X.parse_timestamp(text)
    number = X.finite_or_null(X.parse_double(text))
    return number if isinstance(kind, T.DoubleType) else F.when(number == F.rint(number), number.try_cast(kind))


def read_transactions_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                          multi_line: bool = True) -> DataFrame:
    """Typed CSV scan; unreadable cells and missing-value texts become null.

    ``columns`` is the header's order; by default the header line is read once.
    Quotes in quoted cells are doubled. Cells may hold line breaks; files known
    to have none are split over tasks with ``multi_line`` off.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if columns is None:
        columns = reader.csv(path).columns
    raw = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path)
    kinds = {f.name: f.dataType for f in S.TRANSACTION_SCHEMA}
    return raw.select([_typed(c, kinds.get(c, T.StringType())).alias(c) for c in columns])


def write_transactions_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def write_split(train: DataFrame, test: DataFrame, folder: str) -> None:
    train.write.mode("overwrite").parquet(f"{folder}/train.parquet")
    test.write.mode("overwrite").parquet(f"{folder}/test.parquet")


def read_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{folder}/train.parquet"), spark.read.parquet(f"{folder}/test.parquet")


def write_feature_list(spark: SparkSession, features: Sequence[str], folder: str, target: str = "is_fraud") -> None:
    spark.range(1).select(
        F.lit(target).alias("target"), F.lit(list(features)).alias("features"),
        F.lit(len(features)).alias("feature_count"), F.current_timestamp().alias("created_at"),
    ).write.mode("overwrite").json(f"{folder}/features.json")


def read_feature_list(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(
        "target string, features array<string>, feature_count int, created_at timestamp"
    ).option("multiLine", True).json(f"{folder}/features.json")


def write_reports(folder: str, metrics: DataFrame, segments: DataFrame, importance: DataFrame | None = None) -> None:
    """Metric report as JSON, tables as CSV with a header."""
    metrics.write.mode("overwrite").json(f"{folder}/evaluation.json")
    segments.write.mode("overwrite").option("header", True).csv(f"{folder}/segment_report.csv")
    if importance is not None:
        importance.write.mode("overwrite").option("header", True).csv(f"{folder}/feature_importance.csv")


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise       # a damaged file is not an absent one
        return None


def ensure_drift_reference(
    spark: SparkSession, folder: str, key: Column, row_id: str, n: int = S.DRIFT_REFERENCE_ROWS,
) -> DataFrame | None:
    """Stored drift reference; made from the training rows when absent."""
    path = f"{folder}/drift_reference.parquet"
    stored = read_if_there(spark, path)
    if stored is not None:
        return stored
    train = read_if_there(spark, f"{folder}/train.parquet")
    if train is None or train.isEmpty():
        return None
    sample_rows(train, key, row_id, n).write.parquet(path)
    return spark.read.parquet(path)


def preferred_reference(spark: SparkSession, folder: str) -> tuple[str, DataFrame | None]:
    """``(mode, frame)``: stored reference, else training rows, else warm-up."""
    for name in ("drift_reference", "train"):
        df = read_if_there(spark, f"{folder}/{name}.parquet")
        if df is not None:
            return S.MODE_TRAIN, df
    return S.MODE_WARMUP, None
