"""Imputation, flag encoding and keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.functions import scalars as X


def _fill(df: DataFrame, c: str) -> Column:
    if c == "os":
        return F.coalesce(F.col(c), F.lit("UNKNOWN"))
    if c == "is_3d_secure" and isinstance(df.schema[c].dataType, T.StringType):
        return F.coalesce(F.col(c), F.lit("N"))
    if c in S.BEHAVIOUR_COLUMNS and isinstance(df.schema[c].dataType, T.NumericType):
        return F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
    return F.col(c)


def impute(df: DataFrame) -> DataFrame:
    return df.select([_fill(df, c).alias(c) for c in df.columns])


def imputation_report(df: DataFrame) -> DataFrame:
    """Nulls before, after and resolved, from one pass over ``df``."""
    both = df.select(
        *[F.col(c).alias(f"b_{c}") for c in df.columns],
        *[_fill(df, c).alias(f"a_{c}") for c in df.columns])
    counts = both.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in both.columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"b_{c}").alias("nulls_before"),
                 F.col(f"a_{c}").alias("nulls_after")) for c in df.columns])
    return (
        counts.select(F.explode(rows).alias("s")).select("s.*")
        .withColumn("resolved", F.col("nulls_before") - F.col("nulls_after"))
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``.

    The limit of one row is applied before the shuffle as well, so copies of a
    hot key do not travel.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def encode_flags(df: DataFrame) -> DataFrame:
    """Y/N and status texts to 1/0; numeric columns are taken as encoded."""
    rules = {"cvv_match": X.flag, "is_3d_secure": X.flag, "transaction_status": X.status}
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: rule(c) for c, rule in rules.items() if c in text})


def clean(df: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Impute, keep the first row per transaction, encode flags, null label -> 0."""
    tie_break = [c for c in df.columns if c not in order and c != "transaction_id"]
    out = keep_first(impute(df), ["transaction_id"], [*order, *tie_break])
    out = encode_flags(out)
    if "is_fraud" in out.columns:
        out = out.withColumn("is_fraud", F.coalesce(F.col("is_fraud").cast("int"), F.lit(0)))
    return out


def clean_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and label rate on both sides of ``clean``."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("n_rows"),
                      (F.avg("is_fraud") * 100).alias("fraud_rate_pct"))

    return side(before, "before").unionByName(side(after, "after"))
