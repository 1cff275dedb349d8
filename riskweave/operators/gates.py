"""Newest-row lookups and quality gates over keyed history tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import scalars as X
from riskweave.operators.rank import top_per_group


def latest_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str,
                     exclude: DataFrame | None = None, on: str | None = None) -> DataFrame:
    """Value of the newest row per group, rows listed in ``exclude`` left out."""
    if exclude is not None:
        df = df.join(exclude, on, "left_anti")
    return df.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias(value))


def latest_measured(history: DataFrame, series: str, order: Sequence[str], metric: str, newest: int = 25) -> DataFrame:
    """Per series the newest non-null metric among its ``newest`` rows."""
    recent = top_per_group(history, [series], [F.desc(c) for c in order], newest)
    return recent.filter(F.col(metric).isNotNull()).groupBy(series).agg(
        F.max_by(metric, F.struct(*order)).alias(metric))


def quality_gate(series_list: DataFrame, latest: DataFrame, series: str, metric: str, threshold: float) -> DataFrame:
    """``retrain`` is 1 where the newest metric is too low or missing."""
    limit = X.as_fraction(F.lit(float(threshold)))
    return series_list.join(latest, series, "left").withColumn(
        "retrain", F.coalesce(F.col(metric) < limit, F.lit(True)).cast("int"))
