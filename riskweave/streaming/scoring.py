"""Stream scoring with the same transform as batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators import evaluate as E
from riskweave.operators.features import FeatureState
from riskweave.operators.quality import split_valid
from riskweave.session import scratch_path
from riskweave.streaming.requests import run_available

def drop_repeats(
    requests: DataFrame, late: str, time: str = "timestamp", row_id: str = "transaction_id",
) -> DataFrame:
    """Repeated requests within the lateness bound count once.

    Requests later than the bound are left out, so ``late`` must cover the
    disorder of the source.
    """
    return requests.withWatermark(time, late).dropDuplicatesWithinWatermark([row_id])


def score_stream(
    requests: DataFrame, state: FeatureState, score: Callable[[DataFrame], DataFrame], threshold: float,
    late: str | None = None,
) -> DataFrame:
    """Valid requests with features, score, decision and band.

    ``score`` adds the column ``score`` to the transformed rows. Every request
    is scored; with a lateness bound repeated ones count once.
    """
    valid, _ = split_valid(requests)
    if late is not None:
        valid = drop_repeats(valid, late)
    return E.score_bands(score(state.transform(valid)), threshold)


def write_scores(scored: DataFrame, label: str = "scores") -> DataFrame:
    """Runs the stream into a parquet table and returns the table."""
    spark, out = scored.sparkSession, scratch_path(scored.sparkSession, label)
    schema = scored.schema
    run_available(scored.writeStream.format("parquet").option("path", out), label)
    return spark.read.schema(schema).parquet(out)


def quarantine_stream(requests: DataFrame) -> DataFrame:
    return split_valid(requests)[1].withColumn("n_errors", F.size("errors"))
