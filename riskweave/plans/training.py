"""Training and evaluation: fit once, score once, report from the scored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators import evaluate as E
from riskweave.operators import features as FX
from riskweave.operators import model as M
from riskweave.plans.prepare import Prepared
from riskweave.session import settle
from riskweave.sources import tables


@dataclass
class Evaluated:
    model: M.RiskModel
    scored: DataFrame
    threshold: float
    report: DataFrame
    segments: DataFrame


def train_and_evaluate(done: Prepared, folder: str | None = None, **settings) -> Evaluated:
    numeric = set(FX.numeric_columns(done.train))
    features = [c for c in done.features if c in numeric]
    fitted = M.train_model(done.train, features, **settings)
    scored = settle(fitted.score(done.test, ["transaction_id", "segment_encoded", "is_fraud"]).select(
        "transaction_id", F.col("segment_encoded").alias("segment"), F.col("is_fraud").alias("label"), "score"),
        "scored")
    best = E.best_threshold(scored).first()
    # reports and scoring use the threshold as published, to four places
    threshold = best["threshold_4dp"]
    report = E.metric_report(scored, threshold)
    segments = E.named_segments(E.segment_report(scored, threshold), done.state.codes)
    if folder:
        fitted.save(folder)
        tables.write_reports(folder, report, segments, M.feature_importance(fitted))
    return Evaluated(fitted, scored, threshold, report, segments)
