"""Queries that train a model; their results have no SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import evaluate as E
from riskweave.operators import model as M
from riskweave.operators import split as SP
from riskweave.operators.features import FeatureState, feature_columns, numeric_columns
from riskweave.plans import prepare as P
from riskweave.plans import sql_views as V
from riskweave.plans import training as TR
from riskweave.plans.registry import query
from riskweave.session import scratch_path, settle
from riskweave.sources import adapters as A

# a short boosting run over all rows and features: the default of the operator is 1000 rounds of depth 6,
# each of them several Spark jobs; such a run has not been measured here
SHORT = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.3}


def _fitted(spark: SparkSession, sf: str) -> tuple[P.Prepared, M.RiskModel]:
    done = P.prepare(A.transactions(spark, sf))
    return done, M.train_model(done.train, _numeric(done.train, done.features), **SHORT)


def _numeric(df: DataFrame, features: list[str]) -> list[str]:
    numbers = set(numeric_columns(df))
    return [c for c in features if c in numbers]


@query("gbt_evaluation", "M1 M5 M6 M7 S6")
def gbt_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    done = P.prepare(A.transactions(spark, sf))
    return TR.train_and_evaluate(done, scratch_path(spark, "model"), **SHORT).segments


@query("gbt_importance", "M10 O2")
def gbt_importance(spark: SparkSession, sf: str) -> DataFrame:
    return M.feature_importance(_fitted(spark, sf)[1])


@query("gbt_scores", "M9 M1")
def gbt_scores(spark: SparkSession, sf: str) -> DataFrame:
    train, test = SP.chrono_split(settle(A.transactions(spark, sf), "transactions"))
    state = FeatureState.fit(train)
    rows = state.transform(train)
    fitted = M.train_model(rows, _numeric(rows, feature_columns(rows)), **SHORT)
    return M.predict(fitted, state, test, 0.5)


@query("model_checks", "M1 M5 M6 M9 M10 M11 O2 O3", f"""WITH {V.TX}, {V.parts("tx")}
SELECT 'scored_rows' AS "check", count(*) AS value FROM parts WHERE part = 'test'
UNION ALL SELECT 'segment_rows', count(*) FROM parts WHERE part = 'test'
UNION ALL SELECT 'fraud_rows', count(*) FROM parts WHERE part = 'test' AND is_fraud = 1
UNION ALL SELECT unnest(['scores_out_of_range', 'decisions_wrong', 'bands_wrong', 'importances_below_zero',
  'features_without_importance', 'features_not_permuted', 'rows_above_the_top_row']), 0
UNION ALL SELECT 'importance_millionths', 1000000""")
def model_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of any fitted model, as counts."""
    done, fitted = _fitted(spark, sf)
    scored = settle(fitted.score(done.test, ["transaction_id", "segment_encoded", "is_fraud"]), "scored")
    band = F.when(F.col("score") < 0.30, "LOW").when(F.col("score") < 0.60, "MEDIUM").otherwise("HIGH")
    rows = E.score_bands(scored.select("transaction_id", "score"), 0.5).agg(
        F.count(F.lit(1)).alias("scored_rows"), F.count_if(~F.col("score").between(0, 1)).alias("scores_out_of_range"),
        F.count_if(F.col("is_fraud_pred") != (F.col("score") >= 0.5).cast("int")).alias("decisions_wrong"),
        F.count_if(F.col("risk_level") != band).alias("bands_wrong"))
    labelled = scored.select(F.col("segment_encoded").alias("segment"), F.col("is_fraud").alias("label"), "score")
    segments = E.segment_report(labelled, 0.5)
    sums = segments.agg(F.sum(F.when(F.col("segment") != E.ALL, F.col("n_samples"))).alias("segment_rows"),
                        F.sum(F.when(F.col("segment") == E.ALL, F.col("n_fraud"))).alias("fraud_rows"))
    weights = M.feature_importance(fitted, top_n=len(fitted.features)).agg(
        F.count_if(F.col("importance") < 0).alias("importances_below_zero"),
        (F.lit(len(fitted.features)) - F.count(F.lit(1))).alias("features_without_importance"),
        F.round(F.sum("importance") * 1e6).cast("long").alias("importance_millionths"))
    moved = M.permutation_importance(fitted, done.test).agg(
        (F.lit(len(fitted.features)) - F.count("importance")).alias("features_not_permuted"))
    top = E.top_row(scored, "score", "transaction_id").first()["score"]
    above = scored.agg(F.count_if(F.col("score") > F.lit(top)).alias("rows_above_the_top_row"))
    out = None
    for wide in (rows, sums, weights, moved, above):
        part = wide.select([F.col(c).cast("long").alias(c) for c in wide.columns]).unpivot([], wide.columns, "check", "value")
        out = part if out is None else out.unionByName(part)
    return out


@query("permutation_importance", "M11")
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    done, fitted = _fitted(spark, sf)
    return M.permutation_importance(fitted, done.test)


@query("explain_top_row", "M11 O3")
def explain_top_row(spark: SparkSession, sf: str) -> DataFrame:
    done, fitted = _fitted(spark, sf)
    return M.explain_top_row(fitted, done.test, done.train)
