"""Queries of the regularised boosting: one model per application and table folder serves them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import boosting as B
from riskweave.operators import evaluate as E
from riskweave.operators import model as M
from riskweave.operators.features import numeric_columns
from riskweave.plans import prepare as P
from riskweave.plans import sql_views as V
from riskweave.plans.registry import query
from riskweave.session import settle
from riskweave.sources import adapters as A

_models: dict[tuple[str, str], B.BoostedModel] = {}


def _prepared(spark: SparkSession, sf: str) -> P.Prepared:
    return P.prepare(A.transactions(spark, sf))


def _model(spark: SparkSession, sf: str, done: P.Prepared) -> B.BoostedModel:
    """The model of this application's tables at the operator's own settings: trees on the driver, so no folder has to last."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        numbers = set(numeric_columns(done.train))
        _models[key] = B.fit_boosting(done.train, [c for c in done.features if c in numbers])
    return _models[key]


@query("boosted_rounds", "M1 M3")
def boosted_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Average precision on the held-back rows after each round, and which rounds the model keeps."""
    fitted = _model(spark, sf, _prepared(spark, sf))
    rows = [(i + 1, p, i < len(fitted.trees)) for i, p in enumerate(fitted.precision)]
    return spark.createDataFrame(rows, "round int, average_precision double, kept boolean")


@query("boosted_gain", "M1 M10 O2")
def boosted_gain(spark: SparkSession, sf: str) -> DataFrame:
    fitted = _model(spark, sf, _prepared(spark, sf))
    return B.gain_importance(fitted.node_table(spark), fitted.features)


@query("boosted_scores", "M1 M9")
def boosted_scores(spark: SparkSession, sf: str) -> DataFrame:
    done = _prepared(spark, sf)
    scored = _model(spark, sf, done).score(done.test, ["transaction_id"])
    return E.score_bands(scored, 0.5).select("transaction_id", "fraud_score", "is_fraud_pred", "risk_level")


@query("boosted_evaluation", "M1 M5 M6 M7")
def boosted_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """The report per segment at the threshold that the scores choose."""
    done = _prepared(spark, sf)
    scored = settle(_model(spark, sf, done).score(done.test, ["segment_encoded", "is_fraud"]).select(
        F.col("segment_encoded").alias("segment"), F.col("is_fraud").alias("label"), "score"), "scored")
    threshold = E.best_threshold(scored).first()["threshold"]
    return E.named_segments(E.segment_report(scored, threshold), done.state.codes)


@query("boosted_checks", "M1 M9 M10 M11", f"""WITH {V.TX}, {V.parts("tx")}
SELECT 'scored_rows' AS "check", count(*) AS value FROM parts WHERE part = 'test'
UNION ALL SELECT 'fraud_rows', count(*) FROM parts WHERE part = 'test' AND is_fraud = 1
UNION ALL SELECT unnest(['scores_out_of_range', 'rounds_better_than_the_kept', 'splits_below_the_least_gain', 'children_below_the_least_weight',
  'nodes_below_the_depth', 'features_not_permuted']), 0""")
def boosted_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of any fitted ensemble, as counts."""
    done = _prepared(spark, sf)
    fitted = _model(spark, sf, done)
    scored = fitted.score(done.test, ["is_fraud"]).agg(
        F.count(F.lit(1)).alias("scored_rows"), F.count_if(F.col("is_fraud") == 1).alias("fraud_rows"),
        F.count_if(~F.col("score").between(0, 1)).alias("scores_out_of_range"))
    nodes = fitted.node_table(spark)
    parents = nodes.filter("left >= 0")
    children = parents.select("tree", F.explode(F.array("left", "right")).alias("node")).join(nodes, ["tree", "node"])
    s = B.Settings()
    last = parents.filter("gain < %r" % s.gamma).join(children.filter("left >= 0").select("tree").distinct(), "tree", "left_anti")
    moved = M.permutation_importance(fitted, done.test).agg((F.lit(len(fitted.features)) - F.count("importance")).alias("features_not_permuted"))
    best = fitted.precision[len(fitted.trees) - 1]
    counted = spark.createDataFrame([(sum(p > best for p in fitted.precision), sum(_depth(t) > s.depth for t in fitted.trees))],
                                    "rounds_better_than_the_kept long, nodes_below_the_depth long")
    out = None
    for wide in (scored, counted, moved, last.agg(F.count(F.lit(1)).alias("splits_below_the_least_gain")),
                 children.agg(F.count_if(F.col("cover") < s.least_weight).alias("children_below_the_least_weight"))):
        part = wide.select([F.col(c).cast("long").alias(c) for c in wide.columns]).unpivot([], wide.columns, "check", "value")
        out = part if out is None else out.unionByName(part)
    return out


def _depth(tree: B.Tree, node: int = 0) -> int:
    return 0 if tree.feature[node] < 0 else 1 + max(_depth(tree, tree.left[node]), _depth(tree, tree.right[node]))
