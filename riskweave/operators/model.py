"""Boosted-tree training, scoring and explanations on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.operators import evaluate as E
from riskweave.operators.features import align_features, project_features, with_class_weight
from riskweave.operators.rank import exact_quantiles
from riskweave.operators.split import find_cut
from riskweave.session import settle

# --- fixed values: boosting settings -------------------------------------------
BOOSTING = {
    "maxIter": 1000, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5, "seed": 42,
}
# --- end of fixed values ---------------------------------------------------------


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vector; the trees take no missing values, so these count as 0."""
    filled = df.fillna(0.0, list(features))
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(filled)


@dataclass
class RiskModel:
    """A fitted classifier and the feature order it was fitted on."""

    model: GBTClassificationModel
    features: list[str]

    def score(self, df: DataFrame, keep: Sequence[str] = (), column: str = "score") -> DataFrame:
        """``keep`` columns and the positive-class probability; works on streams."""
        kept = df.select(*[F.col(c).alias(f"_keep_{c}") for c in keep], *df.columns)
        aligned = align_features(kept, self.features, [f"_keep_{c}" for c in keep])
        out = self.model.transform(assemble(aligned, self.features))
        return out.select(*[F.col(f"_keep_{c}").alias(c) for c in keep],
                          vector_to_array("probability")[1].alias(column))

    def save(self, folder: str) -> None:
        self.model.write().overwrite().save(f"{folder}/model")
        self.model_features().write.mode("overwrite").parquet(f"{folder}/model_features")

    def model_features(self) -> DataFrame:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame(list(enumerate(self.features)), "position int, feature string")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> RiskModel:
        names = spark.read.parquet(f"{folder}/model_features").orderBy("position").collect()
        return cls(GBTClassificationModel.load(f"{folder}/model"), [r["feature"] for r in names])


def train_model(
    train: DataFrame, features: Sequence[str], label: str = "is_fraud", time: str = "timestamp",
    row_id: str = "transaction_id", validation: float = 0.2, **settings,
) -> RiskModel:
    """Weighted boosting with early stopping on the latest ``validation`` share of ``train``."""
    chosen = {**BOOSTING, **settings}
    cut = find_cut(train, 1 - validation, time, row_id)
    weighted = with_class_weight(train.withColumn("_late", cut.later(time, row_id)), label)
    project_features(weighted, list(features))  # names the features that are missing
    narrow = align_features(weighted, features, [label, "weight", "_late"])
    ready = settle(assemble(narrow, features).select("_features", label, "weight", "_late"), "training")
    booster = GBTClassifier(
        featuresCol="_features", labelCol=label, weightCol="weight", validationIndicatorCol="_late", **chosen)
    return RiskModel(booster.fit(ready), list(features))


def feature_importance(fitted: RiskModel, features: Sequence[str] | None = None, top_n: int = 35) -> DataFrame:
    """Importances, largest first; asked-for features the model lacks get 0."""
    weights = dict(zip(fitted.features, (float(v) for v in fitted.model.featureImportances.toArray())))
    rows = [(f, weights.get(f, 0.0)) for f in (features or fitted.features)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(top_n)


def permutation_importance(
    fitted: RiskModel, df: DataFrame, label: str = "is_fraud", row_id: str = "transaction_id",
) -> DataFrame:
    """Loss of average precision when one feature's values move to other rows.

    All rows stand in one ring, in the order of a hash of their id; every value
    moves to the next row of the ring, all features in one shuffle. The ring is
    cut at the hash's first 16 bits: a piece's last row takes the first one of
    the next piece, so the cuts have no influence on the result.
    """
    feats = fitted.features
    base = align_features(df.withColumn("_y", F.col(label)).withColumn("_id", F.col(row_id)), feats, ["_y", "_id"])
    values = F.struct(*feats)
    ring = settle(base.withColumn("_hash", F.xxhash64("_id", F.lit(7))).withColumn("_block", F.shiftright("_hash", 48)), "ring")
    blocks = Window.partitionBy(F.lit(0)).orderBy("_block")
    # at most 65,536 rows
    entries = ring.groupBy("_block").agg(F.min_by(values, F.struct("_hash", "_id")).alias("_first"))
    entries = entries.select("_block", F.coalesce(F.lead("_first").over(blocks), F.first("_first").over(
        blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_entry"))
    inside = Window.partitionBy("_block").orderBy("_hash", "_id")
    moved = ring.withColumn("_next", F.lead(values).over(inside)).join(entries, "_block").withColumn(
        "_next", F.coalesce("_next", "_entry")).drop("_entry", "_hash", "_block")
    variants = settle(moved, "permuted").withColumn("variant", F.explode(F.lit(["", *feats])))
    swapped = variants.select("variant", "_y", *[
        F.when(F.col("variant") == f, F.col("_next")[f]).otherwise(F.col(f)).alias(f) for f in feats])
    scored = fitted.score(swapped, ["variant", "_y"])
    areas = E.curve_metrics(scored, ["variant"], "score", "_y").select("variant", "average_precision")
    areas = settle(areas, "permuted-areas")
    full = areas.filter("variant = ''").first()["average_precision"]
    return areas.filter("variant <> ''").select(
        F.col("variant").alias("feature"), (F.lit(full) - F.col("average_precision")).alias("importance"))


def explain_top_row(
    fitted: RiskModel, df: DataFrame, reference: DataFrame, row_id: str = "transaction_id",
) -> DataFrame:
    """Change of the highest score when one feature takes the reference median."""
    feats = fitted.features
    best = E.top_row(fitted.score(df, [row_id]), "score", row_id).first()
    row = align_features(df.filter(F.col(row_id) == best[row_id]).limit(1), feats)
    medians = {c: (v[0] if n else 0.0) for c, (n, v) in exact_quantiles(
        align_features(reference, feats), feats, [(1, 2)]).items()}
    variants = row.withColumn("variant", F.explode(F.lit(feats)))
    replaced = variants.select("variant", *[
        F.when(F.col("variant") == f, F.lit(medians[f])).otherwise(F.col(f)).alias(f) for f in feats])
    return fitted.score(replaced, ["variant"]).select(
        F.lit(best[row_id]).alias(row_id), F.col("variant").alias("feature"),
        (F.lit(best["score"]) - F.col("score")).alias("contribution"))


def predict(fitted: RiskModel, state, df: DataFrame, threshold: float, row_id: str = "transaction_id") -> DataFrame:
    """Batch scoring: transform, align, probability, decision and band per row."""
    features = state.transform(df)
    return E.score_bands(fitted.score(features, [row_id]), threshold).select(
        row_id, "fraud_score", "is_fraud_pred", "risk_level", F.lit(round(threshold, 4)).alias("threshold"))
