"""Stream scoring with a stored model; a newly published one is taken up between micro-batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.features import FeatureState
from riskweave.operators.model import RiskModel, predict
from riskweave.operators.quality import split_valid
from riskweave.sources.tables import read_if_there

MODEL_MISSING = "model_unavailable"


@dataclass
class Published:
    version: int
    model: RiskModel
    state: FeatureState
    threshold: float


class ModelStore:
    """Versions of model, feature state and threshold in one folder.

    A version counts once its row in ``published`` is written, which is the
    last thing ``publish`` does: a reader never meets half a version. One
    writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def publish(self, model: RiskModel, state: FeatureState, threshold: float) -> int:
        version = (self.latest() or 0) + 1
        model.save(f"{self.folder}/versions/{version}/model")
        state.save(f"{self.folder}/versions/{version}/state")
        self.spark.createDataFrame([(version, float(threshold))], "version int, threshold double").coalesce(1).write.mode(
            "append").parquet(f"{self.folder}/published")
        return version

    def latest(self) -> int | None:
        rows = read_if_there(self.spark, f"{self.folder}/published")
        return None if rows is None else rows.agg(F.max("version")).first()[0]

    def load(self, version: int) -> Published:
        row = self.spark.read.parquet(f"{self.folder}/published").filter(F.col("version") == version).first()
        if row is None:
            raise ValueError(f"version {version} is not published")
        base = f"{self.folder}/versions/{version}"
        return Published(version, RiskModel.load(self.spark, f"{base}/model"),
                         FeatureState.load(self.spark, f"{base}/state"), row["threshold"])


class ModelScorer:
    """Scores each micro-batch with the newest published version, as ``operators.model.predict`` does.

    The version is looked up once a batch, so all rows of a batch have one
    version, which is in its rows. Before the first version, or with requests
    that break the rules, nothing is scored: such rows are kept with their
    ``errors``. A repeated batch overwrites its own folder as a whole.
    """

    def __init__(self, store: ModelStore, folder: str, row_id: str = "transaction_id"):
        self.store, self.folder, self.row_id = store, folder.rstrip("/"), row_id
        self.current: Published | None = None

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        newest = self.store.latest()
        if newest is not None and (self.current is None or self.current.version != newest):
            self.current = self.store.load(newest)
        valid, faulty = split_valid(batch)
        faulty = faulty.select(F.col(self.row_id).cast("string").alias(self.row_id), "errors")
        if self.current is None:
            waiting = valid.select(F.col(self.row_id).cast("string").alias(self.row_id), F.array(F.lit(MODEL_MISSING)).alias("errors"))
            faulty = faulty.unionByName(waiting)
        else:
            c = self.current
            scored = predict(c.model, c.state, valid, c.threshold, self.row_id)
            scored.withColumn("model_version", F.lit(c.version)).write.mode("overwrite").parquet(f"{self.folder}/scores/batch={batch_id}")
        faulty.write.mode("overwrite").parquet(f"{self.folder}/unscored/batch={batch_id}")

    def scores(self) -> DataFrame | None:
        return read_if_there(self.store.spark, f"{self.folder}/scores")

    def unscored(self) -> DataFrame | None:
        return read_if_there(self.store.spark, f"{self.folder}/unscored")
