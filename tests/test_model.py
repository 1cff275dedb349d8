import pytest
from pyspark.sql import functions as F

from riskweave.operators import evaluate as E
from riskweave.operators import model as M
from riskweave.operators.features import FeatureState
from riskweave.operators.quality import split_valid
from riskweave.plans import training as TR
from riskweave.plans.prepare import prepare
from riskweave.sources import adapters as A
from riskweave.sources import tables as TB
from riskweave.streaming import model_scoring as MS
from riskweave.streaming import requests as SR

SF = "/root/testdata/sf0.001"
SHORT = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3}


@pytest.fixture(scope="module")
def fitted(spark):
    done = prepare(A.transactions(spark, SF))
    return done, M.train_model(done.train, ["amount", "merchant_category", "device_type"], **SHORT)


def test_model_ranks_the_positives(fitted):
    done, model = fitted
    scored = model.score(done.test, ["is_fraud"])
    means = {r["is_fraud"]: r["m"] for r in scored.groupBy("is_fraud").agg(F.avg("score").alias("m")).collect()}
    assert means[1] > means[0] + 0.3


def test_importances(fitted):
    _, model = fitted
    rows = M.feature_importance(model, ["amount", "merchant_category", "absent"], top_n=2).collect()
    assert len(rows) == 2 and rows[0]["importance"] >= rows[1]["importance"] > 0
    everything = {r["feature"]: r["importance"] for r in M.feature_importance(model, ["absent"]).collect()}
    assert everything == {"absent": 0.0}


def test_permutation_and_contribution(fitted):
    done, model = fitted
    lost = {r["feature"]: r["importance"] for r in M.permutation_importance(model, done.test).collect()}
    assert lost["merchant_category"] > 0.2 and abs(lost["device_type"]) < 0.2
    parts = {r["feature"]: r["contribution"] for r in M.explain_top_row(model, done.test, done.train).collect()}
    assert set(parts) == set(model.features) and max(parts.values()) > 0


def test_training_evaluation_files_and_batch_scoring(spark, fitted, tmp_path):
    done, _ = fitted
    result = TR.train_and_evaluate(done, str(tmp_path), **SHORT)
    assert result.report.first()["average_precision"] > 0.9
    assert {"ALL"} < {r["segment"] for r in result.segments.collect()}
    assert spark.read.json(str(tmp_path / "evaluation.json")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "feature_importance.csv")).count() > 0
    back = M.RiskModel.load(spark, str(tmp_path))
    assert back.features == result.model.features
    raw = A.transactions(spark, SF)
    state = FeatureState.fit(raw)
    rows = M.predict(back, state, raw, result.threshold).limit(50).collect()
    assert all(0 <= r["fraud_score"] <= 1 and r["risk_level"] in ("LOW", "MEDIUM", "HIGH") for r in rows)
    one = M.predict(back, state, raw.limit(1), result.threshold)
    assert one.count() == 1


def test_no_positives_is_an_error(fitted):
    done, _ = fitted
    with pytest.raises(ValueError, match="no positive"):
        M.train_model(done.train.withColumn("is_fraud", F.lit(0)), ["amount"], **SHORT)


def test_drift_reference_files(spark, tmp_path):
    folder = str(tmp_path)
    assert TB.preferred_reference(spark, folder) == ("warmup_window", None)
    assert TB.ensure_drift_reference(spark, folder, F.xxhash64("i"), "i") is None
    df = spark.range(250).select(F.col("id").alias("i"), (F.col("id") % 24).alias("hour"), (F.col("id") % 2).alias("is_fraud"))
    TB.write_split(df, df, folder)
    assert TB.preferred_reference(spark, folder)[0] == "train_parquet"
    first = TB.ensure_drift_reference(spark, folder, F.xxhash64("i"), "i", 50)
    assert first.count() == 50 and first.columns == df.columns
    again = TB.ensure_drift_reference(spark, folder, F.xxhash64("i"), "i", 10)
    assert again.count() == 50
    assert TB.preferred_reference(spark, folder)[0] == "train_parquet"


def test_stream_takes_up_a_published_model_between_batches(spark, fitted, tmp_path):
    _, model = fitted
    raw = A.transactions(spark, SF).withColumn("part", F.pmod(F.col("transaction_id").cast("long"), F.lit(3)).cast("int"))
    states = [FeatureState.fit(raw.filter("part = 0")), FeatureState.fit(raw)]
    store, folder = MS.ModelStore(spark, str(tmp_path / "models")), tmp_path / "rows"

    def run(part, scorer):
        raw.filter(F.col("part") == part).drop("part").coalesce(1).write.parquet(str(folder / f"p{part}"))
        feed = spark.readStream.schema(raw.drop("part").schema).option("recursiveFileLookup", True).parquet(str(folder))
        SR.run_available(feed.writeStream.foreachBatch(scorer.on_batch), "scores", checkpoint=str(tmp_path / "offsets"))

    scorer = MS.ModelScorer(store, str(tmp_path / "out"))
    run(0, scorer)
    assert scorer.scores() is None and scorer.unscored().count() == raw.filter("part = 0").count()
    assert store.publish(model, states[0], 0.4) == 1
    run(1, scorer)
    assert store.publish(model, states[1], 0.7) == 2
    again = MS.ModelScorer(store, str(tmp_path / "out"))        # a new driver
    run(2, again)
    again.on_batch(raw.filter("part = 2").drop("part"), 2)      # and a repeated batch
    got = again.scores()
    for part, (state, threshold) in ((1, (states[0], 0.4)), (2, (states[1], 0.7))):
        valid = split_valid(raw.filter(F.col("part") == part).drop("part"))[0]
        want = M.predict(model, state, valid, threshold)
        mine = got.filter(F.col("model_version") == part).select(want.columns)
        assert sorted(map(str, mine.collect())) == sorted(map(str, want.collect()))
    faulty = again.unscored().filter("batch > 0")
    assert got.count() + faulty.count() == raw.filter("part > 0").count()
    with pytest.raises(ValueError, match="version 9"):
        store.load(9)


def test_permutation_equals_one_ring_over_all_rows(spark, fitted):
    done, model = fitted
    rows = done.test.select("transaction_id", "is_fraud", *model.features)
    ring = rows.withColumn("h", F.xxhash64("transaction_id", F.lit(7))).toPandas().sort_values(["h", "transaction_id"]).reset_index(drop=True)

    def precision(pdf):
        df = spark.createDataFrame(pdf.drop(columns="h"))
        return E.curve_metrics(model.score(df, ["is_fraud"]), [], "score", "is_fraud").first()["average_precision"]

    full = precision(ring)
    for parts in (1, 7):
        got = {r["feature"]: r["importance"] for r in M.permutation_importance(model, done.test.repartition(parts)).collect()}
        for feature in model.features:
            moved = ring.copy()
            moved[feature] = list(ring[feature][1:]) + [ring[feature][0]]
            assert got[feature] == pytest.approx(full - precision(moved), abs=1e-9), (parts, feature)
