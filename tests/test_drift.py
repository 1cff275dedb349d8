import numpy as np
import pytest
from data import numbers
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import drift as D


def _score(spark, ref, cur):
    rows = D.drift_scores(numbers(spark, ref), numbers(spark, cur)).collect()
    return (rows[0]["kind"], rows[0]["score"]) if rows else None


def _numpy_psi(ref, cur):
    edges = np.unique(np.quantile(ref, np.arange(11) / 10))
    inner = edges[1:-1]
    p = np.bincount(np.searchsorted(inner, ref, side="right"), minlength=len(inner) + 1) / len(ref)
    q = np.bincount(np.searchsorted(inner, cur, side="right"), minlength=len(inner) + 1) / len(cur)
    p, q = np.maximum(p, 1e-6), np.maximum(q, 1e-6)
    return min(max(float(((q - p) * np.log(q / p)).sum()), 0.0), 1.0)


@pytest.mark.parametrize("ref,cur,want", [
    ([0, 0, 1, 1], [0, 0, 1, 1], 0.0), ([0, 0, 1, 1], [2, 2, 3, 3], 1.0), ([0, 0, 1, 1], [0, 1, 1, 1], 0.25)])
def test_categories(spark, ref, cur, want):
    assert _score(spark, [float(v) for v in ref], [float(v) for v in cur]) == ("categorical", pytest.approx(want))


def test_twelve_whole_numbers_are_categories_thirteen_are_not(spark):
    twelve, thirteen = [float(i % 12) for i in range(60)], [float(i % 13) for i in range(65)]
    assert _score(spark, twelve, twelve)[0] == "categorical"
    assert _score(spark, thirteen, thirteen) == ("psi", 0.0)
    shifted = [float(i % 13 // 2) for i in range(65)]
    kind, score = _score(spark, thirteen, shifted)
    assert kind == "psi" and score == pytest.approx(_numpy_psi(thirteen, shifted))


def test_big_fractions_count_as_whole(spark):
    assert _score(spark, [100000.4, 200000.0] * 5, [100000.4, 200000.0] * 5)[0] == "categorical"
    assert _score(spark, [0.5, 1.5, 2.5] * 5, [0.5, 1.5, 2.5] * 5)[0] == "psi"


@pytest.mark.parametrize("ref,cur", [
    ([i * 0.37 % 10 for i in range(500)], [i * 0.37 % 12 for i in range(300)]),
    ([float(i // 30) + 0.5 for i in range(300)], [float(i // 20) + 0.5 for i in range(200)]),
    ([i * 0.01 for i in range(1000)], [i * 0.01 for i in range(1000)]),
    ([-0.0, 0.0, 1.5, 2.5, 3.25] * 20, [0.0, 1.5, 1.5] * 20)])
def test_psi_equals_numpy(spark, ref, cur):
    assert _score(spark, ref, cur) == ("psi", pytest.approx(_numpy_psi(ref, cur), rel=1e-9, abs=1e-12))


def test_constant_reference_uses_the_mean(spark):
    assert _score(spark, [0.5] * 10, [0.75] * 10) == ("mean_shift", pytest.approx(0.25))
    assert _score(spark, [0.5] * 10, [9.0, 9.5] * 5) == ("mean_shift", 1.0)
    ref = [0.5] * 99 + [1000.5]
    assert _score(spark, ref, [10.5] * 5) == (
        "mean_shift", pytest.approx(min(1.0, abs(10.5 - np.mean(ref)) / np.std(ref))))


def test_missing_and_infinite_values_take_the_reference_median(spark):
    ref = [float(i) + 0.5 for i in range(50)]
    cur = [0.5, 1.5, 2.5, None, float("nan"), float("inf")] * 5
    frames = [D.feature_frame(numbers(spark, v)) for v in (ref + [None] * 7, cur)]
    filled = [0.5, 1.5, 2.5, 25.0, 25.0, 25.0] * 5
    assert D.drift_scores(*frames).first()["score"] == pytest.approx(_numpy_psi(ref + [25.0] * 7, filled))


def test_short_windows_and_empty_columns_have_no_score(spark):
    assert _score(spark, [1.0, 2.0, 3.0], [1.0]) is None
    df = spark.range(30).select((F.col("id") * 0.5).alias("a"), F.lit(None).cast("double").alias("b"))
    rows = D.drift_scores(df, df).collect()
    assert [r["feature"] for r in rows] == ["a"]
    assert D.drop_empty(df).columns == ["a"]


def test_feature_frame_choice(spark):
    df = spark.createDataFrame([("1.5", 3, 1, "x")], "t string, n int, is_fraud int, s string")
    assert D.feature_frame(df).columns == ["n"]
    assert tuple(D.feature_frame(df, ["t", "nowhere", "s"]).first()) == (1.5, None)


def test_snapshots(spark):
    ref = spark.createDataFrame([(100000.0, 9.0), (200000.0, 10.0), (150000.0, 11.0)], "amount double, hour double")
    none = D.snapshot(ref, ref.limit(0)).first()
    assert (none["ready"], none["features_total"], none["reference_samples"], none["reason"]) == (
        False, 2, 3, "waiting_for_current_window")
    assert none["feature_scores"] == {"amount": 0.0, "hour": 0.0}
    missing = D.snapshot(None, ref).first()
    assert (missing["ready"], missing["reference_mode"], missing["current_samples"]) == (False, "missing", 3)
    apart = D.snapshot(ref, ref.select(F.col("amount").alias("other"))).first()
    assert apart["reason"] == "feature_overlap_missing"
    moved = D.snapshot(ref, ref.withColumn("hour", F.col("hour") + 5)).first()
    assert (moved["ready"], moved["features_alerting"], moved["drift_ratio"], moved["overall_score"]) == (True, 1, 0.5, 0.5)
    assert moved["feature_scores"] == {"amount": 0.0, "hour": 1.0}


@pytest.mark.parametrize("parts", [1, 9])
def test_sample_and_windows_do_not_depend_on_partitions(spark, parts):
    df = spark.range(250).select("id", (F.col("id") % 2).alias("slot"), F.timestamp_seconds("id").alias("ts")).repartition(parts)
    sample = {r["id"] for r in D.sample_rows(df, F.pmod(F.col("id") * 31, F.lit(97)), "id", 50).collect()}
    assert len(sample) == 50 and sample == {r["id"] for r in D.sample_rows(df.coalesce(1), F.pmod(F.col("id") * 31, F.lit(97)), "id", 50).collect()}
    last = {r["id"] for r in D.last_rows(df, ["slot"], "ts", "id", 10).collect()}
    assert last == set(range(230, 250))
    assert D.warmup_rows(df, ["slot"], "ts", "id", 126, 200).count() == 0
    assert {r["id"] for r in D.warmup_rows(df, ["slot"], "ts", "id", 100, 120).collect()} == set(range(240))


def test_windowed_drift_equals_the_plain_score(spark):
    ref = numbers(spark, [i * 0.37 % 10 for i in range(400)])
    cur = spark.range(200).select(
        F.timestamp_seconds(F.col("id") % 2 * 86400).alias("ts"), (F.col("id") * 0.11 % 9).alias("v"))
    got = {r["window_start"].day: r["score"] for r in D.windowed_drift(ref, cur, "ts", "1 day").collect()}
    for day, rest in ((1, 0), (2, 1)):
        want = D.drift_scores(ref, cur.filter(F.col("v").isNotNull() & (F.dayofmonth("ts") == day)).select("v")).first()
        assert got[day] == pytest.approx(want["score"])


def test_text_columns_are_no_numbers(spark):
    df = spark.createDataFrame([("a",)], T.StructType([T.StructField("s", T.StringType())]))
    assert D.feature_frame(df).columns == []


def test_reasons_of_a_loaded_reference_and_of_rows_that_cannot_be_transformed(spark):
    reference = spark.range(50).select(F.col("id").cast("double").alias("v"))
    first = D.first_snapshot(spark, reference, "drift_reference.parquet").first()
    assert (first["ready"], first["reason"], first["reference_samples"]) == (False, "reference_loaded_from_drift_reference.parquet", 50)
    assert D.first_snapshot(spark, None).first()["reason"] == "waiting_for_warmup_window"
    rows = spark.range(20).select(F.col("id").alias("raw"))
    fine = D.snapshot_of_requests(reference, rows, lambda df: df.select(F.col("raw").cast("double").alias("v"))).first()
    assert fine["ready"] and fine["reason"] == "updated_from_live_traffic" and fine["current_samples"] == 20
    for known, n in ((reference, 50), (None, 0)):
        bad = D.snapshot_of_requests(known, rows, lambda df: df.select("absent")).first()
        assert (bad["ready"], bad["reason"], bad["reference_samples"], bad["features_alerting"]) == (False, "transform_unavailable", n, 0)
