"""Dirty values, many groups and files written by others."""

import datetime as dt
import json
import math

import pytest
from data import START, lopsided, raw_transactions
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators import alerts as AL
from riskweave.operators import behaviour as B
from riskweave.operators import drift as D
from riskweave.operators import evaluate as E
from riskweave.operators import features as FE
from riskweave.operators import metrics as M
from riskweave.operators import quality as Q
from riskweave.sources import tables as TB
from riskweave.streaming import drift as SD

NAN, INF = float("nan"), float("inf")


def _at(minutes):
    return START + dt.timedelta(minutes=minutes)


def test_customer_stats_leave_out_what_is_not_finite(spark):
    df = spark.createDataFrame([("c", v) for v in (10.0, 20.0, NAN, INF, None)], "customer_id string, amount double")
    assert [tuple(r) for r in FE.customer_stats(df).collect()] == [("c", 2, 15.0)]


def test_behaviour_of_dirty_rows(spark):
    rows = [("a", "c", _at(0), 10.0), ("b", "c", _at(60), NAN), ("d", "c", _at(120), 5.0), ("e", None, _at(5), 1.0), ("f", "c", None, 1.0)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, timestamp timestamp, amount double")
    got = {r.transaction_id: r for r in B.behaviour(df).collect()}
    assert got["d"].avg_amount_last_30d == 10.0 and got["d"].time_since_last_tx_min == 60.0
    for row in (got["e"], got["f"]):
        assert row.time_since_last_tx_min is None and row.tx_count_last_1h is None and row.avg_amount_last_30d is None


def test_first_seen_of_a_missing_value(spark):
    rows = [("a", "c", _at(0), None), ("b", "c", _at(1), None), ("d", "c", _at(2), "x"), ("e", "c", _at(3), "")]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, timestamp timestamp, device_type string")
    assert {r.transaction_id: r.is_new for r in B.first_seen(df, "device_type", "is_new").collect()} == {"a": 1, "b": 0, "d": 1, "e": 1}


def test_counters_skip_missing_samples(spark):
    rows = [("s", _at(i), v) for i, v in enumerate([10.0, None, 25.0, 5.0])]
    df = spark.createDataFrame(rows, "series string, ts timestamp, value double")
    got = M.counter_increase(df, ["series"], "ts", "value", "1 hour").collect()
    assert [r.increase for r in got] == [20.0]


def test_positive_histogram(spark):
    df = spark.createDataFrame([(_at(i), v) for i, v in enumerate([-1.0, 0.0, 5.0, NAN, None])], "ts timestamp, amount double")
    row = M.histogram(df, "ts", "amount", [1.0, 10.0], step="1 day", positive=True).first()
    assert (row.le_0, row.le_1, row.observed, row.total) == (0, 1, 1, 5.0)


@pytest.mark.parametrize("text,ok", [("2026-01-02T10:23:00", True), ("2026-01-02", True), ("2026-01-02 10:23:00.5+07:00", True),
                                     ("10:23:00", False), ("2026", False), ("2026-01", False), ("soon", False)])
def test_request_times_are_full_dates(spark, text, ok):
    df = spark.createDataFrame([("t", text, "c", 5.0, "mass")], "transaction_id string, timestamp string, customer_id string, amount double, customer_tier string")
    assert Q.with_errors(df).first().errors == ([] if ok else ["timestamp:format"])


def test_nan_amounts_are_faults(spark):
    df = spark.createDataFrame([("t", "2026-01-02", "c", NAN, "mass")], "transaction_id string, timestamp string, customer_id string, amount double, customer_tier string")
    assert Q.with_errors(df).first().errors == ["amount:positive"]


def test_all_unexpected_labels_are_named(spark):
    bad = raw_transactions(spark, 40).withColumn("is_fraud", (F.col("account_age_days") % 100 + 2).cast("int"))
    seen = sorted(r[0] for r in bad.select("is_fraud").distinct().collect())
    assert len(seen) > 20
    with pytest.raises(ValueError, match=str(seen).replace("[", r"\[").replace("]", r"\]")):
        Q.validate(bad)


def test_evaluation_of_missing_labels_and_segments(spark):
    rows = [(0.9, None, "x"), (0.8, 1, "x"), (0.7, 0, None), (0.6, 1, None), (0.2, 0, "ALL")]
    df = spark.createDataFrame(rows, "score double, label int, segment string")
    assert E.curve_metrics(df).first().n_pos == 2
    report = [(r.segment, r.n_samples, r.n_fraud) for r in E.segment_report(df, 0.5).collect()]
    assert sorted(report, key=str) == sorted([("ALL", 4, 2), ("ALL", 1, 0), (None, 2, 1), ("x", 1, 1)], key=str)


def test_csv_of_others(spark, tmp_path):
    text = 'transaction_id,merchant_name,amount,is_fraud\n1,"A ""B"", C",5.5,1\n2,"two\nlines",1d,0.5\n3,N/A,1e3,0\n'
    (tmp_path / "t.csv").write_text(text)
    df = TB.read_transactions_csv(spark, f"file://{tmp_path}/t.csv")
    got = [tuple(r) for r in df.orderBy("transaction_id").collect()]
    assert got == [("1", 'A "B", C', 5.5, 1), ("2", "two\nlines", None, None), ("3", None, 1000.0, 0)]
    TB.write_transactions_csv(df, f"file://{tmp_path}/out")
    assert sorted(tuple(r) for r in TB.read_transactions_csv(spark, f"file://{tmp_path}/out").collect())[0] == got[0]


def test_a_damaged_file_is_not_absent(spark, tmp_path):
    (tmp_path / "train.parquet").write_text("not parquet")
    assert TB.read_if_there(spark, f"file://{tmp_path}/none.parquet") is None
    with pytest.raises(Exception, match="(?i)parquet|schema|footer"):
        TB.read_if_there(spark, f"file://{tmp_path}/train.parquet")


def test_published_state(spark, tmp_path):
    train = raw_transactions(spark)
    fitted = FE.FeatureState.fit(train)
    codes = {}
    for r in fitted.codes.collect():
        codes.setdefault(r["column"], {})[r["value"]] = r["code"]
    (tmp_path / "segment_label_map.json").write_text(json.dumps(codes.pop(FE.TIER), indent=2))
    (tmp_path / "categorical_maps.json").write_text(json.dumps(codes, indent=2))
    (tmp_path / "amount_median_train.json").write_text(json.dumps({"amount_median_train": fitted.median}, indent=2))
    fitted.stats.write.parquet(f"file://{tmp_path}/stats")
    read = FE.state_from_json(spark, f"file://{tmp_path}", f"file://{tmp_path}/stats")
    assert read.median == fitted.median
    one, two = (sorted(map(str, s.transform(train).collect())) for s in (fitted, read))
    assert one == two


def test_any_number_of_targets(spark):
    n = 1100
    seen = spark.range(n).select(F.concat(F.lit("t"), "id").alias("path"), F.lit(_at(0)).alias("step"), F.lit(1).alias("n"))
    seen = seen.unionByName(spark.createDataFrame([("t0", _at(10), 1)], "path string, step timestamp, n int"))
    grid = AL.evaluation_grid(seen, "step", "1 minute", seen.select("path"))
    assert grid.count() == 11 * n
    down = AL.absent_targets(seen).groupBy("path").count()
    assert down.count() == n
    assert AL.absent_targets(seen.limit(0)).collect() == []


def _three_kinds(spark, n, seed, with_infinities=False):
    i = F.col("id")
    value = (i * 7919 + seed) % 1000 / 10
    return spark.range(n).select(
        (i % 5 + F.lit(seed % 2)).cast("double").alias("category"), (F.when(i % 17 == 3, INF).otherwise(value) if with_infinities else value).alias("psi"),
        F.when(i % 40 == 1, value).otherwise(0.5).alias("shift"), F.when(i % 3 == 0, value).alias("holed"),
        F.timestamp_seconds(F.lit(1_700_000_000) + i * 1000).alias("ts"))


def test_windows_score_like_single_comparisons(spark):
    reference, current = _three_kinds(spark, 400, 0).drop("ts"), _three_kinds(spark, 300, 3)
    windows = {}
    for r in D.windowed_drift(reference, current, "ts", "1 day").collect():
        windows.setdefault(r.window_start, {})[r.feature] = r.score
    day = F.window("ts", "1 day")["start"]
    assert len(windows) == current.select(day).distinct().count() >= 3
    for start, found in windows.items():
        alone = D.drift_scores(reference, current.filter(day == F.lit(start)).drop("ts")).collect()
        assert {r.kind for r in alone} >= {"psi", "mean_shift"}
        assert found == pytest.approx({r.feature: r.score for r in alone}, abs=1e-9)


def test_rolling_drift_of_many_slots(spark, tmp_path):
    reference = _three_kinds(spark, 400, 0).drop("ts")
    names = ["category", "psi", "shift", "holed"]
    batch = _three_kinds(spark, 1010, 3, True).withColumns({"slot": F.concat(F.lit("s"), F.pmod(F.hash("ts"), F.lit(101))),
                                                            "request_id": F.col("ts").cast("string")})
    rolling = SD.RollingDrift(spark, f"file://{tmp_path}/r", names, reference=reference)
    rolling.on_batch(batch, 0)
    got = {r.slot: r for r in rolling.snapshots().collect()}
    assert len(got) == batch.select("slot").distinct().count() > 90
    for slot in sorted(got)[:3]:
        live = D.feature_frame(batch.filter(F.col("slot") == slot), names)
        want = D.snapshot(reference, live).first()
        r = got[slot]
        assert r.feature_scores == pytest.approx(want.feature_scores, abs=2e-6)
        assert (r.ready, r.reference_mode, r.reason, r.features_total, r.current_samples) == (
            want.ready, S.MODE_TRAIN, S.REASON_UPDATED, want.features_total, want.current_samples)
    assert not any(math.isnan(r.overall_score) for r in got.values())


def test_top_rows_leave_the_session_alone(spark):
    from riskweave.operators.rank import top_per_group
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(setting)
    df = lopsided(spark, 3000)
    got = top_per_group(df.repartition(6), ["customer_id"], [F.desc("timestamp"), F.desc("transaction_id")], 1500)
    assert got.filter("customer_id = 'hot'").count() == 1000 and spark.conf.get(setting) == before
    plan = top_per_group(df, ["customer_id"], [F.desc("timestamp")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scratch_folders_can_be_removed(spark):
    from riskweave.session import clean_scratch, settle
    clean_scratch(spark)
    kept = settle(spark.range(3))
    assert kept.count() == 3 and clean_scratch(spark) == 1 and clean_scratch(spark) == 0


def test_rows_without_a_key_are_dealt_out(spark):
    from riskweave.operators.skew import salted_left_join
    facts = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 5).alias("k"), "id")
    table = spark.createDataFrame([(0, "a"), (1, "b"), (None, "never")], "k long, v string")
    for hot in ({}, {r[0]: 60 for r in spark.range(1).select(F.xxhash64(F.lit(0).cast("long"))).collect()}):
        joined = salted_left_join(facts, table, ["k"], hot, 10)
        got = {r.id: r.v for r in joined.collect()}
        assert joined.columns == ["k", "id", "v"] and len(got) == 900
        assert got == {i: None if i % 3 else {0: "a", 1: "b"}.get(i % 5) for i in range(900)}


def test_labels_too_many_to_name_are_written(spark):
    bad = spark.range(3000).select(F.col("id").cast("string").alias("transaction_id"), F.col("id").cast("int").alias("is_fraud"))
    text = "; ".join(str(e) for e in _validation_errors(bad))
    path = text.split("all of them in ")[1].split(",")[0]
    assert "2998 unexpected labels" in text and spark.read.parquet(path).count() == 2998


def _validation_errors(df):
    try:
        Q.validate(df)
    except ValueError as e:
        return [e]
    return []
