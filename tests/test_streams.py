import datetime as dt
import json

import pytest
from data import raw_transactions
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators import clean as C
from riskweave.operators import drift as D
from riskweave.operators import metrics as M
from riskweave.operators.features import FeatureState
from riskweave.streaming import drift as SD
from riskweave.streaming import metrics as SM
from riskweave.streaming import requests as SR
from riskweave.streaming import scoring as SS
from riskweave.streaming import state_drift as SX


@pytest.fixture
def feed(spark, tmp_path):
    """Writes rows as numbered files and reads them one file per batch."""
    def make(df, parts, name="rows"):
        folder = tmp_path / name
        for i in range(parts):
            df.filter(F.col("part") == i).drop("part").coalesce(1).write.parquet(str(folder / f"p{i}"))
        return spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(str(folder))
    return make


def test_messages_of_one_or_many(spark):
    one = {"transaction_id": "a", "timestamp": "2026-03-14 10:23:00", "customer_id": "c", "amount": 350000.0}
    texts = [json.dumps(one), json.dumps([one, {**one, "transaction_id": "b"}]), "[]", "no json",
             json.dumps([one] * 1001)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "m int, value string")
    rows = SR.parse_messages(df).collect()
    got = {(r["m"], r["message_ok"], r["transaction_id"]) for r in rows}
    assert got == {(0, True, "a"), (1, True, "a"), (1, True, "b"), (2, False, None), (3, False, None), (4, False, None)}


def test_stream_scores_equal_batch_and_drop_repeats(spark, feed):
    raw = raw_transactions(spark)
    state = FeatureState.fit(C.clean(raw))
    part = F.when(F.col("transaction_id") < "txn-000030", 0).when(F.col("transaction_id") < "txn-000060", 1).otherwise(2)
    rows = raw.withColumn("part", part)
    again = rows.filter("transaction_id between 'txn-000028' and 'txn-000031'").withColumn("part", F.lit(1))
    doubled = rows.unionByName(again)

    def score(df):
        return df.withColumn("score", F.col("amount_log") / 20)

    assert SS.write_scores(SS.score_stream(feed(doubled, 3), state, score, 0.6)).count() == 104
    out = SS.write_scores(SS.score_stream(feed(doubled, 3, "again"), state, score, 0.6, late="2 hours"))
    batch = score(state.transform(raw))
    columns = ["transaction_id", "score", "customer_tx_count", "segment_encoded", "cvv_match", "transaction_hour"]
    assert out.count() == 100
    assert sorted(map(str, out.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))


def test_stream_metrics_equal_batch(spark, feed):
    log = spark.range(600).select(
        F.timestamp_seconds(1_767_225_600 + F.col("id") * 7).alias("ts"),
        (F.col("id") % 3).cast("string").alias("path"), (F.col("id") % 50 / 10).alias("latency_s"),
        (F.col("id") / 200).cast("int").alias("part"))
    aggs = [F.count(F.lit(1)).alias("n"), *M.histogram_aggs("latency_s", [0.5, 2.0])]
    got = SM.stream_steps(feed(log, 3), ["path"], aggs)
    want = M.per_step(log, "ts", ["path"], aggs)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def _requests(spark):
    start = int(dt.datetime(2026, 1, 1).timestamp())
    return spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "candidate").otherwise("stable").alias("slot"),
        F.timestamp_seconds(start + F.col("id")).alias("ts"), F.col("id").alias("request_id"),
        (F.col("id") * 0.37 % 10 + F.when(F.col("id") > 600, 3).otherwise(0)).alias("amount"),
        (F.col("id") / 300).cast("int").alias("part"))


def test_rolling_drift_over_batches(spark, feed, tmp_path):
    log = _requests(spark)
    reference = log.filter("part = 0").select("amount")
    rolling = SD.RollingDrift(spark, str(tmp_path / "state"), ["amount"], reference=reference, window=100)
    SR.run_available(feed(log, 3).writeStream.foreachBatch(rolling.on_batch), "drift")
    shots = rolling.snapshots().orderBy("batch_id", "slot").collect()
    assert [(r["batch_id"], r["slot"]) for r in shots] == [(b, s) for b in range(3) for s in ("candidate", "stable")]
    assert all(r["current_samples"] == 100 for r in shots)
    for r in shots[-2:]:
        live = D.last_rows(log.filter(F.col("slot") == r["slot"]), ["slot"], "ts", "request_id", 100)
        want = D.snapshot(reference, live.select("amount")).first()
        assert r["feature_scores"] == pytest.approx(want["feature_scores"])
        assert r["feature_scores"]["amount"] > shots[0]["feature_scores"]["amount"]
    # a repeated batch leaves the same snapshot
    rolling.on_batch(log.filter("part = 2"), 2)
    assert rolling.snapshots().count() == 6


def test_baseline_freezes_once_long_enough(spark, feed, tmp_path):
    log = _requests(spark)
    rolling = SD.RollingDrift(spark, str(tmp_path / "state"), ["amount"], window=500, warmup_least=150, warmup_most=220)
    SR.run_available(feed(log, 3).writeStream.foreachBatch(rolling.on_batch), "warmup")
    shots = {(r["batch_id"], r["slot"]): r for r in rolling.snapshots().collect()}
    # candidate has 100 rows per batch, stable 200
    assert not shots[0, "candidate"]["ready"] and shots[0, "candidate"]["reference_mode"] == "missing"
    assert shots[0, "stable"]["reference_samples"] == 200
    assert shots[1, "candidate"]["reference_samples"] == 200
    assert shots[2, "candidate"]["reference_samples"] == 200 and shots[2, "stable"]["reference_samples"] == 200
    assert shots[2, "stable"]["reference_mode"] == "warmup_window"


def test_state_store_drift_equals_batch_and_goes_on_after_a_restart(spark, feed, tmp_path):
    log = _requests(spark)
    reference = log.filter("part = 0").select("amount")
    stored = SX.SnapshotTable(spark, str(tmp_path / "shots"))
    offsets = str(tmp_path / "offsets")

    def run(stream, table, checkpoint, **options):
        out = SX.drift_stream(stream, ["amount"], **options).writeStream.outputMode("update").foreachBatch(table.on_batch)
        SR.run_available(out, "state", checkpoint=checkpoint)

    # only the rows of one slot come in the second batch: the other's snapshot stays where it was
    parts = log.withColumn("part", F.when(F.col("request_id") < 300, 0).when(F.col("slot") == "stable", 1).otherwise(2))
    stream = feed(parts, 2)
    run(stream, stored, offsets, reference=reference, window=100)
    seen = {(r.batch, r.slot): r.seen for r in stored.all().collect()}
    assert seen == {(0, "candidate"): 100, (0, "stable"): 200, (1, "stable"): 600}
    parts.filter("part = 2").drop("part").coalesce(1).write.parquet(str(tmp_path / "rows" / "p2"))
    run(stream, stored, offsets, reference=reference, window=100)       # a new run from the checkpoint
    got = {r.slot: r for r in stored.latest().collect()}
    assert {s: r.seen for s, r in got.items()} == {"candidate": 300, "stable": 600}
    for slot, r in got.items():
        live = D.last_rows(log.filter(F.col("slot") == slot), ["slot"], "ts", "request_id", 100)
        want = D.snapshot(reference, live.select("amount")).first()
        assert r["feature_scores"] == pytest.approx(want["feature_scores"]) and r["current_samples"] == 100
    warm = SX.SnapshotTable(spark, str(tmp_path / "warm"))
    run(feed(log, 3, "again"), warm, str(tmp_path / "offsets2"), window=500, warmup_least=150, warmup_most=220)
    shots = {(r["batch"], r["slot"]): r for r in warm.all().collect()}
    assert not shots[0, "candidate"]["ready"] and shots[0, "candidate"]["reference_mode"] == "missing"
    assert [shots[b, s]["reference_samples"] for b, s in ((0, "stable"), (1, "candidate"), (2, "candidate"), (2, "stable"))] == [200] * 4
    assert shots[2, "stable"]["reference_mode"] == "warmup_window"


def test_what_a_batch_writes_to_the_store_does_not_grow(spark, feed, tmp_path):
    log = _requests(spark).withColumn("part", F.pmod("request_id", F.lit(30)).cast("int"))
    shots, offsets = SX.SnapshotTable(spark, str(tmp_path / "shots")), tmp_path / "offsets"
    out = SX.drift_stream(feed(log, 30), ["amount"], window=20, warmup_least=10, warmup_most=15)
    SR.run_available(out.writeStream.outputMode("update").foreachBatch(shots.on_batch), "flat", checkpoint=str(offsets))
    assert shots.latest().agg(F.sum("seen")).first()[0] == 900
    written = {}
    for f in offsets.glob("state/0/*/*.delta"):
        written[int(f.stem)] = written.get(int(f.stem), 0) + f.stat().st_size
    assert max(written) == 30 and max(written[v] for v in range(15, 31)) < 1.3 * max(written[v] for v in range(2, 9))


def test_tasks_hand_on_what_a_slot_can_take(spark, monkeypatch):
    """A slot's Python gets the first and last rows of each task, and the count of all; none without a slot is lost."""
    log = spark.range(6000, numPartitions=2).select(
        F.when(F.col("id") % 3 < 2, F.concat(F.lit("s"), F.col("id") % 3)).alias("slot"), F.xxhash64("id").alias("request_id"),
        F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64("id"), F.lit(900))).alias("ts"), F.col("id").cast("double").alias("amount"))
    for most, batch in ((500_000, 10_000), (40, 100)):
        monkeypatch.setattr(SX, "HELD_ROWS", most)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = SX.slot_ends(log, "slot", ["ts", "request_id"], 7, 5).toPandas()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(got) == 3 * 2 * 12 or most == 40
        whole = log.toPandas().sort_values(["ts", "request_id"])
        for slot, own in whole.groupby("slot", dropna=False):
            mine = got[got["slot"].isna() if slot != slot or slot is None else got["slot"] == slot].sort_values(["ts", "request_id"])
            assert mine["_rows"].sum() == len(own) == 2000
            assert mine["amount"].head(7).tolist() == own["amount"].head(7).tolist()
            assert mine["amount"].tail(5).tolist() == own["amount"].tail(5).tolist()


def test_constants_are_consistent():
    assert len(S.MODEL_FEATURES) == 31 and len(set(S.MODEL_FEATURES)) == 31
    assert not set(S.NON_FEATURE_COLUMNS) & set(S.MODEL_FEATURES)
    for bounds in (S.LATENCY_BOUNDS, S.SCORE_BOUNDS, S.AMOUNT_BOUNDS):
        assert list(bounds) == sorted(set(bounds))
