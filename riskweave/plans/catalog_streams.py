"""Structured Streaming queries, each run over all available files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators import alerts as AL
from riskweave.operators import metrics as M
from riskweave.operators import model as MD
from riskweave.operators import split as SP
from riskweave.operators.features import FeatureState, feature_columns
from riskweave.operators.quality import split_valid
from riskweave.plans import catalog_drift as CD
from riskweave.plans import catalog_metrics as CM
from riskweave.plans import catalog_model as CO
from riskweave.plans import sql_views as V
from riskweave.plans.catalog_features import _BEHAVIOUR, _PREPARED, _behaviour_sql
from riskweave.plans.registry import query
from riskweave.session import scratch_path
from riskweave.sources import adapters as A
from riskweave.streaming import drift as SD
from riskweave.streaming import state_alerts as SA
from riskweave.streaming import state_behaviour as SB
from riskweave.streaming import state_drift as SX
from riskweave.streaming import metrics as SM
from riskweave.streaming import model_scoring as SMS
from riskweave.streaming import requests as SR
from riskweave.streaming import scoring as SS

THRESHOLD = 0.4


@query("stream_scores", "T8 S7 S8 M9", f"""WITH {_PREPARED}, {V.SCORED}
SELECT a.transaction_id, round(s.score, 6) AS fraud_score, CASE WHEN s.score >= {THRESHOLD} THEN 1 ELSE 0 END AS is_fraud_pred,
  {V.risk_band("s.score")} AS risk_level, coalesce(st.customer_tx_count, 0) AS customer_tx_count,
  CASE a.customer_tier WHEN 'INSPIRE' THEN 0 WHEN 'MASS' THEN 1 WHEN 'PRIORITY' THEN 2 ELSE 3 END AS segment_encoded
FROM tx a JOIN scored s USING (transaction_id) LEFT JOIN stats st ON st.customer_id = a.customer_id
WHERE a.amount > 0""")
def stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    state = FeatureState.fit(SP.chrono_split(A.transactions(spark, sf))[0])
    requests = A.transactions_of(SR.table_stream(spark, sf, "events"))

    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("score", A.formula_score(
            F.col("transaction_id").cast("long"), F.col("customer_id").cast("long"), F.col("is_fraud")))

    scored = SS.score_stream(requests, state, score, THRESHOLD).select(
        "transaction_id", "fraud_score", "is_fraud_pred", "risk_level", "customer_tx_count", "segment_encoded")
    return SS.write_scores(scored)


@query("stream_model_scores", "T8 S7 S8 M9", f"""WITH {V.TX}
SELECT transaction_id, CAST(1 + CAST(transaction_id AS BIGINT) % 2 AS INT) AS model_version, true AS same_as_batch FROM tx WHERE amount > 0""")
def stream_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A stored model scores half the requests, a newly published one the rest; each row against batch scoring."""
    events, folder = A.table(spark, sf, "events"), scratch_path(spark, "model-feed")
    raw = A.transactions(spark, sf)
    train = SP.chrono_split(raw)[0]
    first, whole = FeatureState.fit(train), FeatureState.fit(raw)
    rows = first.transform(train)
    fitted = MD.train_model(rows, CO._numeric(rows, feature_columns(rows)), **CO.SHORT)
    store = SMS.ModelStore(spark, scratch_path(spark, "models"))
    scorer = SMS.ModelScorer(store, scratch_path(spark, "model-scores"))
    offsets, batch = scratch_path(spark, "model-offsets"), None
    for k, (state, threshold) in enumerate(((first, THRESHOLD), (whole, 0.6))):
        version = store.publish(fitted, state, threshold)
        events.filter(F.pmod("event_id", F.lit(2)) == k).write.parquet(f"{folder}/{k}")
        feed = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(folder)
        SR.run_available(A.transactions_of(feed).writeStream.foreachBatch(scorer.on_batch), "model", checkpoint=offsets)
        own = raw.filter(F.pmod(F.col("transaction_id").cast("long"), F.lit(2)) == k)
        part = MD.predict(fitted, state, own, threshold).withColumn("model_version", F.lit(version))
        batch = part if batch is None else batch.unionByName(part)
    values = F.struct("fraud_score", "is_fraud_pred", "risk_level", "threshold")
    told = scorer.scores().select("transaction_id", "model_version", values.alias("streamed"))
    want = batch.select("transaction_id", "model_version", values.alias("scored"))
    return told.join(want, ["transaction_id", "model_version"], "left").select(
        "transaction_id", "model_version", F.col("streamed").eqNullSafe(F.col("scored")).alias("same_as_batch"))


_FAULT_COUNT = """(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END + CASE WHEN ts_ok IS NULL THEN 1 ELSE 0 END
  + CASE WHEN amount <= 0 THEN 1 ELSE 0 END + CASE WHEN tier_upper = 'GOLD' THEN 1 ELSE 0 END
  + CASE WHEN account_age_days < 0 THEN 1 ELSE 0 END + CASE WHEN is_new_device NOT IN (0, 1) THEN 1 ELSE 0 END
  + CASE WHEN hour_of_day > 23 THEN 1 ELSE 0 END)"""


@query("stream_quarantine", "T8 P8 S8", f"""WITH {V.DIRTY}
SELECT transaction_id, amount, CAST({_FAULT_COUNT} AS INT) AS n_errors FROM dirty WHERE {_FAULT_COUNT} > 0""")
def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    requests = A.dirty_transactions_of(SR.table_stream(spark, sf, "events"))
    return SS.write_scores(SS.quarantine_stream(requests).select("transaction_id", "amount", "n_errors"), "quarantine")


@query("stream_messages", "S7 D7 D8 P9", f"""WITH {V.TX}
SELECT transaction_id, amount, upper(customer_tier) AS customer_tier, "timestamp", true AS message_ok FROM tx WHERE amount > 0""")
def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON messages of one record or a list of up to seven, as a stream."""
    folder = scratch_path(spark, "messages")
    e = F.col("transaction_id").cast("long")
    group = F.floor(e / 7)
    record = F.struct(
        "transaction_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "customer_id", "amount", F.lower("customer_tier").alias("customer_tier"))
    tx = A.transactions(spark, sf).withColumn("g", group).withColumn("own", F.when(F.col("g") % 5 == 0, e))
    tx.groupBy("g", "own").agg(F.collect_list(record).alias("r")).select(
        F.when(F.col("own").isNotNull(), F.to_json(F.col("r")[0])).otherwise(F.to_json("r")).alias("value")
    ).write.text(folder)
    parsed = SR.parse_messages(spark.readStream.text(folder))
    valid, _ = split_valid(parsed)
    return SS.write_scores(valid.select(
        "transaction_id", "amount", "customer_tier", F.to_timestamp(F.replace("timestamp", F.lit("T"), F.lit(" "))).alias("timestamp"),
        "message_ok"), "messages-out")


@query("stream_request_counts", "T1 T2 S8", f"""WITH {V.LOG}
SELECT date_trunc('hour', ts) AS step, path, status, count(*) AS n,
  count(*) FILTER (WHERE latency_s <= 0.1) AS le_0, count(*) FILTER (WHERE latency_s <= 1.0) AS le_1,
  count(latency_s) AS observed, sum(latency_s) AS total FROM log GROUP BY ALL""")
def stream_request_counts(spark: SparkSession, sf: str) -> DataFrame:
    log = A.request_log(SR.table_stream(spark, sf, "events"))
    aggs = [F.count(F.lit(1)).alias("n"), *M.histogram_aggs("latency_s", [0.1, 1.0])]
    return SM.stream_steps(log, ["path", "status"], aggs, "1 hour")


@query("stream_counts_any_order", "T1 T2 S8", f"""WITH {V.LOG}
SELECT date_trunc('hour', ts) AS step, path, status, count(*) AS n FROM log GROUP BY ALL""")
def stream_counts_any_order(spark: SparkSession, sf: str) -> DataFrame:
    """Four parts, the latest events first, a few files in each micro-batch; events without an id come last."""
    events, folder = A.table(spark, sf, "events"), scratch_path(spark, "feed")
    cuts = [None, *events.agg(F.percentile_approx("event_id", [0.25, 0.5, 0.75])).first()[0], None]
    for k in reversed(range(4)):
        lo, hi = cuts[k], cuts[k + 1]
        own = (F.lit(True) if lo is None else F.col("event_id") > lo) & (F.lit(True) if hi is None else F.col("event_id") <= hi)
        events.filter(own | F.col("event_id").isNull() if k == 0 else own).write.parquet(f"{folder}/{k}")
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).option("recursiveFileLookup", True).parquet(folder)
    return SM.stream_steps(A.request_log(feed), ["path", "status"], [F.count(F.lit(1)).alias("n")], "1 hour")


_DRIFT_FEATURES = ("amount", "score")


def _slot_long(reference: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT side, slot || ':{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM sides" for f in _DRIFT_FEATURES)
    return f"""newest AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY ts DESC, request_id DESC) AS rn FROM log),
oldest AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY ts, request_id) AS rn FROM log),
slot_names AS (SELECT DISTINCT slot FROM log),
sides AS ({reference} UNION ALL SELECT 1, slot, amount, score FROM newest WHERE rn <= {S.DRIFT_WINDOW}),
long AS ({rows}), {CD.SCORES}"""


_SHOTS = """SELECT s.slot, count(*) AS features_total,
  CAST(count(*) FILTER (WHERE round(score, 6) >= 0.2) AS BIGINT) AS features_alerting,
  avg(round(score, 6)) AS overall_score, max(r.n) AS reference_samples, max(c.n) AS current_samples
FROM (SELECT split_part(feature, ':', 1) AS slot, score FROM scores) s
JOIN (SELECT slot, count(*) AS n FROM sides WHERE side = 0 GROUP BY slot) r ON r.slot = s.slot
JOIN (SELECT slot, count(*) AS n FROM sides WHERE side = 1 GROUP BY slot) c ON c.slot = s.slot GROUP BY s.slot"""
_SHOWN = ("slot", "features_total", "features_alerting", "overall_score", "reference_samples", "current_samples")


def _run_drift(spark: SparkSession, sf: str, reference: DataFrame | None, label: str) -> DataFrame:
    rolling = SD.RollingDrift(spark, scratch_path(spark, label), _DRIFT_FEATURES, reference=reference)
    log = A.request_log(SR.table_stream(spark, sf, "events"))
    SR.run_available(log.writeStream.foreachBatch(rolling.on_batch), label)
    shots = rolling.snapshots()
    newest = shots.agg(F.max("batch_id")).first()[0]
    return shots.filter(F.col("batch_id") == newest).select(*_SHOWN)


_EARLY = f"""SELECT 0 AS side, slot_names.slot, amount, score FROM log, slot_names WHERE ts < TIMESTAMP '{CD._LOG_CUT}'"""


@query("stream_drift", "T6 R7 W3 D12", f"WITH {V.LOG}, {_slot_long(_EARLY)} {_SHOTS}")
def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    early = A.requests(spark, sf).filter(F.col("ts") < F.lit(CD._LOG_CUT).cast("timestamp"))
    return _run_drift(spark, sf, early.select(*_DRIFT_FEATURES), "drift")


_FIRST = f"SELECT 0 AS side, slot, amount, score FROM oldest WHERE rn <= {S.DRIFT_REFERENCE_ROWS}"


@query("stream_warmup_drift", "T7 R9 S10", f"WITH {V.LOG}, {_slot_long(_FIRST)} {_SHOTS}")
def stream_warmup_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Without a reference the first rows of each slot become it."""
    return _run_drift(spark, sf, None, "warmup")


def _run_state_drift(spark: SparkSession, sf: str, reference: DataFrame | None, label: str) -> DataFrame:
    log = A.request_log(SR.table_stream(spark, sf, "events"))
    shots = SX.SnapshotTable(spark, scratch_path(spark, label))
    stream = SX.drift_stream(log, _DRIFT_FEATURES, reference=reference)
    SR.run_available(stream.writeStream.outputMode("update").foreachBatch(shots.on_batch), label)
    return shots.latest().select(*_SHOWN, "seen")


_SEEN = "SELECT d.*, n.seen FROM ({shots}) d JOIN (SELECT slot, count(*) AS seen FROM log GROUP BY slot) n ON n.slot = d.slot"


@query("stream_state_drift", "T6 R7 W3 D12", f"WITH {V.LOG}, {_slot_long(_EARLY)} {_SEEN.format(shots=_SHOTS)}")
def stream_state_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Windows per slot in the state store, against a reference."""
    early = A.requests(spark, sf).filter(F.col("ts") < F.lit(CD._LOG_CUT).cast("timestamp"))
    return _run_state_drift(spark, sf, early.select(*_DRIFT_FEATURES), "state-drift")


@query("stream_state_warmup", "T7 R9 S10", f"WITH {V.LOG}, {_slot_long(_FIRST)} {_SEEN.format(shots=_SHOTS)}")
def stream_state_warmup(spark: SparkSession, sf: str) -> DataFrame:
    """Windows and baselines per slot in the state store."""
    return _run_state_drift(spark, sf, None, "state-warmup")


_LATE = "2 hours"
_REACHED = "(SELECT max(ts) - INTERVAL 2 HOUR FROM log)"


def _run_parts(spark: SparkSession, sf: str, label: str, stream: Callable[[DataFrame], DataFrame], sink: type):
    """Three parts an hour out of order at their borders, each read by a run that goes on from the checkpoint of the last."""
    events, folder = A.table(spark, sf, "events"), scratch_path(spark, f"{label}-feed")
    told, offsets = sink(spark, scratch_path(spark, label)), scratch_path(spark, f"{label}-offsets")
    moved = F.unix_seconds(F.col("ts").cast("timestamp")) + F.pmod(F.col("event_id"), F.lit(60)) * 60
    lo, hi = events.agg(F.min(moved), F.max(moved)).first()
    part = F.least(F.floor((moved - lo) * 3 / F.greatest(F.lit(hi) - lo, F.lit(1))), F.lit(2)) if lo is not None else F.lit(0)
    with SA.timer_store(spark):
        for k in range(3):
            events.filter(F.coalesce(part, F.lit(0)) == k).write.parquet(f"{folder}/{k}")
            feed = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(folder)
            out = stream(feed).writeStream.outputMode("append").foreachBatch(told.on_batch)
            SR.run_available(out, label, checkpoint=offsets)
    return told


def _run_alerts(spark: SparkSession, sf: str, label: str, stream: Callable[[DataFrame], DataFrame]) -> SA.AlertTable:
    return _run_parts(spark, sf, label, lambda feed: stream(A.request_log(feed)), SA.AlertTable)


@query("stream_absence_alerts", "T5 W8 S8", f"""WITH {V.LOG},
seen AS (SELECT DISTINCT date_trunc('hour', ts) AS step, {CM._TARGET} AS target FROM log),
hours AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)) + INTERVAL 1 HOUR, max(ts) - INTERVAL 2 HOUR, INTERVAL 1 HOUR)) AS at_time FROM log),
known AS (SELECT DISTINCT target FROM seen WHERE step + INTERVAL 1 HOUR <= {_REACHED}),
checked AS (SELECT at_time, k.target, s.step IS NULL AS cond FROM hours, known k
  LEFT JOIN seen s ON s.target = k.target AND s.step + INTERVAL 1 HOUR = at_time),
numbered AS (SELECT *, sum(CASE WHEN cond THEN 0 ELSE 1 END) OVER (PARTITION BY target ORDER BY at_time) AS island FROM checked),
stretches AS (SELECT target, min(at_time) AS pending_from, max(at_time) AS firing_to FROM numbered WHERE cond GROUP BY target, island)
SELECT '{AL.TARGET_DOWN.name}' AS alert, '{AL.TARGET_DOWN.severity}' AS severity, target, pending_from,
  pending_from + INTERVAL 2 HOUR AS firing_from, firing_to FROM stretches WHERE pending_from + INTERVAL 2 HOUR <= firing_to""")
def stream_absence_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Targets without any request, found by timers; combinations of path, status and slot are the targets."""
    lo = A.requests(spark, sf).agg(F.min(F.unix_millis(F.date_trunc("hour", "ts")))).first()[0]
    told = _run_alerts(spark, sf, "absence", lambda log: SA.alert_stream(
        log.withColumn("target", F.concat_ws("-", "path", "status", "slot")), "ts", ["target"],
        [F.count(F.lit(1)).alias("n")], lambda sums: sums["n"] == 0, CM._hourly(AL.TARGET_DOWN), CM.HOUR, _LATE,
        absent=True, start=lo))
    return told.fired(["target"])


_PATH_FLAGGED = """flagged AS (SELECT date_trunc('hour', ts) AS step, path, count(*) AS n,
  count(*) FILTER (WHERE status LIKE '5__') AS bad FROM log GROUP BY ALL)"""


@query("stream_error_alerts", "T5 W8 F18 S8", f"""WITH {V.LOG}, {_PATH_FLAGGED}, {CM._islands(
    f"SELECT * FROM {CM._ranged('flagged', 5, 'path', 'n, bad')} WHERE at_time <= {_REACHED}",
    "(bad / 18000.0) / greatest(n / 18000.0, 0.0001) > 0.05", CM._hourly(AL.ERROR_RATIO), "path")}""")
def stream_error_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Error ratio per path over five hours, pending for five before it fires."""
    def met(sums):
        return (sums["bad"] / 18000.0) / max(sums["n"] / 18000.0, 0.0001) > AL.ERROR_LIMIT

    told = _run_alerts(spark, sf, "errors", lambda log: SA.alert_stream(
        log, "ts", ["path"], [F.count(F.lit(1)).alias("n"), F.count_if(X.label_matches("status", "5..")).alias("bad")],
        met, CM._hourly(AL.ERROR_RATIO), CM.HOUR, _LATE))
    return told.fired(["path"])


_TX_REACHED = """(SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL 2 HOUR FROM tx)"""


@query("stream_behaviour", "W4 W5 W6 S7 S8", f"""WITH {V.TX} {_behaviour_sql('tx')} WHERE "timestamp" <= {_TX_REACHED}""")
def stream_behaviour(spark: SparkSession, sf: str) -> DataFrame:
    """History per customer from the state store, for all rows the watermark has passed."""
    told = _run_parts(spark, sf, "behaviour", lambda feed: SB.history_stream(A.transactions_of(feed), _LATE), SB.HistoryTable)
    tx = A.transactions(spark, sf).select("transaction_id", "customer_id", "timestamp", "amount")
    return told.attach(tx).filter(F.col("tx_count_last_1h").isNotNull()).select(*_BEHAVIOUR)


@query("stream_first_seen", "W7 S7 S8", f"""WITH {V.TX}
SELECT transaction_id, is_new_device, is_new_merchant FROM (SELECT transaction_id, "timestamp",
  CASE WHEN row_number() OVER (PARTITION BY customer_id, device_type ORDER BY "timestamp", transaction_id) = 1
    THEN 1 ELSE 0 END AS is_new_device,
  CASE WHEN row_number() OVER (PARTITION BY customer_id, merchant_category ORDER BY "timestamp", transaction_id) = 1
    THEN 1 ELSE 0 END AS is_new_merchant FROM tx)
WHERE date_trunc('hour', "timestamp") + INTERVAL 1 HOUR <= {_TX_REACHED}""")
def stream_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """First device and first merchant per customer from the state store, for all hours the watermark has passed."""
    rows = A.transactions(spark, sf).select("transaction_id", "customer_id", "timestamp", "device_type", "merchant_category")
    reached = rows.agg(F.max(F.unix_millis("timestamp"))).first()[0]
    out = rows if reached is None else rows.filter(
        F.unix_millis(F.date_trunc("hour", "timestamp")) + SA.millis("1 hour") <= reached - SA.millis(_LATE))
    for what, flag in (("device_type", "is_new_device"), ("merchant_category", "is_new_merchant")):
        told = _run_parts(spark, sf, flag, lambda feed: SB.sighting_stream(A.transactions_of(feed), what, _LATE), SB.HistoryTable)
        out = told.attach_first(out, what, flag)
    return out.select("transaction_id", "is_new_device", "is_new_merchant")
