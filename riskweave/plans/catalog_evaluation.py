"""Queries on ranking metrics, thresholds, segments, gates and scoring output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators import drift as D
from riskweave.operators import evaluate as E
from riskweave.operators import gates as G
from riskweave.operators import split as SP
from riskweave.plans import sql_views as V
from riskweave.plans.registry import query
from riskweave.session import scratch_path
from riskweave.sources import adapters as A
from riskweave.sources import tables as TB

THRESHOLD = 0.4

_CURVE = """points AS (
  SELECT score AS threshold, CAST(sum(sum(label)) OVER w AS BIGINT) AS tp,
    CAST(sum(sum(1 - label)) OVER w AS BIGINT) AS fp, sum(label) AS pos, sum(1 - label) AS neg
  FROM scored GROUP BY score WINDOW w AS (ORDER BY score DESC)),
total AS (SELECT sum(label) AS p, sum(1 - label) AS n FROM scored),
curve AS (SELECT threshold, tp, fp, pos, neg, tp / (tp + fp) AS precision, tp / p AS recall,
  2 * tp / (tp + fp + p) AS f1 FROM points, total)"""


@query("pr_curve", "M2 W2", f"""WITH {V.SCORED}, {_CURVE}
SELECT threshold, tp, fp, precision, recall, f1 FROM curve UNION ALL SELECT NULL, 0, 0, 1.0, 0.0, 0.0""")
def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return E.pr_curve(A.scored(spark, sf))


_AP = "(SELECT sum(pos / p * precision) FROM curve, total)"
_AUC = "(SELECT sum(neg * (tp - pos + pos / 2.0)) / max(CAST(p AS DOUBLE) * n) FROM curve, total)"


@query("average_precision", "M3", f"WITH {V.SCORED}, {_CURVE} SELECT {_AP} AS average_precision")
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    return E.curve_metrics(A.scored(spark, sf)).select("average_precision")


@query("roc_auc", "M4", f"WITH {V.SCORED}, {_CURVE} SELECT {_AUC} AS roc_auc")
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return E.curve_metrics(A.scored(spark, sf)).select("roc_auc")


def _best(min_recall: float, max_threshold: float) -> str:
    rule = f"CASE WHEN recall >= {min_recall} AND threshold <= {max_threshold} THEN 1 " \
           f"WHEN recall >= {min_recall} THEN 2 ELSE 3 END"
    return f"""SELECT threshold, tp, fp, precision, recall, f1, {rule} AS rule,
  round(threshold, 4) AS threshold_4dp FROM curve
ORDER BY rule, CASE WHEN ({rule}) = 3 THEN recall ELSE precision END DESC, threshold LIMIT 1"""


@query("best_threshold", "M5 O6", f"WITH {V.SCORED}, {_CURVE} {_best(0.95, 0.70)}")
def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return E.best_threshold(A.scored(spark, sf))


@query("best_threshold_strict", "M5 O6", f"WITH {V.SCORED}, {_CURVE} {_best(0.999, 0.0001)}")
def best_threshold_strict(spark: SparkSession, sf: str) -> DataFrame:
    """No point meets the threshold limit, so the recall rule alone decides."""
    return E.best_threshold(A.scored(spark, sf), 0.999, 0.0001)


_MATRIX = f"""count(*) FILTER (WHERE score < {THRESHOLD} AND label = 0) AS tn,
  count(*) FILTER (WHERE score >= {THRESHOLD} AND label = 0) AS fp,
  count(*) FILTER (WHERE score < {THRESHOLD} AND label = 1) AS fn,
  count(*) FILTER (WHERE score >= {THRESHOLD} AND label = 1) AS tp"""


@query("confusion_matrix", "A12", f"WITH {V.SCORED} SELECT {_MATRIX} FROM scored")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return E.confusion(A.scored(spark, sf), THRESHOLD)


_POINT = "tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1"


@query("confusion_report", "M6 A12 A13", f"""WITH {V.SCORED}, {_CURVE}, m AS (SELECT {_MATRIX} FROM scored)
SELECT CAST({THRESHOLD} AS DOUBLE) AS threshold, tn, fp, fn, tp, {_POINT},
  {_AP} AS average_precision, {_AUC} AS roc_auc FROM m""")
def confusion_report(spark: SparkSession, sf: str) -> DataFrame:
    return E.metric_report(A.scored(spark, sf), THRESHOLD)


_SEGMENTS = f"""both_ AS (SELECT segment AS seg, score, label FROM scored UNION ALL SELECT 'ALL', score, label FROM scored),
seg_points AS (SELECT seg, score, sum(label) AS pos, sum(sum(label)) OVER w AS tp, sum(sum(1 - label)) OVER w AS fp
  FROM both_ GROUP BY seg, score WINDOW w AS (PARTITION BY seg ORDER BY score DESC)),
seg_ap AS (SELECT seg, sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc FROM seg_points GROUP BY seg),
seg_m AS (SELECT seg, count(*) AS n_samples, CAST(sum(label) AS BIGINT) AS n_fraud, {_MATRIX} FROM both_ GROUP BY seg)"""


@query("segment_report", "A15 M7 J5 D10", f"""WITH {V.SCORED}, {_SEGMENTS}
SELECT seg AS segment, n_samples, n_fraud, n_fraud / n_samples * 100 AS fraud_rate, {_POINT}, pr_auc
FROM seg_m JOIN seg_ap USING (seg)""")
def segment_report(spark: SparkSession, sf: str) -> DataFrame:
    return E.segment_report(A.scored(spark, sf), THRESHOLD)


@query("segment_labels", "J4", f"""WITH {V.SCORED}
SELECT CASE code WHEN 2 THEN '2' ELSE segment END AS segment, n FROM (
  SELECT segment, CASE segment WHEN 'INSPIRE' THEN 0 WHEN 'MASS' THEN 1 WHEN 'PRIORITY' THEN 2 ELSE 3 END AS code,
    count(*) AS n FROM scored GROUP BY segment)""")
def segment_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Codes back to labels, with one label missing from the code table."""
    coded = A.scored(spark, sf).withColumn(
        "segment", X.code_from("segment", {t: i for i, t in enumerate(S.CUSTOMER_TIERS)}, -1).cast("string"))
    codes = spark.createDataFrame(
        [("customer_tier", t, i) for i, t in enumerate(S.CUSTOMER_TIERS) if i != 2], S.CODES_SCHEMA)
    return E.named_segments(coded.groupBy("segment").agg(F.count(F.lit(1)).alias("n")), codes)


def _metrics_sql(part: str, name: str) -> str:
    return f"""{name}_s AS (SELECT * FROM parts WHERE part = '{part}'),
{name}_pts AS (SELECT score, sum(label) AS pos, sum(sum(label)) OVER w AS tp, sum(sum(1 - label)) OVER w AS fp
  FROM {name}_s GROUP BY score WINDOW w AS (ORDER BY score DESC)),
{name}_m AS (SELECT {_MATRIX} FROM {name}_s),
{name} AS (SELECT (SELECT sum(pos * tp / (tp + fp)) / sum(pos) FROM {name}_pts) AS pr_auc,
  2 * tp / (2 * tp + fp + fn) AS f1, tp / (tp + fn) AS recall FROM {name}_m)"""


_GATE_ROWS = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, base.{m} AS baseline, cur.{m} AS current, cur.{m} - base.{m} AS delta, "
    f"CAST({t} AS DOUBLE) AS tolerance FROM base, cur" for m, t in S.REGRESSION_TOLERANCE.items())


@query("regression_gate", "M8 J10", f"""WITH {V.SCORED}, {V.parts("scored")},
{_metrics_sql("train", "base")}, {_metrics_sql("test", "cur")}, rows_ AS ({_GATE_ROWS})
SELECT *, CASE WHEN delta >= -tolerance THEN 'PASS' ELSE 'FAIL' END AS status,
  CASE WHEN bool_and(delta >= -tolerance) OVER () THEN 'PASS' ELSE 'FAIL' END AS overall FROM rows_""")
def regression_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the latest fifth against those of the time before."""
    before, latest = SP.chrono_split(A.scored(spark, sf))
    return E.regression_gate(*[
        E.as_metrics(E.metric_report(part, THRESHOLD)) for part in (latest, before)])


@query("score_bands", "M9 F11 F12 F13 D6", f"""WITH {V.SCORED}
SELECT transaction_id, round(score, 6) AS fraud_score, CASE WHEN score >= {THRESHOLD} THEN 1 ELSE 0 END AS is_fraud_pred,
  {V.risk_band("score")} AS risk_level FROM scored""")
def score_bands(spark: SparkSession, sf: str) -> DataFrame:
    return E.score_bands(A.scored(spark, sf), THRESHOLD).select(
        "transaction_id", "fraud_score", "is_fraud_pred", "risk_level")


@query("batch_totals", "A14", f"""WITH {V.SCORED}
SELECT segment, count(*) AS total, count(*) FILTER (WHERE score >= {THRESHOLD}) AS fraud_detected,
  avg(CASE WHEN score >= {THRESHOLD} THEN 1 ELSE 0 END) AS fraud_rate FROM scored GROUP BY segment""")
def batch_totals(spark: SparkSession, sf: str) -> DataFrame:
    return E.batch_totals(E.score_bands(A.scored(spark, sf), THRESHOLD), ["segment"])


@query("top_score_row", "O3", f"""WITH {V.SCORED}
SELECT transaction_id, score FROM scored ORDER BY score DESC, transaction_id LIMIT 1""")
def top_score_row(spark: SparkSession, sf: str) -> DataFrame:
    return E.top_row(A.scored(spark, sf)).select("transaction_id", "score")


def _written_reports(spark: SparkSession, sf: str) -> str:
    folder = scratch_path(spark, "evaluation")
    scored = A.scored(spark, sf)
    TB.write_reports(folder, E.metric_report(scored, THRESHOLD), E.segment_report(scored, THRESHOLD))
    return folder


@query("evaluation_files", "S6 D10", f"""WITH {V.SCORED}, {_SEGMENTS}
SELECT seg AS segment, n_samples, n_fraud, n_fraud / n_samples * 100 AS fraud_rate, {_POINT}, pr_auc
FROM seg_m JOIN seg_ap USING (seg)""")
def evaluation_files(spark: SparkSession, sf: str) -> DataFrame:
    schema = ("segment string, n_samples long, n_fraud long, fraud_rate double, precision double, "
              "recall double, f1 double, pr_auc double")
    folder = _written_reports(spark, sf)
    return spark.read.schema(schema).option("header", True).csv(f"{folder}/segment_report.csv")


@query("evaluation_json", "S6 D9", f"""WITH {V.SCORED}, {_CURVE}, m AS (SELECT {_MATRIX} FROM scored)
SELECT CAST({THRESHOLD} AS DOUBLE) AS threshold, tn, fp, fn, tp, {_POINT},
  {_AP} AS average_precision, {_AUC} AS roc_auc FROM m""")
def evaluation_json(spark: SparkSession, sf: str) -> DataFrame:
    schema = ("threshold double, tn long, fp long, fn long, tp long, precision double, recall double, f1 double, "
              "average_precision double, roc_auc double")
    return spark.read.schema(schema).json(f"{_written_reports(spark, sf)}/evaluation.json")


@query("latest_per_group", "A19 D14", """SELECT user_id, event_type, max_by(value, (ts, event_id)) AS value
FROM events WHERE event_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
GROUP BY user_id, event_type""")
def latest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    events = A.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    excluded = A.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").alias("event_id"))
    return G.latest_per_group(events, ["user_id", "event_type"], ["ts", "event_id"], "value", excluded, "event_id")


_HISTORY = """history AS (SELECT user_id, ts, event_id,
  CASE WHEN event_id % 3 <> 0 THEN value / 100.0 END AS metric FROM events),
recent AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM history),
latest AS (SELECT user_id, max_by(metric, (ts, event_id)) AS metric FROM recent
  WHERE rn <= {k} AND metric IS NOT NULL GROUP BY user_id)"""


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value") / 100.0).alias("metric"))


@query("quality_gate", "M13 O8 F17", f"""WITH {_HISTORY.format(k=25)},
series AS (SELECT DISTINCT user_id FROM events)
SELECT user_id, metric, CASE WHEN metric >= 0.35 THEN 0 ELSE 1 END AS retrain
FROM series LEFT JOIN latest USING (user_id)""")
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    series = A.table(spark, sf, "events").select("user_id").distinct()
    latest = G.latest_measured(_history(spark, sf), "user_id", ["ts", "event_id"], "metric", 25)
    return G.quality_gate(series, latest, "user_id", "metric", 35.0)


@query("sample_reference", "O4 S9", f"""WITH {V.TX}, {V.parts("tx")}
SELECT transaction_id, amount FROM parts WHERE part = 'train'
ORDER BY (((CAST(transaction_id AS BIGINT) % 2147483647) * 2654435761) % 4294967296), transaction_id LIMIT 2000""")
def sample_reference(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "reference")
    train, test = SP.chrono_split(A.transactions(spark, sf))
    TB.write_split(train, test, folder)
    key = X.spread_key(F.col("transaction_id").cast("long"))
    TB.ensure_drift_reference(spark, folder, key, "transaction_id")
    mode, reference = TB.preferred_reference(spark, folder)
    if mode != S.MODE_TRAIN:
        raise ValueError(f"reference came from {mode}")
    return reference.select("transaction_id", "amount")


@query("warmup_reference", "R9 T7", f"""WITH {V.LOG}, firsts AS (
  SELECT slot, request_id, row_number() OVER (PARTITION BY slot ORDER BY ts, request_id) AS row_no FROM log)
SELECT slot, request_id, CAST(row_no AS INT) AS row_no FROM firsts WHERE row_no <= 2000""")
def warmup_reference(spark: SparkSession, sf: str) -> DataFrame:
    log = A.requests(spark, sf).select("slot", "ts", "request_id")
    return D.warmup_rows(log, ["slot"], "ts", "request_id").drop("ts")
