"""Queries on request counters, histograms, rates, panels and alerts.

The event tables hold a few rows per hour, so the alert rules run with hours
in place of the rules' minutes; the limits are the rules' own.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators import alerts as AL
from riskweave.operators import drift as D
from riskweave.operators import metrics as M
from riskweave.plans import catalog_drift as CD
from riskweave.plans import sql_views as V
from riskweave.plans.registry import query
from riskweave.sources import adapters as A

THRESHOLD = 0.4
HOUR = "1 hour"


def _hourly(rule: AL.Rule) -> AL.Rule:
    return replace(rule, width=rule.width.replace("minute", "hour"), hold=rule.hold.replace("minute", "hour"))


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return A.requests(spark, sf)


@query("request_counts", "T1 D13", f"""WITH {V.LOG}
SELECT date_trunc('hour', ts) AS step, method, path, status, count(*) AS n FROM log GROUP BY ALL""")
def request_counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.request_counts(_log(spark, sf), HOUR)


PREDICTIONS = f"""predictions AS (SELECT date_trunc('hour', ts) AS step, slot, count(*) AS samples,
  count(*) FILTER (WHERE score >= {THRESHOLD}) AS frauds, count(*) FILTER (WHERE score < 0.3) AS low,
  count(*) FILTER (WHERE score >= 0.3 AND score < 0.6) AS medium, count(*) FILTER (WHERE score >= 0.6) AS high,
  0::BIGINT AS unknown FROM log GROUP BY 1, 2)"""


@query("prediction_counts", "T1", f"WITH {V.LOG}, {PREDICTIONS} SELECT * FROM predictions")
def prediction_counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.prediction_counts(_log(spark, sf), THRESHOLD, HOUR, ["slot"])


def _ranged(table: str, hours: int, labels: str, sums: str) -> str:
    """Sums over the last ``hours`` at every hour from hourly rows."""
    totals = ", ".join(f"CAST(sum({c.strip()}) AS BIGINT) AS {c.strip()}" for c in sums.split(","))
    keys = f", {labels}" if labels else ""
    return f"""(SELECT step + to_hours(i) AS at_time{keys}, {totals}
  FROM {table}, (SELECT CAST(unnest(range(1, {hours} + 1)) AS INT) AS i) GROUP BY ALL)"""


@query("risk_mix", "T1 T9 F20", f"""WITH {V.LOG}, {PREDICTIONS}
SELECT at_time, slot, upper(level) AS risk_level, n FROM (
  SELECT at_time, slot, unnest(['low', 'medium', 'high', 'unknown']) AS level, unnest([low, medium, high, unknown]) AS n
  FROM {_ranged("predictions", 15, "slot", "low, medium, high, unknown")})""")
def risk_mix(spark: SparkSession, sf: str) -> DataFrame:
    counts = M.prediction_counts(_log(spark, sf), THRESHOLD, HOUR, ["slot"])
    ranges = M.over_range(counts, ["slot"], ["low", "medium", "high", "unknown"], "15 hours", HOUR)
    return M.risk_mix(ranges, ["at_time", "slot"])


_PER_PATH = """per_path AS (SELECT date_trunc('hour', ts) AS step, path, count(*) AS n FROM log
  WHERE path <> 'view' GROUP BY ALL)"""


@query("request_rate", "T3 T9 F19", f"""WITH {V.LOG}, {_PER_PATH}
SELECT at_time, path, n / 18000.0 AS per_second FROM {_ranged("per_path", 5, "path", "n")}""")
def request_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Requests per second over five hours, every hour, one path left out."""
    log = _log(spark, sf).filter(~X.label_matches("path", "view"))
    ranges = M.over_range(M.request_counts(log, HOUR, ["path"]), ["path"], ["n"], "5 hours", HOUR)
    return ranges.select("at_time", "path", M.rate("n", 18000.0).alias("per_second"))


def _histogram(value: str, bounds, labels: str = "path", step: str = "hour") -> str:
    les = ", ".join(f"count(*) FILTER (WHERE {value} <= {b}) AS le_{i}" for i, b in enumerate(bounds))
    return f"""hist AS (SELECT date_trunc('{step}', ts) AS step, {labels}, {les},
  count({value}) AS observed, sum({value}) AS total FROM log GROUP BY ALL)"""


def _exposed(bounds, keys: str) -> str:
    les = ", ".join(f"'{b}'" for b in bounds)
    counts = ", ".join(f"le_{i}" for i in range(len(bounds)))
    return f"SELECT {keys}, unnest([{les}, '+Inf']) AS le, unnest([{counts}, observed]) AS n FROM hist"


@query("latency_buckets", "T2 J8 F14", f"""WITH {V.LOG}, {_histogram("latency_s", S.LATENCY_BOUNDS, step="day")}
{_exposed(S.LATENCY_BOUNDS, "step, path")}""")
def latency_buckets(spark: SparkSession, sf: str) -> DataFrame:
    wide = M.histogram(_log(spark, sf), "ts", "latency_s", S.LATENCY_BOUNDS, ["path"], "1 day")
    return M.bucket_rows(wide, ["step", "path"], S.LATENCY_BOUNDS)


_AMOUNT_BOUNDS = tuple(b / 10000 for b in S.AMOUNT_BOUNDS)


@query("amount_buckets", "T2", f"""WITH {V.LOG}, {_histogram("nullif(greatest(amount, 0), 0)", _AMOUNT_BOUNDS, "slot", "day")}
{_exposed(_AMOUNT_BOUNDS, "step, slot")}""")
def amount_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts of this table are small, so the bounds are read in units of 10,000."""
    wide = M.histogram(_log(spark, sf), "ts", "amount", _AMOUNT_BOUNDS, ["slot"], "1 day", positive=True)
    return M.bucket_rows(wide, ["step", "slot"], _AMOUNT_BOUNDS)


def quantile_sql(phi: float, bounds) -> str:
    """Interpolated bucket quantile of a row with le_* and observed."""
    rank = f"({phi} * observed)"
    cases, low, below = [], "0.0", "0"
    for i, b in enumerate(bounds):
        cases.append(f"WHEN le_{i} >= {rank} THEN {low}::DOUBLE + ({b}::DOUBLE - {low}::DOUBLE) * "
                     f"(({rank}::DOUBLE - {below}) / (le_{i} - {below}))")
        low, below = str(b), f"le_{i}"
    return f"CASE WHEN observed = 0 THEN NULL {' '.join(cases)} ELSE {float(bounds[-1])}::DOUBLE END"


_LE = ", ".join(f"le_{i}" for i in range(len(S.LATENCY_BOUNDS))) + ", observed"


@query("latency_p95", "T4 T9", f"""WITH {V.LOG}, {_histogram("latency_s", S.LATENCY_BOUNDS)}
SELECT at_time, path, {quantile_sql(0.95, S.LATENCY_BOUNDS)} AS p95 FROM {_ranged("hist", 5, "path", _LE)}""")
def latency_p95(spark: SparkSession, sf: str) -> DataFrame:
    hist = M.histogram(_log(spark, sf), "ts", "latency_s", S.LATENCY_BOUNDS, ["path"], HOUR)
    ranges = M.over_range(hist, ["path"], M.histogram_columns(S.LATENCY_BOUNDS), "5 hours", HOUR)
    return ranges.select("at_time", "path", M.histogram_quantile(0.95, S.LATENCY_BOUNDS).alias("p95"))


_SCORE_LE = ", ".join(f"le_{i}" for i in range(len(S.SCORE_BOUNDS))) + ", observed"


@query("score_quantiles", "T4 T9", f"""WITH {V.LOG}, {_histogram("score", S.SCORE_BOUNDS, "slot")}
SELECT at_time, slot, {quantile_sql(0.5, S.SCORE_BOUNDS)} AS p50, {quantile_sql(0.95, S.SCORE_BOUNDS)} AS p95
FROM {_ranged("hist", 5, "slot", _SCORE_LE)}""")
def score_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    hist = M.histogram(_log(spark, sf), "ts", "score", S.SCORE_BOUNDS, ["slot"], HOUR)
    ranges = M.over_range(hist, ["slot"], M.histogram_columns(S.SCORE_BOUNDS), "5 hours", HOUR)
    return ranges.select("at_time", "slot", M.histogram_quantile(0.5, S.SCORE_BOUNDS).alias("p50"),
                         M.histogram_quantile(0.95, S.SCORE_BOUNDS).alias("p95"))


_OVERALL = "overall AS (SELECT step, sum(samples) AS samples, sum(frauds) AS frauds FROM predictions GROUP BY step)"


@query("fraud_rate_15", "T3 T9 F18", f"""WITH {V.LOG}, {PREDICTIONS}, {_OVERALL}
SELECT at_time, samples, frauds, frauds / greatest(samples, 1.0::DOUBLE) AS fraud_rate
FROM {_ranged("overall", 15, "", "samples, frauds")}""")
def fraud_rate_15(spark: SparkSession, sf: str) -> DataFrame:
    counts = M.prediction_counts(_log(spark, sf), THRESHOLD, HOUR, ["slot"])
    ranges = M.over_range(counts, [], ["samples", "frauds"], "15 hours", HOUR)
    return ranges.withColumn("fraud_rate", F.col("frauds") / X.clamp_min(F.col("samples").cast("double"), 1.0))


def _islands(measured: str, cond: str, rule: AL.Rule, labels: str = "", absent: str = "false") -> str:
    """Firing stretches of ``cond`` on the hourly grid over ``measured`` (at_time, labels, ..)."""
    keys = f", {labels}" if labels else ""
    cross = f", (SELECT DISTINCT {labels} FROM m)" if labels else ""
    same = f" AND m.{labels} = g.{labels}" if labels else ""
    part = f"PARTITION BY {labels}" if labels else ""
    shown = f", {labels}" if labels else ""
    hold = int(rule.hold.split()[0])
    return f"""m AS ({measured}),
hour_grid AS (SELECT at_time{keys} FROM (SELECT unnest(generate_series(min(at_time), max(at_time), INTERVAL 1 HOUR)) AS at_time FROM m){cross}),
checked AS (SELECT g.at_time{', g.' + labels if labels else ''}, CASE WHEN m.at_time IS NULL THEN {absent}
  ELSE coalesce({cond}, false) END AS cond FROM hour_grid g LEFT JOIN m ON m.at_time = g.at_time{same}),
numbered AS (SELECT *, sum(CASE WHEN cond THEN 0 ELSE 1 END) OVER ({part} ORDER BY at_time) AS island FROM checked),
stretches AS (SELECT min(at_time) AS pending_from, max(at_time) AS firing_to{shown} FROM numbered WHERE cond GROUP BY island{shown})
SELECT '{rule.name}' AS alert, '{rule.severity}' AS severity, pending_from,
  pending_from + to_hours({hold}) AS firing_from, firing_to{shown}
FROM stretches WHERE pending_from + to_hours({hold}) <= firing_to"""


_FLAGGED = """flagged AS (SELECT date_trunc('hour', ts) AS step, count(*) AS n,
  count(*) FILTER (WHERE status LIKE '5__') AS bad FROM log GROUP BY ALL)"""


@query("error_ratio_alert", "T5 W8 F18 F19", f"""WITH {V.LOG}, {_FLAGGED}, {_islands(
    f"SELECT * FROM {_ranged('flagged', 5, '', 'n, bad')}",
    "(bad / 18000.0) / greatest(n / 18000.0, 0.0001) > 0.05", _hourly(AL.ERROR_RATIO))}""")
def error_ratio_alert(spark: SparkSession, sf: str) -> DataFrame:
    counts = M.request_counts(_log(spark, sf), HOUR, ["status"])
    return AL.error_ratio(counts, _hourly(AL.ERROR_RATIO), HOUR, 18000.0, floor=0.0001)


_TARGET = "path || '-' || status || '-' || slot"


@query("target_absent_alert", "T5 W8", f"""WITH {V.LOG}, {_islands(
    f"SELECT date_trunc('hour', ts) AS at_time, {_TARGET} AS target, count(*) AS n FROM log GROUP BY ALL",
    "n = 0", _hourly(AL.TARGET_DOWN), "target", "true")}""")
def target_absent_alert(spark: SparkSession, sf: str) -> DataFrame:
    """Targets are the combinations of path, status and slot."""
    log = _log(spark, sf).withColumn("target", F.concat_ws("-", "path", "status", "slot"))
    counts = M.request_counts(log, HOUR, ["target"])
    return AL.absent_targets(counts, _hourly(AL.TARGET_DOWN), HOUR, "target")


_HIST_ALL = _histogram("latency_s", S.LATENCY_BOUNDS)


@query("latency_alert", "T5 T4 W8", f"""WITH {V.LOG}, {_HIST_ALL}, {_islands(
    f"SELECT at_time, {quantile_sql(0.95, S.LATENCY_BOUNDS)} AS p95 FROM {_ranged('hist', 5, '', _LE)}",
    "p95 > 1.0", _hourly(AL.LATENCY_P95))}""")
def latency_alert(spark: SparkSession, sf: str) -> DataFrame:
    hist = M.histogram(_log(spark, sf), "ts", "latency_s", S.LATENCY_BOUNDS, [], HOUR)
    ranges = M.over_range(hist, [], M.histogram_columns(S.LATENCY_BOUNDS), "5 hours", HOUR).select(
        "at_time", M.histogram_quantile(0.95, S.LATENCY_BOUNDS).alias("p95"))
    return AL.threshold_alert(ranges, "at_time", F.col("p95") > AL.LATENCY_LIMIT, _hourly(AL.LATENCY_P95), HOUR)


@query("model_loaded_alert", "T5 A18 W8", f"""WITH {V.LOG}, {_islands(
    "SELECT date_trunc('hour', ts) AS at_time, min(CASE WHEN latency_s < 1 THEN 1 ELSE 0 END) AS loaded FROM log GROUP BY ALL",
    "loaded < 1", _hourly(AL.MODEL_NOT_LOADED))}""")
def model_loaded_alert(spark: SparkSession, sf: str) -> DataFrame:
    """A slow answer stands for an instance that reports no model."""
    gauge = _log(spark, sf).select("ts", (F.col("latency_s") < 1).cast("int").alias("loaded"))
    lowest = M.per_step(gauge, "ts", [], [F.min("loaded").alias("loaded")], HOUR).withColumnRenamed("step", "at_time")
    return AL.threshold_alert(lowest, "at_time", F.col("loaded") < 1, _hourly(AL.MODEL_NOT_LOADED), HOUR)


_WINDOWED_HOURS = CD._WINDOWED.replace("date_trunc('day', ts)", "date_trunc('hour', ts)")


@query("drift_ratio_alert", "T5 R7 W8", f"""WITH {V.LOG}, {_WINDOWED_HOURS}, {_islands(
    "SELECT window_start AS at_time, avg(CASE WHEN round(score, 6) >= 0.2 THEN 1 ELSE 0 END) AS ratio FROM day_scores GROUP BY 1",
    "ratio > 0.2", _hourly(AL.DRIFT_RATIO))}""")
def drift_ratio_alert(spark: SparkSession, sf: str) -> DataFrame:
    scores = D.with_alerts(CD._windowed(spark, sf, HOUR))
    ratios = scores.groupBy(F.col("window_start").alias("at_time")).agg(F.avg("alert").alias("ratio"))
    return AL.threshold_alert(ratios, "at_time", F.col("ratio") > AL.DRIFT_LIMIT, _hourly(AL.DRIFT_RATIO), HOUR)


_SIDES = """sides AS (SELECT c.at_time, c.samples / 36000.0 AS candidate_traffic,
  (c.frauds / 36000.0) / greatest(c.samples / 36000.0, 0.001) AS candidate_fraud_rate,
  s.samples / 36000.0 AS stable_traffic, (s.frauds / 36000.0) / greatest(s.samples / 36000.0, 0.001) AS stable_fraud_rate
  FROM ranges c JOIN ranges s ON c.at_time = s.at_time AND c.slot = 'candidate' AND s.slot = 'stable')"""


@query("canary_compare", "T11 J9 F18 F23", f"""WITH {V.LOG}, {PREDICTIONS},
ranges AS {_ranged("predictions", 10, "slot", "samples, frauds")}, {_SIDES} SELECT * FROM sides""")
def canary_compare(spark: SparkSession, sf: str) -> DataFrame:
    counts = M.prediction_counts(_log(spark, sf), THRESHOLD, HOUR, ["slot"])
    return AL.slot_rates(counts, "10 hours", HOUR, 36000.0)


@query("candidate_alert", "T5 T11 J9 W8", f"""WITH {V.LOG}, {PREDICTIONS},
ranges AS {_ranged("predictions", 10, "slot", "samples, frauds")}, {_SIDES}, {_islands(
    "SELECT * FROM sides",
    "candidate_traffic > 0.0001 AND candidate_fraud_rate < stable_fraud_rate * 0.7",
    replace(_hourly(AL.CANDIDATE_REGRESSION), hold="3 hours"))}""")
def candidate_alert(spark: SparkSession, sf: str) -> DataFrame:
    counts = M.prediction_counts(_log(spark, sf), THRESHOLD, HOUR, ["slot"])
    rule = replace(_hourly(AL.CANDIDATE_REGRESSION), hold="3 hours")
    return AL.candidate_regression(counts, rule, HOUR, 36000.0, traffic=0.0001)


@query("canary_split", "F23 D14", f"""WITH {V.LOG} SELECT slot, count(*) AS n, min(request_id) AS first_request,
  avg(latency_s) AS mean_latency_s FROM log GROUP BY slot""")
def canary_split(spark: SparkSession, sf: str) -> DataFrame:
    return _log(spark, sf).groupBy("slot").agg(
        F.count(F.lit(1)).alias("n"), F.min("request_id").alias("first_request"),
        F.avg("latency_s").alias("mean_latency_s"))


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    """Metric samples with labels: a saw-tooth counter and gauges per event."""
    e, u = F.col("event_id"), F.col("user_id")
    labels = F.create_map(
        F.lit("instance"), F.concat(F.lit("node-"), (u % 4).cast("string")),
        F.lit("mode"), F.when(e % 2 == 0, "idle").otherwise("user"),
        F.lit("mountpoint"), F.when(e % 3 == 0, "/").otherwise("/data"),
        F.lit("fstype"), F.when(e % 5 == 0, "tmpfs").when(e % 5 == 1, "overlay").otherwise("ext4"),
        F.lit("id"), F.concat(F.lit("/docker/"), F.lpad(F.lower(F.hex(u)), 12, "0"), F.lit("abc")),
        F.lit("image"), F.when(e % 7 == 0, "").otherwise(F.col("event_type")))
    return A.table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), e.alias("sample_id"), labels.alias("labels"),
        (e % 500).cast("double").alias("counter"), F.col("value").alias("gauge"), F.col("event_type").alias("path"))


_COUNTER = """growth AS (SELECT path, step, coalesce(sum(CASE WHEN v < before THEN v ELSE v - before END), 0.0) AS increase
  FROM (SELECT event_type AS path, date_trunc('hour', ts) AS step, CAST(event_id % 500 AS DOUBLE) AS v,
    lag(CAST(event_id % 500 AS DOUBLE)) OVER (PARTITION BY event_type ORDER BY ts, event_id % 500) AS before FROM events)
  GROUP BY 1, 2)"""


@query("counter_rate", "W9 T3", f"WITH {_COUNTER} SELECT * FROM growth")
def counter_rate(spark: SparkSession, sf: str) -> DataFrame:
    return M.counter_increase(_samples(spark, sf).select("path", "ts", "counter"), ["path"], "ts", "counter", HOUR)


@query("counter_rate_extrapolated", "W9 T3", """WITH samples AS (
  SELECT DISTINCT event_type AS path, ts, CAST(event_id % 500 AS DOUBLE) AS v FROM events),
lagged AS (SELECT *, lag(v) OVER (PARTITION BY path ORDER BY ts, v) AS before FROM samples),
spread AS (SELECT l.*, date_trunc('hour', ts) + to_hours(CAST(k AS INT)) AS at_time FROM lagged l, range(1, 6) r(k)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY path, at_time ORDER BY ts, v) AS rn FROM spread),
ranges AS (SELECT path, at_time, count(*) AS n, sum(CASE WHEN rn = 1 THEN 0.0 WHEN v < before THEN v ELSE v - before END) AS growth,
  (min(epoch_us(ts)) - epoch_us(at_time - INTERVAL 5 HOUR)) / 1e6 AS gap_start, (epoch_us(at_time) - max(epoch_us(ts))) / 1e6 AS gap_end,
  (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS sampled, max(CASE WHEN rn = 1 THEN v END) AS first_v FROM numbered GROUP BY 1, 2),
reached AS (SELECT *, sampled / (n - 1) AS mean FROM ranges WHERE sampled > 0),
edges AS (SELECT *, CASE WHEN gap_start >= mean * 1.1 THEN mean / 2 ELSE gap_start END AS to_start,
  CASE WHEN gap_end >= mean * 1.1 THEN mean / 2 ELSE gap_end END AS to_end,
  CASE WHEN growth > 0 AND first_v >= 0 THEN sampled * first_v / growth END AS to_zero FROM reached),
grown AS (SELECT *, growth * (sampled + least(to_start, to_zero) + to_end) / sampled AS increase FROM edges)
SELECT path, at_time, n, growth, increase, increase / 18000.0 AS rate_per_s FROM grown""")
def counter_rate_extrapolated(spark: SparkSession, sf: str) -> DataFrame:
    """Growth over five hours at every hour, carried out to the edges of the range."""
    return M.counter_rates(_samples(spark, sf).select("path", "ts", "counter"), ["path"], "ts", "counter", "5 hours", HOUR)


@query("last_value", "W10", """SELECT date_trunc('hour', ts) AS step, event_type AS path,
  max_by(value, (ts, event_id)) AS gauge FROM events GROUP BY 1, 2""")
def last_value(spark: SparkSession, sf: str) -> DataFrame:
    return M.last_over(_samples(spark, sf), ["path"], "ts", "gauge", "sample_id", HOUR)


_IDLE = """idle AS (SELECT instance, step, coalesce(sum(CASE WHEN v < before THEN v ELSE v - before END), 0.0) AS increase
  FROM (SELECT 'node-' || (user_id % 4) AS instance, date_trunc('day', ts) AS step, CAST(event_id % 500 AS DOUBLE) AS v,
    lag(CAST(event_id % 500 AS DOUBLE)) OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id % 500) AS before
    FROM events WHERE event_id % 2 = 0) GROUP BY 1, 2)"""


@query("cpu_panel", "T10 W9 A18", f"""WITH {_IDLE}
SELECT instance, step, 100 - increase / 86400.0 * 100 AS busy_pct FROM idle""")
def cpu_panel(spark: SparkSession, sf: str) -> DataFrame:
    idle = _samples(spark, sf).select(
        F.col("labels")["instance"].alias("instance"), F.col("labels")["mode"].alias("mode"), "ts", "counter"
    ).filter(X.label_matches("mode", "idle"))
    growth = M.counter_increase(idle.drop("mode"), ["instance"], "ts", "counter", "1 day")
    return growth.select("instance", "step", (100 - M.rate("increase", 86400.0) * 100).alias("busy_pct"))


@query("memory_panel", "T10 F21 W10", """SELECT step, instance, 100 * (1 - gauge / 500.0) AS used_pct FROM (
  SELECT date_trunc('day', ts) AS step, 'node-' || (user_id % 4) AS instance, max_by(value, (ts, event_id)) AS gauge
  FROM events GROUP BY 1, 2)""")
def memory_panel(spark: SparkSession, sf: str) -> DataFrame:
    samples = _samples(spark, sf).withColumn("instance", F.col("labels")["instance"])
    last = M.last_over(samples, ["instance"], "ts", "gauge", "sample_id", "1 day")
    return last.select("step", "instance", X.used_percent("gauge", F.lit(500.0)).alias("used_pct"))


@query("disk_panel", "T10 F19 F21", """SELECT step, instance, 100 * (1 - gauge / 500.0) AS used_pct FROM (
  SELECT date_trunc('day', ts) AS step, 'node-' || (user_id % 4) AS instance, max_by(value, (ts, event_id)) AS gauge
  FROM events WHERE event_id % 3 = 0 AND event_id % 5 > 1 GROUP BY 1, 2)""")
def disk_panel(spark: SparkSession, sf: str) -> DataFrame:
    samples = _samples(spark, sf).filter(
        X.label_matches(F.col("labels")["mountpoint"], "/")
        & ~X.label_matches(F.col("labels")["fstype"], "tmpfs|overlay"))
    last = M.last_over(samples.withColumn("instance", F.col("labels")["instance"]),
                       ["instance"], "ts", "gauge", "sample_id", "1 day")
    return last.select("step", "instance", X.used_percent("gauge", F.lit(500.0)).alias("used_pct"))


@query("container_panel", "T10 F19 F22 A18", """SELECT lpad(lower(to_hex(user_id)), 12, '0') AS container,
  max(value) AS max_value, min(value) AS min_value, sum(value) AS sum_value, avg(value) AS avg_value
  FROM events WHERE event_id % 7 <> 0 GROUP BY 1""")
def container_panel(spark: SparkSession, sf: str) -> DataFrame:
    samples = _samples(spark, sf).filter(
        X.label_matches(F.col("labels")["id"], "/docker/[0-9a-f]+")
        & ~X.label_matches(F.col("labels")["image"], ""))
    named = samples.withColumn("container", X.relabel(F.col("labels")["id"], "/docker/([0-9a-f]{12}).*"))
    return M.aggregate_by(named, ["container"], "gauge")


_DOCKER = """docker AS (SELECT lpad(lower(to_hex(user_id)), 12, '0') AS container, event_id, ts, value,
  CAST(event_id % 500 AS DOUBLE) AS v FROM events WHERE event_id % 7 <> 0)"""


def _docker(spark: SparkSession, sf: str) -> DataFrame:
    samples = _samples(spark, sf).filter(
        X.label_matches(F.col("labels")["id"], "/docker/[0-9a-f]+") & ~X.label_matches(F.col("labels")["image"], ""))
    return samples.withColumn("container", X.relabel(F.col("labels")["id"], "/docker/([0-9a-f]{12}).*"))


@query("container_cpu_panel", "T10 W9", f"""WITH {_DOCKER}, steps AS (
  SELECT container, date_trunc('day', ts) AS step, CASE WHEN v < before THEN v ELSE v - before END AS delta
  FROM (SELECT *, lag(v) OVER (PARTITION BY container ORDER BY ts, v) AS before FROM (SELECT DISTINCT container, ts, v FROM docker)))
SELECT container, step, coalesce(sum(delta), 0.0) / 86400.0 AS per_second FROM steps GROUP BY 1, 2""")
def container_cpu_panel(spark: SparkSession, sf: str) -> DataFrame:
    growth = M.counter_increase(_docker(spark, sf), ["container"], "ts", "counter", "1 day")
    return growth.select("container", "step", M.rate("increase", 86400.0).alias("per_second"))


@query("container_memory_panel", "T10 A18", f"""WITH {_DOCKER}, lasts AS (
  SELECT date_trunc('day', ts) AS step, container, event_id % 3 AS series, max_by(value, (ts, event_id)) AS gauge FROM docker GROUP BY 1, 2, 3)
SELECT step, container, sum(gauge) AS total FROM lasts GROUP BY 1, 2""")
def container_memory_panel(spark: SparkSession, sf: str) -> DataFrame:
    series = _docker(spark, sf).withColumn("series", F.pmod(F.col("sample_id"), F.lit(3)))
    last = M.last_over(series, ["container", "series"], "ts", "gauge", "sample_id", "1 day")
    return last.groupBy("step", "container").agg(F.sum("gauge").alias("total"))


@query("memory_ratio_panel", "T10 F21 W10", """WITH g AS (
  SELECT date_trunc('day', ts) AS step, 'node-' || (user_id % 4) AS instance, event_id % 2 AS side, max_by(value, (ts, event_id)) AS gauge
  FROM events GROUP BY 1, 2, 3)
SELECT a.step, a.instance, 100 * (1 - a.gauge / nullif(t.gauge, 0)) AS used_pct
FROM g a JOIN g t ON t.step = a.step AND t.instance = a.instance WHERE a.side = 0 AND t.side = 1""")
def memory_ratio_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Two gauge series, matched by step and label."""
    samples = _samples(spark, sf).withColumn("instance", F.col("labels")["instance"])
    sides = [M.last_over(samples.filter(F.pmod(F.col("sample_id"), F.lit(2)) == side), ["instance"], "ts", "gauge", "sample_id", "1 day")
             .withColumnRenamed("gauge", name) for side, name in ((0, "available"), (1, "total"))]
    return sides[0].join(sides[1], ["step", "instance"]).select(
        "step", "instance", X.used_percent("available", "total").alias("used_pct"))


@query("run_summary", "A20", f"""WITH {V.LOG} SELECT path, count(*) AS total,
  count(*) FILTER (WHERE CAST(status AS INT) < 400) AS success, count(*) FILTER (WHERE CAST(status AS INT) >= 400) AS failed,
  avg(latency_s) AS mean_latency_s, count(*) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6) AS rate_per_s
FROM log GROUP BY path""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.run_summary(_log(spark, sf))


@query("window_health", "T9 A18", f"""WITH {V.LOG}, sizes AS (
  SELECT slot, count(*) FILTER (WHERE side = 0) AS reference_rows, least(count(*) FILTER (WHERE side = 1), 500) AS current_rows
  FROM (SELECT slot, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 0 ELSE 1 END AS side FROM log) GROUP BY slot)
SELECT max(reference_rows) AS reference_rows, max(current_rows) AS current_rows,
  max(CASE WHEN reference_rows >= 100 THEN 1 ELSE 0 END) AS baseline_ready FROM sizes""")
def window_health(spark: SparkSession, sf: str) -> DataFrame:
    early = F.col("ts") < F.lit("2024-01-20").cast("timestamp")
    sizes = _log(spark, sf).groupBy("slot").agg(
        F.count_if(early).alias("reference_rows"),
        F.least(F.count_if(~early), F.lit(S.DRIFT_WINDOW).cast("long")).alias("current_rows"))
    return sizes.agg(
        F.max("reference_rows").alias("reference_rows"), F.max("current_rows").alias("current_rows"),
        F.max((F.col("reference_rows") >= S.DRIFT_WARMUP_ROWS).cast("int")).alias("baseline_ready"))
