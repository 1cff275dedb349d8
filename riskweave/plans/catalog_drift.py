"""Queries on drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators import drift as D
from riskweave.plans import sql_views as V
from riskweave.plans.registry import query
from riskweave.sources import adapters as A

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
CUT = "1999-01-01"


def long_sql(view: str, features, side: str) -> str:
    return "long AS (" + " UNION ALL ".join(
        f"SELECT {side} AS side, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {view}" for f in features) + ")"


# takes "long" (side 0 = reference, 1 = current; no nulls) to "scores"
SCORES = f"""kinds AS (SELECT feature, count(DISTINCT v) <= {S.CATEGORY_LIMIT}
    AND bool_and(abs(v - round_even(v, 0)) <= 1e-9 + 1e-5 * abs(round_even(v, 0))) AS cat FROM long GROUP BY feature),
refs AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS k,
    count(*) OVER (PARTITION BY feature) AS n FROM long WHERE side = 0),
grid AS (SELECT feature, i, (i * (n - 1)) // 10 AS k, CAST((i * (n - 1)) % 10 AS DOUBLE) / 10 AS rest, n
    FROM (SELECT feature, max(n) AS n FROM refs GROUP BY feature), (SELECT unnest(range(11)) AS i)),
edges AS (SELECT DISTINCT g.feature, lo.v + (hi.v - lo.v) * g.rest AS edge FROM grid g
    JOIN refs lo ON lo.feature = g.feature AND lo.k = g.k
    JOIN refs hi ON hi.feature = g.feature AND hi.k = least(g.k + 1, g.n - 1)),
inner_edges AS (SELECT feature, edge FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY edge) AS a,
    count(*) OVER (PARTITION BY feature) AS m FROM edges) WHERE a > 1 AND a < m),
sizes AS (SELECT side, feature, CAST(count(*) AS DOUBLE) AS n FROM long GROUP BY side, feature),
vals AS (SELECT l.feature, l.side, l.v, count(*) AS c FROM long l GROUP BY 1, 2, 3),
slots AS (SELECT v.feature, v.side, v.v, v.c, k.cat, CASE WHEN k.cat THEN v.v ELSE
    (SELECT count(*) FROM inner_edges e WHERE e.feature = v.feature AND e.edge <= v.v) END AS slot
    FROM vals v JOIN kinds k ON k.feature = v.feature),
shares AS (SELECT s.feature, s.cat, s.slot,
    coalesce(sum(c) FILTER (WHERE s.side = 0), 0) / max(r.n) AS p, coalesce(sum(c) FILTER (WHERE s.side = 1), 0) / max(u.n) AS q
    FROM slots s JOIN sizes r ON r.feature = s.feature AND r.side = 0 JOIN sizes u ON u.feature = s.feature AND u.side = 1
    GROUP BY s.feature, s.cat, s.slot),
scores AS (SELECT feature, CASE WHEN cat THEN 'categorical' ELSE 'psi' END AS kind, least(greatest(sum(
    CASE WHEN cat THEN 0.5 * abs(p - q) ELSE (greatest(q, 1e-6) - greatest(p, 1e-6))
    * ln(greatest(q, 1e-6) / greatest(p, 1e-6)) END), 0.0), 1.0) AS score FROM shares GROUP BY feature, cat)"""

_LINES = long_sql("lineitem", FEATURES, f"CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END")


def _lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = A.table(spark, sf, "lineitem").select(*FEATURES, "l_shipdate")
    cut = F.lit(CUT).cast("timestamp_ntz")
    early, late = F.col("l_shipdate") < cut, F.col("l_shipdate") >= cut
    return tuple(D.feature_frame(lines.filter(c), FEATURES) for c in (early, late))


@query("drift_edges", "R3", f"""WITH {_LINES}, {SCORES}
SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS INT) AS edge_no, edge FROM edges""")
def drift_edges(spark: SparkSession, sf: str) -> DataFrame:
    return D.edge_table(_lines(spark, sf)[0])


@query("drift_scores", "R1 R2 R4 R6 J7 J8 A17 P15 F16 U2 U5", f"WITH {_LINES}, {SCORES} SELECT * FROM scores")
def drift_scores(spark: SparkSession, sf: str) -> DataFrame:
    return D.drift_scores(*_lines(spark, sf))


@query("drift_alerts", "R8", f"""WITH {_LINES}, {SCORES}
SELECT *, CASE WHEN round(score, 6) >= 0.2 THEN 1 ELSE 0 END AS alert FROM scores""")
def drift_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return D.with_alerts(D.drift_scores(*_lines(spark, sf)))


SNAPSHOT = """count(*) > 0 AS ready, 'train_parquet' AS reference_mode, 'updated_from_live_traffic' AS reason,
  count(*) AS features_total, count(*) FILTER (WHERE round(score, 6) >= 0.2) AS features_alerting,
  avg(round(score, 6)) AS overall_score, count(*) FILTER (WHERE round(score, 6) >= 0.2) / count(*) AS drift_ratio"""


@query("drift_snapshot", "R7 D11", f"""WITH {_LINES}, {SCORES}
SELECT {SNAPSHOT}, (SELECT count(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}') AS reference_samples,
  (SELECT count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}') AS current_samples FROM scores""")
def drift_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return D.snapshot(*_lines(spark, sf)).drop("feature_scores")


# one value in nine tenths of the reference: fewer than three edges, scored by the mean
_SHIFTED = f"""shifted AS (SELECT CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS side,
  CASE WHEN l_quantity < 50 THEN 0.5 ELSE l_extendedprice END AS v FROM lineitem)"""


@query("drift_mean_shift", "R5 A16", f"""WITH {_SHIFTED}
SELECT 'v' AS feature, 'mean_shift' AS kind, least(abs(avg(v) FILTER (WHERE side = 1) - avg(v) FILTER (WHERE side = 0))
  / coalesce(nullif(stddev_pop(v) FILTER (WHERE side = 0), 0), 1), 1.0) AS score FROM shifted""")
def drift_mean_shift(spark: SparkSession, sf: str) -> DataFrame:
    sides = [df.select(F.when(F.col("l_quantity") < 50, 0.5).otherwise(F.col("l_extendedprice")).alias("v"))
             for df in _lines(spark, sf)]
    return D.drift_scores(*sides)


_HOLED = f"""holed AS (SELECT CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS side,
  CASE WHEN l_suppkey % 7 <> 0 THEN l_extendedprice END AS raw FROM lineitem),
long AS (SELECT side, 'price' AS feature, coalesce(raw, {V.quantile("holed", "raw", 1, 2, "side = 0")}) AS v FROM holed)"""


@query("drift_filled", "R6 F15", f"WITH {_HOLED}, {SCORES} SELECT * FROM scores")
def drift_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Missing values take the reference median on both sides."""
    lines = A.table(spark, sf, "lineitem").select(
        "l_shipdate", F.when(F.col("l_suppkey") % 7 != 0, F.col("l_extendedprice"))
        .otherwise(F.lit(float("inf"))).alias("price"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    early, late = (D.feature_frame(lines.filter(c), ["price"]) for c in (
        F.col("l_shipdate") < cut, F.col("l_shipdate") >= cut))
    return D.drift_scores(early, late)


@query("drift_rolling", "W3 T6", f"""WITH {V.LOG}, newest AS (
  SELECT slot, request_id, row_number() OVER (PARTITION BY slot ORDER BY ts DESC, request_id DESC) AS row_no FROM log)
SELECT slot, request_id, CAST(row_no AS INT) AS row_no FROM newest WHERE row_no <= 500""")
def drift_rolling(spark: SparkSession, sf: str) -> DataFrame:
    log = A.requests(spark, sf).select("slot", "ts", "request_id")
    return D.last_rows(log, ["slot"], "ts", "request_id").drop("ts")


_LOG_CUT = "2024-01-20"
_WINDOWED = f"""base AS (SELECT CASE WHEN ts < TIMESTAMP '{_LOG_CUT}' THEN 0 ELSE 1 END AS side, date_trunc('day', ts) AS day,
  amount, score FROM log), {long_sql("base", ("amount", "score"), "side")}, {SCORES},
days AS (SELECT day, 'amount' AS feature, amount AS v FROM base WHERE side = 1
  UNION ALL SELECT day, 'score', score FROM base WHERE side = 1),
binned AS (SELECT day, feature, (SELECT count(*) FROM inner_edges e WHERE e.feature = d.feature AND e.edge <= d.v) AS bin
  FROM days d),
bins AS (SELECT feature, unnest(range(count(*) + 1)) AS bin FROM inner_edges GROUP BY feature),
seen AS (SELECT day, feature, bin, count(*) AS c FROM binned GROUP BY 1, 2, 3),
day_rows AS (SELECT day, feature, count(*) AS n FROM days GROUP BY 1, 2),
expect AS (SELECT feature, slot AS bin, p FROM shares),
day_scores AS (SELECT r.day AS window_start, r.feature, least(greatest(sum(
    (greatest(coalesce(c, 0) / r.n, 1e-6) - greatest(coalesce(p, 0), 1e-6))
    * ln(greatest(coalesce(c, 0) / r.n, 1e-6) / greatest(coalesce(p, 0), 1e-6))), 0.0), 1.0) AS score, max(r.n) AS rows
  FROM day_rows r JOIN bins b ON b.feature = r.feature
  LEFT JOIN seen s ON s.day = r.day AND s.feature = r.feature AND s.bin = b.bin
  LEFT JOIN expect x ON x.feature = b.feature AND x.bin = b.bin GROUP BY 1, 2)"""


def _windowed(spark: SparkSession, sf: str, width: str = "1 day") -> DataFrame:
    log = A.requests(spark, sf).select("ts", "amount", "score")
    cut = F.lit(_LOG_CUT).cast("timestamp")
    reference = log.filter(F.col("ts") < cut).select("amount", "score")
    return D.windowed_drift(reference, log.filter(F.col("ts") >= cut), "ts", width)


@query("drift_by_day", "T6 R4 J8", f"WITH {V.LOG}, {_WINDOWED} SELECT * FROM day_scores")
def drift_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return _windowed(spark, sf)


@query("top_drifted", "O7 W10 T9", f"""WITH {V.LOG}, {_WINDOWED}
SELECT feature, max(score) AS score FROM day_scores GROUP BY feature ORDER BY score DESC, feature LIMIT 10""")
def top_drifted(spark: SparkSession, sf: str) -> DataFrame:
    return D.top_drifted(_windowed(spark, sf))


@query("drift_ratio_by_day", "R7 T9 A18", f"""WITH {V.LOG}, {_WINDOWED}
SELECT window_start, count(*) AS features_total, count(*) FILTER (WHERE round(score, 6) >= 0.2) AS features_alerting,
  count(*) FILTER (WHERE round(score, 6) >= 0.2) / count(*) AS drift_ratio FROM day_scores GROUP BY window_start""")
def drift_ratio_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return D.with_alerts(_windowed(spark, sf)).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("features_total"), F.sum("alert").alias("features_alerting"),
        F.avg("alert").alias("drift_ratio"))
