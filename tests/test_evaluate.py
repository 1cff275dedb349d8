import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators import evaluate as E
from riskweave.operators import gates as G


def _scored(spark, pairs, segment="a"):
    return spark.createDataFrame(
        [(str(i), float(s), int(y), segment) for i, (s, y) in enumerate(pairs)],
        "transaction_id string, score double, label int, segment string")


def _brute(pairs):
    """Average precision and ROC area by their definitions."""
    p = sum(y for _, y in pairs)
    n = len(pairs) - p
    ap, last = 0.0, 0.0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        hit = [y for t, y in pairs if t >= s]
        ap += (sum(hit) / p - last) * sum(hit) / len(hit)
        last = sum(hit) / p
    wins = sum((a > b) + 0.5 * (a == b) for a, y in pairs if y for b, z in pairs if not z)
    return ap, wins / (p * n)


PAIRS = [((i * 37 % 23) / 23, int(i % 7 == 0)) for i in range(210)]


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_areas_equal_their_definition(spark, parts):
    row = E.curve_metrics(_scored(spark, PAIRS).repartition(parts)).first()
    ap, auc = _brute(PAIRS)
    assert row["average_precision"] == pytest.approx(ap, rel=1e-12)
    assert row["roc_auc"] == pytest.approx(auc, rel=1e-12)


def test_areas_do_not_depend_on_ranges(spark):
    counts = E.settle(E.score_counts(_scored(spark, PAIRS)), "t")
    a, b = E.counts_metrics(counts).first(), E.counts_metrics(counts, rows_per_bucket=3).first()
    assert a == pytest.approx(b)


def test_one_class_gives_no_area(spark):
    row = E.curve_metrics(_scored(spark, [(0.1, 0), (0.2, 0)])).first()
    assert row["average_precision"] is None and row["roc_auc"] is None


def test_curve_points(spark):
    curve = {r["threshold"]: r for r in E.pr_curve(_scored(spark, [(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)])).collect()}
    assert (curve[0.9]["precision"], curve[0.9]["recall"]) == (1.0, 0.5)
    assert (curve[0.8]["tp"], curve[0.8]["fp"], curve[0.8]["f1"]) == (2, 1, 0.8)
    assert (curve[None]["precision"], curve[None]["recall"]) == (1.0, 0.0)


@pytest.mark.parametrize("pairs,min_recall,max_threshold,want,rule", [
    ([(0.9, 1), (0.6, 1), (0.5, 0), (0.4, 0)], 0.95, 0.7, 0.6, 1),      # best precision within both limits
    ([(0.9, 1), (0.8, 1), (0.1, 0)], 0.95, 0.05, 0.8, 2),               # threshold limit cannot be met
    ([(0.9, 1), (0.8, 1), (0.1, 0)], 1.5, 0.7, 0.1, 3),                 # recall cannot be met: best recall, lowest threshold
    ([(0.6, 1), (0.5, 1), (0.4, 1)], 0.0, 0.7, 0.4, 1),                 # ties on precision: lowest threshold
])
def test_threshold_rules(spark, pairs, min_recall, max_threshold, want, rule):
    row = E.best_threshold(_scored(spark, pairs), min_recall, max_threshold).first()
    assert (row["threshold"], row["rule"]) == (want, rule)


def test_report_without_predictions_has_zero_metrics(spark):
    row = E.metric_report(_scored(spark, [(0.1, 1), (0.2, 0)]), 0.9).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 1, 0)
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_segments(spark):
    df = _scored(spark, PAIRS, "a").unionByName(_scored(spark, [(0.9, 0), (0.1, 0)], "empty"))
    rows = {r["segment"]: r for r in E.segment_report(df, 0.5).collect()}
    assert set(rows) == {"ALL", "a", "empty"}
    assert rows["a"]["pr_auc"] == pytest.approx(_brute(PAIRS)[0])
    assert (rows["empty"]["n_fraud"], rows["empty"]["pr_auc"], rows["empty"]["f1"]) == (0, 0.0, 0.0)
    assert rows["ALL"]["n_samples"] == 212
    ordered = [r["f1"] for r in E.segment_report(df, 0.5).collect()]
    assert ordered == sorted(ordered)
    assert [r["segment"] for r in E.segment_report(df.drop("segment"), 0.5).collect()] == ["ALL"]
    codes = spark.createDataFrame([("customer_tier", "MASS", 1)], S.CODES_SCHEMA)
    named = E.named_segments(spark.createDataFrame([("1",), ("7",)], "segment string"), codes)
    assert {r[0] for r in named.collect()} == {"MASS", "7"}


@pytest.mark.parametrize("current,baseline,tolerance,want", [
    ({"pr_auc": .80, "f1": .75, "recall": .90}, {"pr_auc": .75, "f1": .70, "recall": .85}, None, "PASS"),
    ({"pr_auc": .50, "f1": .40, "recall": .60}, {"pr_auc": .80, "f1": .75, "recall": .90}, None, "FAIL"),
    ({"pr_auc": .79, "f1": .73, "recall": .89}, {"pr_auc": .80, "f1": .75, "recall": .90}, None, "PASS"),
    ({"pr_auc": .70}, {"pr_auc": .80}, {"pr_auc": .15}, "PASS"),
    ({}, {"pr_auc": .80}, {"pr_auc": .15}, "FAIL"),
])
def test_gate(spark, current, baseline, tolerance, want):
    tables = [spark.createDataFrame(list(m.items()), "metric string, value double") for m in (current, baseline)]
    rows = E.regression_gate(*tables, tolerance or S.REGRESSION_TOLERANCE).collect()
    assert {r["overall"] for r in rows} == {want}


def test_bands_use_the_unrounded_score(spark):
    out = E.score_bands(_scored(spark, [(0.5999999, 0), (0.6, 1)]), 0.6).orderBy("score").collect()
    assert [(r["fraud_score"], r["is_fraud_pred"], r["risk_level"]) for r in out] == [(0.6, 0, "MEDIUM"), (0.6, 1, "HIGH")]


def test_quality_gate_and_latest(spark):
    history = spark.createDataFrame(
        [("a", 3, None), ("a", 2, 0.9), ("a", 1, 0.1), ("b", 1, 0.2), ("c", 1, None), ("d", 2, None), ("d", 1, 0.9)],
        "s string, t int, m double")
    series = history.select("s").distinct().unionByName(spark.createDataFrame([("e",)], "s string"))
    latest = G.latest_measured(history, "s", ["t"], "m", newest=2)
    got = {r["s"]: r["retrain"] for r in G.quality_gate(series, latest, "s", "m", 80.0).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    one = G.latest_measured(history, "s", ["t"], "m", newest=1)
    assert {r["s"] for r in one.collect()} == {"b"}
    newest = G.latest_per_group(history, ["s"], ["t"], "m", history.filter("t = 3").select("t"), "t")
    assert {r["s"]: r["m"] for r in newest.filter("s = 'a'").collect()} == {"a": 0.9}


def test_exact_sum_ignores_row_order(spark):
    from riskweave.functions.scalars import exact_sum
    values = [0.1, 1e9, 0.2, -1e9, 0.3] * 50
    sums = {spark.createDataFrame([(v,) for v in order], "v double").repartition(p).agg(exact_sum("v")).first()[0]
            for order, p in ((values, 1), (sorted(values), 7), (values[::-1], 3))}
    assert sums == {30.0}
    assert not np.isnan(spark.range(1).select(F.lit(1.0).alias("v")).agg(exact_sum("v")).first()[0])
