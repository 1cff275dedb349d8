import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave.operators import alerts as AL
from riskweave.operators import metrics as M

T0 = dt.datetime(2026, 1, 1)


def _at(minute, second=0):
    return T0 + dt.timedelta(minutes=minute, seconds=second)


def _quantile(spark, phi, bounds, values):
    df = spark.createDataFrame([(T0, float(v)) for v in values] or [(T0, None)], "ts timestamp, v double")
    row = M.histogram(df, "ts", "v", bounds)
    return row.select(M.histogram_quantile(phi, bounds)).first()[0]


def test_bucket_bounds_are_inclusive(spark):
    df = spark.createDataFrame(
        [(T0, v) for v in (0.1, 0.1, 0.5, 9.0, float("nan"), float("inf"), None)], "ts timestamp, v double")
    rows = M.bucket_rows(M.histogram(df, "ts", "v", [0.1, 1.0]), ["step"], [0.1, 1.0]).collect()
    assert [(r["le"], r["n"]) for r in rows] == [("0.1", 2), ("1.0", 3), ("+Inf", 4)]


@pytest.mark.parametrize("phi,values,want", [
    (0.5, [0.5] * 10, 0.5), (0.95, [0.5] * 10, 0.95), (0.5, [0.5] * 5 + [1.5] * 5, 1.0),
    (0.75, [0.5] * 5 + [1.5] * 5, 1.5), (0.99, [0.5, 99.0], 2.0), (0.5, [], None)])
def test_bucket_quantile(spark, phi, values, want):
    assert _quantile(spark, phi, [1.0, 2.0], values) == (None if want is None else pytest.approx(want))


def test_sliding_sums(spark):
    steps = spark.createDataFrame([(_at(0), 1), (_at(1), 2), (_at(4), 4)], "step timestamp, n int")
    got = {r["at_time"]: r["n"] for r in M.over_range(steps, [], ["n"], "3 minutes", "1 minute").collect()}
    assert got == {_at(1): 1, _at(2): 3, _at(3): 3, _at(4): 2, _at(5): 4, _at(6): 4, _at(7): 4}


@pytest.mark.parametrize("parts", [1, 6])
def test_counter_growth_over_resets_and_steps(spark, parts):
    rows = [("a", _at(0, 0), 5.0), ("a", _at(0, 30), 8.0), ("a", _at(2, 0), 10.0), ("a", _at(2, 10), 3.0),
            ("a", _at(2, 20), 4.0), ("b", _at(1, 0), 7.0),
            (None, _at(3), 1.0), (None, _at(4), 2.0)]
    df = spark.createDataFrame(rows, "s string, ts timestamp, v double").repartition(parts)
    want = {("a", _at(0)): 3.0, ("a", _at(2)): 6.0, ("b", _at(1)): 0.0, (None, _at(3)): 0.0, (None, _at(4)): 1.0}
    for source in (df, df.unionByName(df)):
        for rows_per_bucket in (1, 10**6):
            grown = M.counter_increase(source, ["s"], "ts", "v", rows_per_bucket=rows_per_bucket)
            assert {(r["s"], r["step"]): r["increase"] for r in grown.collect()} == want


@pytest.mark.parametrize("parts", [1, 3])
def test_rates_reach_out_to_the_edges_of_their_range(spark, parts):
    def sec(m, s):
        return _at(m) + dt.timedelta(seconds=s)

    rows = [("even", sec(0, s), v) for s, v in ((15, 105.0), (25, 115.0), (35, 125.0), (45, 135.0))]
    rows += [("young", sec(0, s), v) for s, v in ((15, 1.0), (25, 11.0), (35, 21.0), (45, 31.0))]
    rows += [("restart", sec(0, s), v) for s, v in ((10, 10.0), (20, 20.0), (30, 4.0), (40, 14.0))]
    rows += [("gap", sec(0, 30), 50.0), ("gap", sec(3, 30), 80.0), ("gap", sec(3, 50), 90.0), (None, sec(0, 0), 3.0), ("lone", sec(0, 1), 3.0)]
    df = spark.createDataFrame(rows, "s string, ts timestamp, v double").repartition(parts)
    for rows_per_bucket in (1, 10**6):
        got = {(r.s, r.at_time): r for r in M.counter_rates(df, ["s"], "ts", "v", "1 minute", rows_per_bucket=rows_per_bucket).collect()}
        increase = {k: round(r.increase, 9) for k, r in got.items()}
        # half a distance at both edges; to zero one second before the first; whole gap at the start; whole gap at the end
        assert increase == {("even", _at(1)): 40.0, ("young", _at(1)): 36.0, ("restart", _at(1)): 36.0, ("gap", _at(4)): 20.0}
        assert got["even", _at(1)].rate_per_s == pytest.approx(40 / 60) and got["restart", _at(1)].growth == 24.0
        wide = {(r.s, r.at_time): r for r in M.counter_rates(df, ["s"], "ts", "v", "4 minutes", rows_per_bucket=rows_per_bucket).collect()}
        r = wide["gap", _at(4)]
        assert (r.n, r.growth) == (3, 40.0) and r.increase == pytest.approx(40.0 * (200 + 30 + 10) / 200)


def test_last_value(spark):
    df = spark.createDataFrame([("a", T0, 1, 5.0), ("a", T0, 2, 6.0), ("a", _at(0, 9), 0, 7.0), ("a", _at(1), 1, 8.0)],
                               "s string, ts timestamp, id int, v double")
    got = {r["step"]: r["v"] for r in M.last_over(df, ["s"], "ts", "v", "id").collect()}
    assert got == {T0: 7.0, _at(1): 8.0}


def _stretches(df):
    return [(r["pending_from"], r["firing_from"], r["firing_to"]) for r in df.orderBy("pending_from").collect()]


def test_hold_needs_unbroken_evaluations(spark):
    rule = AL.Rule("R", "warning", "1 minute", "3 minutes")
    flags = [1, 1, 1, 0, 1, 1, 1, 1, 1, None, 1, 1, 1, 1]
    df = spark.createDataFrame(
        [(_at(i), f) for i, f in enumerate(flags) if f is not None], "at_time timestamp, f int")
    got = AL.threshold_alert(df, "at_time", F.col("f") == 1, rule)
    assert _stretches(got) == [(_at(4), _at(7), _at(8)), (_at(10), _at(13), _at(13))]


def test_absent_targets(spark):
    rule = AL.Rule("Down", "critical", "1 minute", "2 minutes")
    seen = spark.createDataFrame([(_at(i), "a", 1) for i in range(8)] + [(_at(0), "b", 1), (_at(4), "b", 1), (_at(5), "b", 0)],
                                 "step timestamp, path string, n int")
    got = AL.absent_targets(seen, rule)
    assert {r["path"] for r in got.collect()} == {"b"}
    assert _stretches(got) == [(_at(1), _at(3), _at(3)), (_at(5), _at(7), _at(7))]


def test_error_ratio_rule(spark):
    rows = [(_at(i), "200", 100) for i in range(30)] + [(_at(i), "503", 10) for i in range(10, 22)]
    got = AL.error_ratio(spark.createDataFrame(rows, "step timestamp, status string, n int"))
    (pending, fires, ends), = _stretches(got)
    # at 12 of the 5 minutes the ratio passes 5%: 3 bad minutes of 10 in 530
    assert (pending, fires) == (_at(13), _at(18)) and ends == _at(24)


def test_candidate_rule(spark):
    rows = [(_at(i), s, 60, f) for i in range(40) for s, f in (("stable", 10), ("candidate", 10 if i < 10 else 1))]
    got = AL.candidate_regression(spark.createDataFrame(rows, "step timestamp, slot string, samples int, frauds int"))
    assert got.count() == 1 and got.first()["severity"] == "warning"
    calm = AL.candidate_regression(spark.createDataFrame(
        [(_at(i), s, 60, 10) for i in range(40) for s in ("stable", "candidate")],
        "step timestamp, slot string, samples int, frauds int"))
    assert calm.count() == 0


def test_run_summary(spark):
    df = spark.createDataFrame([("p", T0, "200", 0.1), ("p", _at(0, 10), "500", 0.3)],
                               "path string, ts timestamp, status string, latency_s double")
    r = M.run_summary(df).first()
    assert (r["total"], r["success"], r["failed"], r["rate_per_s"]) == (2, 1, 1, 0.2)


def test_risk_mix(spark):
    df = spark.createDataFrame([(T0, "p", s) for s in (0.1, 0.4, 0.9, None)], "ts timestamp, path string, score double")
    counts = M.prediction_counts(df, 0.5)
    assert {r["risk_level"]: r["n"] for r in M.risk_mix(counts).collect()} == {"LOW": 1, "MEDIUM": 1, "HIGH": 1, "UNKNOWN": 1}
