"""Alert rules: conditions on an evaluation grid, held for a while."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import scalars as X
from riskweave.operators.metrics import over_range
from riskweave.operators.rank import join_null_safe


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    width: str
    hold: str


# --- fixed values: the rule set ----------------------------------------------
TARGET_DOWN = Rule("TargetDown", "critical", "1 minute", "2 minutes")
ERROR_RATIO = Rule("HighErrorRate", "warning", "5 minutes", "5 minutes")
LATENCY_P95 = Rule("HighLatencyP95", "warning", "5 minutes", "10 minutes")
MODEL_NOT_LOADED = Rule("ModelNotLoaded", "critical", "1 minute", "3 minutes")
DRIFT_RATIO = Rule("DriftRatioHigh", "warning", "1 minute", "10 minutes")
CANDIDATE_REGRESSION = Rule("CandidateRegression", "warning", "10 minutes", "15 minutes")
ERROR_LIMIT, LATENCY_LIMIT, DRIFT_LIMIT = 0.05, 1.0, 0.20
CANDIDATE_FLOOR, CANDIDATE_TRAFFIC, RATE_FLOOR = 0.7, 0.05, 0.001
# --- end of fixed values -------------------------------------------------------


def evaluation_grid(steps: DataFrame, at: str, step: str, labels: DataFrame | None = None) -> DataFrame:
    """Every evaluation time between the first and last step, for every label set.

    Its size is the covered time over the step, times the label sets. Each
    label set explodes its own times, so any number of them stays distributed.
    """
    span = steps.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    every = F.expr(f"interval {step}")
    if labels is None:
        return span.select(F.explode(F.sequence("lo", "hi", every)).alias(at))
    lo, hi = span.select(F.unix_micros("lo"), F.unix_micros("hi")).first()
    if lo is None:
        return labels.limit(0).withColumn(at, F.lit(None).cast("timestamp"))
    times = F.sequence(F.timestamp_micros(F.lit(lo)), F.timestamp_micros(F.lit(hi)), every)
    return labels.distinct().select(F.explode(times).alias(at), *labels.columns)


def on_grid(grid: DataFrame, measured: DataFrame, condition: Column, absent: bool = False) -> DataFrame:
    """``cond`` at every grid point; a point without a measurement takes ``absent``."""
    keys = grid.columns
    return join_null_safe(grid, measured.withColumn("_measured", F.lit(True)), keys, "left").select(
        *keys, F.when(F.col("_measured"), F.coalesce(condition, F.lit(False)))
        .otherwise(F.lit(absent)).alias("cond"))


def firing(checked: DataFrame, at: str, labels: Sequence[str], rule: Rule) -> DataFrame:
    """Stretches of true evaluations that last at least ``rule.hold``.

    Evaluations between two false ones share the running count of false ones.
    """
    order = Window.partitionBy(*labels, F.lit(rule.name)).orderBy(at).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hold = F.expr(f"interval {rule.hold}")
    return (
        checked.withColumn("_island", F.sum((~F.col("cond")).cast("int")).over(order))
        .filter("cond").groupBy(*labels, "_island")
        .agg(F.min(at).alias("pending_from"), F.max(at).alias("firing_to"))
        .filter(F.col("pending_from") + hold <= F.col("firing_to"))
        .select(F.lit(rule.name).alias("alert"), F.lit(rule.severity).alias("severity"), *labels,
                "pending_from", (F.col("pending_from") + hold).alias("firing_from"), "firing_to"))


def absent_targets(seen: DataFrame, rule: Rule = TARGET_DOWN, step: str = "1 minute", label: str = "path") -> DataFrame:
    """Targets without any sample; ``seen`` has ``step``, the label and ``n``."""
    grid = evaluation_grid(seen, "step", step, seen.select(label))
    return firing(on_grid(grid, seen, F.col("n") == 0, absent=True), "step", [label], rule)


def error_ratio(counts: DataFrame, rule: Rule = ERROR_RATIO, step: str = "1 minute", seconds: float = 300.0,
                limit: float = ERROR_LIMIT, floor: float = RATE_FLOOR) -> DataFrame:
    """``counts`` per step with ``status`` and ``n``."""
    flagged = counts.select("step", "n", F.when(X.label_matches("status", "5.."), F.col("n")).otherwise(0).alias("bad"))
    ranges = over_range(flagged, [], ["n", "bad"], rule.width, step)
    ratio = (F.col("bad") / seconds) / X.clamp_min(F.col("n") / seconds, floor)
    grid = evaluation_grid(ranges, "at_time", step)
    return firing(on_grid(grid, ranges, ratio > limit), "at_time", [], rule)


def threshold_alert(measured: DataFrame, at: str, condition: Column, rule: Rule, step: str = "1 minute") -> DataFrame:
    """Alert on any one-row-per-time table."""
    return firing(on_grid(evaluation_grid(measured, at, step), measured, condition), at, [], rule)


def slot_rates(counts: DataFrame, width: str, step: str, seconds: float) -> DataFrame:
    """Candidate and stable side by side per evaluation time, from per-slot steps."""
    ranges = over_range(counts, ["slot"], ["samples", "frauds"], width, step)
    sides = []
    for slot in ("candidate", "stable"):
        samples, frauds = F.col("samples") / seconds, F.col("frauds") / seconds
        sides.append(ranges.filter(F.col("slot") == slot).select(
            "at_time", samples.alias(f"{slot}_traffic"),
            (frauds / X.clamp_min(samples, RATE_FLOOR)).alias(f"{slot}_fraud_rate")))
    return sides[0].join(sides[1], "at_time")


def candidate_regression(counts: DataFrame, rule: Rule = CANDIDATE_REGRESSION, step: str = "1 minute",
                         seconds: float = 600.0, traffic: float = CANDIDATE_TRAFFIC) -> DataFrame:
    rates = slot_rates(counts, rule.width, step, seconds)
    worse = (F.col("candidate_traffic") > traffic) & (
        F.col("candidate_fraud_rate") < F.col("stable_fraud_rate") * CANDIDATE_FLOOR)
    return threshold_alert(rates, "at_time", worse, rule, step)
