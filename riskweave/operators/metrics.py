"""Counters, histograms, rates and quantiles over metric streams.

Raw rows are folded to one row per step and label set first; sliding ranges
are then sums of steps, so a five-minute range evaluated every minute does not
multiply the raw rows by five.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import scalars as X
from riskweave.operators.rank import ROWS_PER_BUCKET, cut_points, join_null_safe, with_range
from riskweave.session import settle

STEP = "1 minute"


def per_step(df: DataFrame, time: str, labels: Sequence[str], aggs: Sequence[Column], step: str = STEP) -> DataFrame:
    """Tumbling totals; the same call serves batch and stream frames.

    The window itself is the key: only so does a stream with a watermark let old steps go.
    """
    totals = df.groupBy(F.window(time, step).alias("step"), *labels).agg(*aggs)
    return totals.withColumn("step", F.col("step.start"))


def over_range(steps: DataFrame, labels: Sequence[str], sums: Sequence[str], width: str, step: str = STEP) -> DataFrame:
    """Sums over the last ``width`` at every step: ``at_time`` is the range's end."""
    return steps.groupBy(F.window("step", width, step)["end"].alias("at_time"), *labels).agg(
        *[F.sum(c).alias(c) for c in sums])


def request_counts(log: DataFrame, step: str = STEP, labels: Sequence[str] = ("method", "path", "status")) -> DataFrame:
    return per_step(log, "ts", labels, [F.count(F.lit(1)).alias("n")], step)


def prediction_counts(log: DataFrame, threshold: float, step: str = STEP, labels: Sequence[str] = ("path",)) -> DataFrame:
    """Calls, scored rows, positives and risk bands per step."""
    banded = log.withColumns({
        "hit": X.decision("score", threshold), "risk_level": X.or_unknown(X.risk_band("score"))})
    levels = [F.count_if(F.col("risk_level") == b).alias(b.lower()) for b in ("LOW", "MEDIUM", "HIGH", "UNKNOWN")]
    return per_step(banded, "ts", labels, [
        F.count(F.lit(1)).alias("samples"), F.sum("hit").alias("frauds"), *levels], step)


def risk_mix(counts: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    levels = ["low", "medium", "high", "unknown"]
    sums = counts.groupBy(*labels).agg(*[F.sum(c).alias(c) for c in levels])
    return sums.unpivot(list(labels), levels, "risk_level", "n").withColumn("risk_level", F.upper("risk_level"))


def histogram_aggs(value: str, bounds: Sequence[float], positive: bool = False) -> list[Column]:
    """Cumulative bucket counts ``le_0..``, total and sum of the finite values, of those above zero on demand."""
    v = X.finite_or_null(value)
    if positive:
        v = F.when(v > 0, v)
    return [F.count_if(v <= b).alias(f"le_{i}") for i, b in enumerate(bounds)] + [
        F.count(v).alias("observed"), F.sum(v).alias("total")]


def histogram(df: DataFrame, time: str, value: str, bounds: Sequence[float],
              labels: Sequence[str] = (), step: str = STEP, positive: bool = False) -> DataFrame:
    return per_step(df, time, labels, histogram_aggs(value, bounds, positive), step)


def bucket_rows(wide: DataFrame, keys: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """Exposition form: one row per ``le`` bound, ``+Inf`` last."""
    rows = F.array(*[
        F.struct(F.lit(str(b)).alias("le"), F.col(f"le_{i}").alias("n")) for i, b in enumerate(bounds)
    ], F.struct(F.lit("+Inf").alias("le"), F.col("observed").alias("n")))
    return wide.select(*keys, F.explode(rows).alias("s")).select(*keys, "s.*")


def histogram_quantile(phi: float, bounds: Sequence[float]) -> Column:
    """Linear inside the bucket; the highest bound beyond it; null when empty."""
    cums = F.array(*[F.col(f"le_{i}") for i in range(len(bounds))])
    rank = F.lit(phi) * F.col("observed")
    i = F.size(F.filter(cums, lambda c: c < rank))
    edges = F.lit([0.0, *[float(b) for b in bounds]])
    low, high = F.get(edges, i), F.get(edges, i + 1)
    below = F.when(i == 0, 0).otherwise(F.get(cums, i - 1))
    inside = low + (high - low) * F.try_divide(rank - below, F.get(cums, i) - below)
    return F.when(F.col("observed") == 0, F.lit(None)).when(
        i >= len(bounds), F.lit(float(bounds[-1]))).otherwise(inside)


def histogram_columns(bounds: Sequence[float]) -> list[str]:
    return [f"le_{i}" for i in range(len(bounds))] + ["observed", "total"]


def rate(column: str, seconds: float) -> Column:
    return F.col(column) / seconds


def counter_increase(samples: DataFrame, series: Sequence[str], time: str, value: str, step: str = STEP,
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Growth of a counter per step; a falling value is a restart from zero.

    A sample follows the previous one of its series; the first one adds
    nothing. Equal samples add nothing either and collapse first; missing
    values are no samples. Inside a
    tile (step and time range) a window finds the previous sample, a tile's
    first sample follows the last one of the tile before: so neither a long
    series nor a crowded step falls to one task.
    """
    return _counter_deltas(samples, series, time, value, step, rows_per_bucket).groupBy(*series, "step").agg(
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("increase"))


def _counter_deltas(samples: DataFrame, series: Sequence[str], time: str, value: str, step: str, rows_per_bucket: int) -> DataFrame:
    """Each distinct sample with its ``step``, ``_micros`` and growth ``delta`` since the sample before."""
    s = settle(
        samples.filter(F.col(value).isNotNull()).select(*series, time, value).distinct()
        .withColumns({"step": F.window(time, step)["start"], "_micros": F.unix_micros(time)}), "samples")
    s = with_range(s, "_micros", cut_points(s, "_micros", rows_per_bucket))
    lasts = s.groupBy(*series, "step", "_range").agg(
        F.max_by(value, F.struct(F.col(time), F.col(value))).alias("last"))
    # one row per series and tile: bounded by the calendar and the cuts
    entering = lasts.withColumn("entering", F.lag("last").over(
        Window.partitionBy(*series).orderBy("step", "_range"))).drop("last")
    inside = Window.partitionBy(*series, "step", "_range").orderBy(time, value)
    return (
        join_null_safe(s.withColumn("before", F.lag(value).over(inside)), entering, [*series, "step", "_range"])
        .withColumn("before", F.coalesce("before", "entering"))
        .withColumn("delta", F.when(F.col(value) < F.col("before"), F.col(value)).otherwise(
            F.col(value) - F.col("before"))))


def counter_rates(samples: DataFrame, series: Sequence[str], time: str, value: str, width: str, step: str = STEP,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(series, at_time, n, growth, increase, rate_per_s) over the last ``width`` at every step's end, as rules take ``increase`` and ``rate``.

    ``growth`` is what the samples inside the range show; ``increase`` reaches
    out to the range's edges: by the whole gap where it is below 1.1 times the
    mean distance of samples, else by half that distance, and at the start no
    further than to where the counter would have been zero. A range includes
    its start and not its end; ranges with fewer than two instants tell
    nothing. Samples fold to one row per series and step, only those are
    repeated per range.
    """
    at = F.struct("_micros", value)
    deltas = _counter_deltas(samples, series, time, value, step, rows_per_bucket)
    steps = deltas.groupBy(*series, "step").agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max("_micros").alias("last"),
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("total"), F.coalesce(F.min_by("delta", at), F.lit(0.0)).alias("entry"))
    ranges = steps.groupBy(F.window("step", width, step).alias("w"), *series).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
        # growth up to the range's first sample began outside
        (F.sum("total") - F.min_by("entry", "first")).alias("growth"))
    start, end = (F.unix_micros(F.col("w")[c]) for c in ("start", "end"))
    first, value_there = F.col("first")["_micros"], F.col("first")[value]
    growth, sampled = F.col("growth"), F.col("sampled")
    mean = sampled / (F.col("n") - 1)

    def reach(gap: Column) -> Column:
        return F.when(gap >= mean * 1.1, mean / 2).otherwise(gap)

    to_zero = F.when((growth > 0) & (value_there >= 0), sampled * value_there / growth)
    told = ranges.withColumn("sampled", (F.col("last") - first) / 1e6).filter(sampled > 0)
    grown = told.withColumn("increase", growth * (
        sampled + F.least(reach((first - start) / 1e6), to_zero) + reach((end - F.col("last")) / 1e6)) / sampled)
    return grown.select(*series, F.col("w.end").alias("at_time"), "n", "growth", "increase",
                        (F.col("increase") / ((end - start) / 1e6)).alias("rate_per_s"))


def last_over(samples: DataFrame, series: Sequence[str], time: str, value: str, row_id: str,
              step: str = STEP) -> DataFrame:
    return samples.groupBy(F.window(time, step)["start"].alias("step"), *series).agg(
        F.max_by(value, F.struct(F.col(time), F.col(row_id))).alias(value))


def aggregate_by(samples: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return samples.groupBy(*by).agg(
        F.max(value).alias("max_value"), F.min(value).alias("min_value"),
        F.sum(value).alias("sum_value"), F.avg(value).alias("avg_value"))


def run_summary(log: DataFrame, labels: Sequence[str] = ("path",)) -> DataFrame:
    """Totals, failures (status 400 and above), mean latency and achieved rate."""
    failed = F.col("status").cast("int") >= 400
    span = (F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / 1e6
    return log.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~failed).alias("success"),
        F.count_if(failed).alias("failed"), F.avg("latency_s").alias("mean_latency_s"),
        F.try_divide(F.count(F.lit(1)), span).alias("rate_per_s"))
