"""Drift of a current window against a reference.

Features are scored together. Kind test, quantile edges and histograms are
each one pass whose shuffle carries a few rows per feature, not the values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators.features import numeric_columns
from riskweave.operators.rank import counted_quantiles, exact_quantiles, top_per_group, with_buckets
from riskweave.session import settle

SCORES = "feature string, kind string, score double"


def feature_frame(df: DataFrame, features: Sequence[str] = (), label: str = "is_fraud") -> DataFrame:
    """The listed features that exist, else all numeric ones but the label.

    Values become doubles, unreadable and infinite ones null. Columns without
    any value stay here: the scores leave them out, and ``drop_empty`` does
    for a caller who wants the frame alone.
    """
    chosen = [c for c in features if c in df.columns]
    chosen = chosen or [c for c in numeric_columns(df) if c != label]
    return df.select([X.finite_or_null(F.col(c).try_cast("double")).alias(c) for c in chosen])


def drop_empty(df: DataFrame) -> DataFrame:
    present = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select([c for c in df.columns if present[c] > 0])


def sample_rows(df: DataFrame, key: Column, row_id: str, n: int = S.DRIFT_REFERENCE_ROWS) -> DataFrame:
    """At most ``n`` rows without replacement, the same ones on every run."""
    return df.orderBy(key, row_id).limit(n)


def last_rows(df: DataFrame, by: Sequence[str], time: str, row_id: str, n: int = S.DRIFT_WINDOW) -> DataFrame:
    """The rolling window: the newest ``n`` rows per group."""
    return top_per_group(df, by, [F.desc(time), F.desc(row_id)], n)


def warmup_rows(df: DataFrame, by: Sequence[str], time: str, row_id: str,
                least: int = S.DRIFT_WARMUP_ROWS, most: int = S.DRIFT_REFERENCE_ROWS) -> DataFrame:
    """The first ``most`` rows per group, for groups that reach ``least``."""
    first = top_per_group(df, by, [F.asc(time), F.asc(row_id)], most)
    return first.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by))).filter(
        F.col("_n") >= least).drop("_n")


def near_whole(v: Column) -> Column:
    whole = F.rint(v)
    return F.abs(v - whole) <= 1e-9 + 1e-5 * F.abs(whole)


@dataclass(frozen=True)
class Reference:
    """What the score needs to know of the reference side, per feature."""

    rows: int
    medians: dict[str, float]
    edges: dict[str, list[float]]


def describe_reference(reference: DataFrame, bins: int = S.DRIFT_BINS) -> Reference:
    """Median and distinct quantile edges of each feature, after median fill.

    Features without any value are left out.
    """
    cols = reference.columns
    grid = [(i, bins) for i in range(bins + 1)]
    rows, raw = counted_quantiles(reference, cols, [*grid, (1, 2)])
    medians = {c: v[-1] for c, (n, v) in raw.items() if n}
    edges = {c: sorted(set(v[:-1])) for c, (n, v) in raw.items() if n == rows > 0}
    holed = [c for c in medians if c not in edges]
    if holed:
        filled = exact_quantiles(fill(reference.select(holed), medians), holed, grid)
        edges |= {c: sorted(set(v)) for c, (_, v) in filled.items()}
    return Reference(rows, medians, {c: edges[c] for c in cols if c in edges})


def edge_table(reference: DataFrame, bins: int = S.DRIFT_BINS) -> DataFrame:
    described = describe_reference(reference, bins)
    rows = [(f, i, e) for f, es in described.edges.items() for i, e in enumerate(es)]
    return reference.sparkSession.createDataFrame(rows, "feature string, edge_no int, edge double")


def fill(df: DataFrame, medians: dict[str, float], *keep: str) -> DataFrame:
    return df.select(*keep, *[
        F.coalesce(F.col(c), F.lit(medians.get(c, 0.0))).alias(c) for c in df.columns if c not in keep])


def drift_scores(reference: DataFrame, current: DataFrame, bins: int = S.DRIFT_BINS,
                 described: Reference | None = None) -> DataFrame:
    """``(feature, kind, score)`` of the features both sides have.

    Categories: half the summed share differences. Numbers: population
    stability over the reference's quantile bins, or the shift of the mean in
    standard deviations where the reference has fewer than three edges.
    """
    return _scored(reference, current, bins, described)[0]


def _scored(reference, current, bins, described) -> tuple[DataFrame, int]:
    """The scores and the number of current rows."""
    spark = reference.sparkSession
    cols = [c for c in reference.columns if c in current.columns]
    described = described or describe_reference(reference.select(cols), bins)
    cols = [c for c in cols if c in described.edges]
    raw = reference.select(*cols, F.lit(0).alias("side")).unionByName(
        current.select(*cols, F.lit(1).alias("side")))
    n_cur, cols, maybe = _two_sides(raw, cols, described)
    if not cols or described.rows < 2 or n_cur < 2:
        return spark.createDataFrame([], SCORES), n_cur
    both = fill(raw.select("side", *cols), described.medians, "side")
    few = [c for c in cols if len(described.edges[c]) < 3]
    # features without bins need their kind now, the others when their values are counted
    shifted = [c for c in few if c not in _exact_categories(both, [c for c in few if c in maybe])]
    counted = [c for c in cols if c not in shifted]
    parts = []
    if counted:
        parts.append(_share_scores(both, counted, maybe, described, n_cur))
    if shifted:
        parts.append(_shift_scores(both, shifted))
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])), n_cur


def _two_sides(raw: DataFrame, cols: list[str], described: Reference) -> tuple[int, list[str], list[str]]:
    """Current rows, features with current values, and possible categories.

    A category has whole numbers only and at most ``CATEGORY_LIMIT`` distinct
    values; the sketch's estimate for so few cannot exceed twice the limit.
    """
    current = F.col("side") == 1
    filled = [F.coalesce(F.col(c), F.lit(described.medians[c])) for c in cols]
    row = raw.agg(
        F.count_if(current).alias("n_cur"),
        *[F.count_if(current & F.col(c).isNotNull()).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.bool_and(near_whole(v)).alias(f"w_{i}") for i, v in enumerate(filled)],
        *[F.approx_count_distinct(v).alias(f"d_{i}") for i, v in enumerate(filled)]).first()
    present = [c for i, c in enumerate(cols) if row[f"n_{i}"]]
    maybe = [c for i, c in enumerate(cols)
             if c in present and row[f"w_{i}"] and row[f"d_{i}"] <= 2 * S.CATEGORY_LIMIT]
    return row["n_cur"], present, maybe


def _exact_categories(both: DataFrame, cols: list[str]) -> set[str]:
    if not cols:
        return set()
    sizes = both.select(cols).unpivot([], cols, "feature", "value").distinct().groupBy("feature").count()
    return {r["feature"] for r in sizes.filter(F.col("count") <= S.CATEGORY_LIMIT).collect()}


def _share_scores(both: DataFrame, cols: list[str], maybe: list[str], described: Reference, n_cur: int) -> DataFrame:
    """Scores from the shares of bins or values: few (feature, slot) rows."""
    by_value = [c for c in cols if c in maybe]
    binned = [c for c in cols if c not in maybe]
    inner = {c: described.edges[c][1:-1] for c in cols}
    slots = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("slot")) for c in by_value] + [
        F.struct(F.lit(c).alias("feature"), F.col(f"_bucket_{i}").cast("double").alias("slot"))
        for i, c in enumerate(binned)]
    counts = (
        with_buckets(both, {c: inner[c] for c in binned})
        .select("side", F.inline(F.array(*slots))).groupBy("feature", "slot")
        .agg(F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur")))
    category = F.lit(False)
    if by_value:
        # a possible category with too many values turns into its bins after all
        edges = F.create_map(*[x for c in by_value for x in (
            F.lit(c), F.lit(inner[c]).cast("array<double>"))])
        own = F.try_element_at(edges, F.col("feature"))
        bin_of = F.size(F.filter(own, lambda e: F.col("slot") >= e)).cast("double")
        values = F.count(F.lit(1)).over(Window.partitionBy("feature"))
        counts = (
            counts.withColumn("category", F.col("feature").isin(by_value) & (values <= S.CATEGORY_LIMIT))
            .withColumn("slot", F.when(F.col("feature").isin(by_value) & ~F.col("category"), bin_of)
                        .otherwise(F.col("slot")))
            .groupBy("feature", "category", "slot").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")))
        category = F.col("category")
    p, q = F.col("n_ref") / described.rows, F.col("n_cur") / n_cur
    # bins empty on both sides have equal floored shares and add nothing
    fp, fq = F.greatest(p, F.lit(1e-6)), F.greatest(q, F.lit(1e-6))
    part = F.when(category, 0.5 * F.abs(p - q)).otherwise((fq - fp) * F.ln(fq / fp))
    kind = F.when(category, "categorical").otherwise("psi")
    return counts.groupBy("feature", kind.alias("kind")).agg(X.clip_unit(F.sum(part)).alias("score"))


def _shift_scores(both: DataFrame, cols: list[str]) -> DataFrame:
    def on(side: int, c: str) -> Column:
        return F.when(F.col("side") == side, F.col(c))

    row = both.agg(*[m.alias(f"{n}_{i}") for i, c in enumerate(cols) for n, m in (
        ("m0", F.avg(on(0, c))), ("m1", F.avg(on(1, c))), ("sd", F.stddev_pop(on(0, c))))])
    scores = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit("mean_shift").alias("kind"),
                 X.clip_unit(F.abs(F.col(f"m1_{i}") - F.col(f"m0_{i}"))
                             / F.coalesce(F.nullif(F.col(f"sd_{i}"), F.lit(0.0)), F.lit(1.0))).alias("score"))
        for i, c in enumerate(cols)])
    return row.select(F.inline(scores))


@dataclass(frozen=True)
class Profile:
    """The reference side of one feature, ready to score any current values."""

    median: float
    edges: list[float]
    shares: list[float]                  # per bin
    values: dict[float, float] | None    # share of each value, where the feature may be a category
    mean: float
    spread: float


def reference_profiles(reference: DataFrame, bins: int = S.DRIFT_BINS, described: Reference | None = None) -> tuple[int, dict[str, Profile]]:
    """Rows and a profile per feature: all that scoring needs, read once."""
    described = described or describe_reference(reference, bins)
    cols = [c for c in reference.columns if c in described.edges]
    if not cols or not described.rows:
        return described.rows, {}
    both = fill(reference.select(cols), described.medians)
    facts = both.agg(*[m.alias(f"{n}_{i}") for i, c in enumerate(cols) for n, m in (
        ("m", F.avg(c)), ("sd", F.stddev_pop(c)), ("w", F.bool_and(near_whole(F.col(c)))), ("d", F.approx_count_distinct(c)))]).first()
    maybe = [c for i, c in enumerate(cols) if facts[f"w_{i}"] and facts[f"d_{i}"] <= 2 * S.CATEGORY_LIMIT]
    # a sketch that small bounds the values that come back
    values: dict[str, dict[float, float]] = {c: {} for c in maybe}
    if maybe:
        for r in both.select(maybe).unpivot([], maybe, "feature", "value").groupBy("feature", "value").count().collect():
            values[r["feature"]][r["value"] + 0.0] = r["count"] / described.rows
    binned = with_buckets(both, {c: described.edges[c][1:-1] for c in cols})
    slots = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_bucket_{i}").alias("bin")) for i, c in enumerate(cols)])
    shares = {c: [0.0] * max(1, len(described.edges[c]) - 1) for c in cols}
    for r in binned.select(F.inline(slots)).groupBy("feature", "bin").count().collect():
        shares[r["feature"]][r["bin"]] = r["count"] / described.rows
    return described.rows, {c: Profile(
        described.medians[c], described.edges[c], shares[c],
        values[c] if c in values and len(values[c]) <= S.CATEGORY_LIMIT else None,
        facts[f"m_{i}"], facts[f"sd_{i}"] or 1.0) for i, c in enumerate(cols)}


def windowed_drift(
    reference: DataFrame, current: DataFrame, time: str, width: str, described: Reference | None = None,
) -> DataFrame:
    """``drift_scores`` of every time window against one reference.

    The reference is a profile per feature, so a window costs its (feature,
    bin) and (feature, value) counts only: this is the form for long streams
    and hot groups. Every feature of both sides is scored, by the rule its
    values in the window call for.
    """
    _, profiles = reference_profiles(reference, described=described)
    cols = [c for c in reference.columns if c in current.columns and c in profiles]
    spark = reference.sparkSession
    schema = T.StructType([
        T.StructField("window_start", T.TimestampType()), T.StructField("feature", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rows", T.LongType())])
    if not cols:
        return spark.createDataFrame([], schema)
    window = F.window(time, width)["start"].alias("w")
    filled = current.select(window, *[F.coalesce(F.col(c), F.lit(profiles[c].median)).cast("double").alias(c) for c in cols])

    few = [c for c in cols if len(profiles[c].edges) < 3]
    by_value = [c for c in cols if profiles[c].values is not None or c in few]
    by_bin = [c for c in cols if c not in by_value]
    seen = None
    if by_bin:
        bucketed = with_buckets(filled, {c: profiles[c].edges[1:-1] for c in by_bin})
        slots = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_bucket_{i}").alias("bin")) for i, c in enumerate(by_bin)])
        seen = bucketed.select("w", F.inline(slots)).groupBy("w", "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    parts = []
    if by_value:
        known = spark.createDataFrame(
            [(c, v, p) for c in by_value for v, p in (profiles[c].values or {}).items()] or [(by_value[0], None, None)],
            "feature string, v double, p double")
        facts = spark.createDataFrame(
            [(c, len(profiles[c].values or ()), profiles[c].values is not None, c in few, profiles[c].mean, profiles[c].spread,
              profiles[c].edges[1:-1]) for c in by_value],
            "feature string, k int, maybe boolean, few boolean, mean double, spread double, inner array<double>")
        slots = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(c) + F.lit(0.0)).alias("v")) for c in by_value])
        values = filled.select("w", F.inline(slots)).groupBy("w", "feature", "v").agg(F.count(F.lit(1)).alias("n"))
        sums = values.groupBy("w", "feature").agg(F.sum("n").alias("rows"))
        values = settle(values.join(sums, ["w", "feature"]).join(known, ["feature", "v"], "left"), "window-values")
        apart = F.abs(F.coalesce("p", F.lit(0.0)) - F.col("n") / F.col("rows"))
        judged = settle(
            values.groupBy("w", "feature").agg(
                F.max("rows").alias("rows"), F.count(F.lit(1)).alias("held"), F.count("p").alias("shared"), F.sum("p").alias("covered"),
                F.bool_and(near_whole(F.col("v"))).alias("whole"), F.sum(apart).alias("apart"),
                (F.sum(F.col("v") * F.col("n")) / F.max("rows")).alias("avg"))
            .join(facts, "feature")
            .withColumn("category", F.col("maybe") & F.col("whole") & (F.col("held") + F.col("k") - F.col("shared") <= S.CATEGORY_LIMIT)),
            "window-kinds")
        # values that the window lacks differ by their whole share
        share = 0.5 * (F.col("apart") + F.lit(1.0) - F.coalesce("covered", F.lit(0.0)))
        shift = F.abs(F.col("avg") - F.col("mean")) / F.col("spread")
        parts.append(judged.filter("category OR few").select(
            "w", "feature", X.clip_unit(F.when(F.col("category"), share).otherwise(shift)).alias("score"), "rows"))
        rest = judged.filter("NOT category AND NOT few").select("w", "feature", "inner")
        bin_of = F.size(F.filter("inner", lambda e: F.col("v") >= e))
        turned = values.join(rest, ["w", "feature"]).groupBy("w", "feature", bin_of.alias("bin")).agg(F.sum("n").alias("n"))
        seen = turned if seen is None else seen.unionByName(turned)
    # bins x windows stays small: one row per feature, bin and window
    shape = spark.createDataFrame(
        [(c, b, p) for c in cols for b, p in enumerate(profiles[c].shares)], "feature string, bin int, p double")
    rows = seen.groupBy("w", "feature").agg(F.sum("n").alias("rows"))
    per_bin = rows.join(shape, "feature").join(seen, ["w", "feature", "bin"], "left").fillna(0, ["n"])
    q = F.greatest(F.col("n") / F.col("rows"), F.lit(1e-6))
    p = F.greatest(F.col("p"), F.lit(1e-6))
    parts.append(per_bin.groupBy("w", "feature").agg(
        X.clip_unit(F.sum((q - p) * F.ln(q / p))).alias("score"), F.max("rows").alias("rows")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(F.col("w").alias("window_start"), "feature", "score", "rows")


def profile_of(values: np.ndarray, bins: int = S.DRIFT_BINS) -> Profile | None:
    """The profile of a bounded reference; None without any finite value."""
    v = np.asarray(values, float)
    known = v[np.isfinite(v)]
    if not len(known):
        return None
    median = float(np.median(known))
    v = np.where(np.isfinite(v), v, median) + 0.0
    edges = np.unique(np.quantile(v, np.arange(bins + 1) / bins))
    at = np.searchsorted(edges[1:-1], v, "right")
    held, times = np.unique(v, return_counts=True)
    category = len(held) <= S.CATEGORY_LIMIT and _whole(held).all()
    return Profile(median, edges.tolist(), (np.bincount(at, minlength=max(1, len(edges) - 1)) / len(v)).tolist(),
                   dict(zip(held.tolist(), (times / len(v)).tolist())) if category else None, float(v.mean()), float(v.std()) or 1.0)


def _whole(v: np.ndarray) -> np.ndarray:
    return np.abs(v - np.rint(v)) <= 1e-9 + 1e-5 * np.abs(np.rint(v))


def score_values(profile: Profile, values: np.ndarray) -> float | None:
    """The drift score of bounded current values by the rules of ``drift_scores``; None without a finite one."""
    v = np.asarray(values, float)
    if not np.isfinite(v).any():
        return None
    v = np.where(np.isfinite(v), v, profile.median) + 0.0
    held, times = np.unique(v, return_counts=True)
    if profile.values is not None and _whole(held).all() and len(set(held.tolist()) | set(profile.values)) <= S.CATEGORY_LIMIT:
        now = dict(zip(held.tolist(), (times / len(v)).tolist()))
        score = 0.5 * sum(abs(now.get(x, 0.0) - profile.values.get(x, 0.0)) for x in set(now) | set(profile.values))
    elif len(profile.edges) < 3:
        score = abs(float(v.mean()) - profile.mean) / profile.spread
    else:
        at = np.searchsorted(np.array(profile.edges[1:-1]), v, "right")
        q = np.maximum(np.bincount(at, minlength=len(profile.shares)) / len(v), 1e-6)
        p = np.maximum(np.array(profile.shares), 1e-6)
        score = float(((q - p) * np.log(q / p)).sum())
    return min(max(score, 0.0), 1.0)


def snapshot_row(profiles: dict[str, Profile], n_ref: int, current: pd.DataFrame, mode: str,
                 threshold: float = S.DRIFT_ALERT) -> dict:
    """The snapshot of one bounded window, as ``snapshot`` gives it."""
    n_cur = len(current)
    row = dict(ready=False, reference_mode=mode, reference_samples=n_ref, current_samples=n_cur, features_total=len(profiles),
               features_alerting=0, overall_score=0.0, drift_ratio=0.0, feature_scores={c: 0.0 for c in profiles})
    shared = [c for c in profiles if c in current.columns]
    if not n_cur or not shared:
        return row | {"reason": S.REASON_CURRENT if not n_cur else S.REASON_OVERLAP}
    found = {c: score_values(profiles[c], current[c].to_numpy(float, na_value=np.nan)) for c in shared} if n_ref >= 2 and n_cur >= 2 else {}
    scores = {c: round(v, 6) for c, v in sorted(found.items()) if v is not None}
    alerting = sum(v >= threshold for v in scores.values())
    return row | {
        "ready": bool(scores), "features_total": len(scores), "features_alerting": alerting, "reason": S.REASON_UPDATED,
        "overall_score": sum(scores.values()) / len(scores) if scores else 0.0, "drift_ratio": alerting / len(scores) if scores else 0.0,
        "feature_scores": scores}


def with_alerts(scores: DataFrame, threshold: float = S.DRIFT_ALERT) -> DataFrame:
    return scores.withColumn("alert", (F.round("score", 6) >= threshold).cast("int"))


def snapshot(reference: DataFrame | None, current: DataFrame, threshold: float = S.DRIFT_ALERT,
             mode: str = S.MODE_TRAIN, described: Reference | None = None) -> DataFrame:
    """One row on the state of drift: readiness, counts, ratio, mean score, scores by feature."""
    spark = current.sparkSession
    if reference is None:
        return _not_ready(spark, S.MODE_MISSING, 0, current.count(), S.REASON_WARMUP, [])
    described = described or describe_reference(reference)
    features = list(described.medians)
    if not set(features) & set(current.columns):
        n_cur = current.count()
        reason = S.REASON_OVERLAP if n_cur else S.REASON_CURRENT
        return _not_ready(spark, mode, described.rows, n_cur, reason, features)
    scores, n_cur = _scored(reference, current, S.DRIFT_BINS, described)
    if n_cur == 0:
        return _not_ready(spark, mode, described.rows, 0, S.REASON_CURRENT, features)
    scores = with_alerts(scores, threshold)
    return scores.agg(
        F.count(F.lit(1)).alias("features_total"),
        F.coalesce(F.sum("alert"), F.lit(0)).cast("long").alias("features_alerting"),
        F.coalesce(F.avg(F.round("score", 6)), F.lit(0.0)).alias("overall_score"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", F.round("score", 6))))).alias("feature_scores"),
    ).select(
        (F.col("features_total") > 0).alias("ready"), F.lit(mode).alias("reference_mode"),
        F.lit(described.rows).cast("long").alias("reference_samples"),
        F.lit(n_cur).cast("long").alias("current_samples"),
        "features_total", "features_alerting", "overall_score",
        F.coalesce(F.try_divide("features_alerting", "features_total"), F.lit(0.0)).alias("drift_ratio"),
        F.lit(S.REASON_UPDATED).alias("reason"), "feature_scores")


SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("ready", T.BooleanType()), T.StructField("reference_mode", T.StringType()),
    T.StructField("reference_samples", T.LongType()), T.StructField("current_samples", T.LongType()),
    T.StructField("features_total", T.LongType()), T.StructField("features_alerting", T.LongType()),
    T.StructField("overall_score", T.DoubleType()), T.StructField("drift_ratio", T.DoubleType()),
    T.StructField("reason", T.StringType()),
    T.StructField("feature_scores", T.MapType(T.StringType(), T.DoubleType())),
])


def _not_ready(spark, mode, n_ref, n_cur, reason, features) -> DataFrame:
    row = (False, mode, n_ref, n_cur, len(features), 0, 0.0, 0.0, reason, {c: 0.0 for c in features})
    return spark.createDataFrame([row], SNAPSHOT_SCHEMA)


def first_snapshot(spark: SparkSession, reference: DataFrame | None, file_name: str = "") -> DataFrame:
    """The state before any request: which file the reference came from, or that rows must gather first."""
    if reference is None:
        return _not_ready(spark, S.MODE_MISSING, 0, 0, S.REASON_WARMUP, [])
    described = describe_reference(reference)
    return _not_ready(spark, S.MODE_TRAIN, described.rows, 0, S.REASON_LOADED + file_name, list(described.medians))


def snapshot_of_requests(
    reference: DataFrame | None, requests: DataFrame, transform: Callable[[DataFrame], DataFrame],
    threshold: float = S.DRIFT_ALERT,
) -> DataFrame:
    """``snapshot`` of raw requests; where they cannot be transformed it says so and scores nothing.

    That is where ``transform`` fails as it builds its plan: missing columns, wrong types, no fitted state.
    """
    try:
        current = transform(requests)
    except (AnalysisException, ValueError, KeyError, AttributeError):
        spark = requests.sparkSession
        if reference is None:
            return _not_ready(spark, S.MODE_MISSING, 0, 0, S.REASON_TRANSFORM, [])
        described = describe_reference(reference)
        return _not_ready(spark, S.MODE_TRAIN, described.rows, 0, S.REASON_TRANSFORM, list(described.medians))
    return snapshot(reference, current, threshold)


def top_drifted(samples: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` features with the highest score over all reporting series."""
    return samples.groupBy("feature").agg(F.max("score").alias("score")).orderBy(
        F.desc("score"), "feature").limit(k)
