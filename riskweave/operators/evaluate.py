"""Exact ranking metrics, threshold choice, segment report and regression gate.

All of it starts from one row per (group, score) with the positive and
negative counts; ties share a row, and raw rows are read once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators.rank import ROWS_PER_BUCKET, prefix_sums
from riskweave.session import settle

ALL = "ALL"


def score_counts(df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label") -> DataFrame:
    """Positives and negatives per distinct score (and group); rows without a label say nothing."""
    return df.filter(F.col(label).isin(0, 1)).groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def ranked(counts: DataFrame, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Cumulative ``tp``/``fp`` by falling score; expects ``settle``d counts."""
    return (
        prefix_sums(counts, by, "score", ["pos", "neg"], descending=True, rows_per_bucket=rows_per_bucket)
        .withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"}))


def totals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counts.groupBy(*by).agg(F.sum("pos").alias("p_total"), F.sum("neg").alias("n_total"))


def ratio(a: Column, b: Column) -> Column:
    """a/b, with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def precision_recall_f1(tp: Column, fp: Column, fn: Column) -> list[Column]:
    return [
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]


def pr_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One point per distinct score plus the end point (precision 1, recall 0)."""
    counts = settle(score_counts(df, (), score, label), "score-counts")
    p = counts.agg(F.sum("pos")).first()[0] or 0
    tp, fp = F.col("tp"), F.col("fp")
    points = ranked(counts).select(
        F.col("score").alias("threshold"), "tp", "fp", *precision_recall_f1(tp, fp, F.lit(p) - tp))
    end = df.sparkSession.createDataFrame([(None, 0, 0, 1.0, 0.0, 0.0)], points.schema)
    return points.unionByName(end)


def curve_metrics(df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label") -> DataFrame:
    """Average precision and ROC area per group."""
    return counts_metrics(settle(score_counts(df, by, score, label), "score-counts"), by)


def counts_metrics(
    counts: DataFrame, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Average precision is the step sum of precision over recall gains; the
    ROC area counts, per score, the negatives below the positives, ties half.
    Areas are null where a class is missing."""
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    wide = "decimal(38,0)"
    sums = ranked(counts, by, rows_per_bucket).groupBy(*by).agg(
        F.sum(F.try_divide(pos * tp, tp + fp)).alias("gained"),
        F.sum(neg.cast(wide) * (2 * tp - pos)).alias("twice_area"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return sums.select(
        *by, "n_pos", "n_neg",
        F.try_divide(F.col("gained"), F.col("n_pos")).alias("average_precision"),
        F.try_divide(F.col("twice_area").cast("double"), 2 * pairs).alias("roc_auc"))


def best_threshold(
    df: DataFrame, min_recall: float = S.MIN_RECALL, max_threshold: float = S.MAX_THRESHOLD,
    score: str = "score", label: str = "label",
) -> DataFrame:
    """One row: the chosen point and the rule that chose it.

    Rule 1 wants the recall within the threshold limit, rule 2 the recall
    alone, rule 3 takes the best recall. The highest precision wins within
    rules 1 and 2, the lowest threshold on ties.
    """
    return choose_threshold(
        pr_curve(df, score, label).filter(F.col("threshold").isNotNull()), min_recall, max_threshold)


def choose_threshold(points: DataFrame, min_recall: float, max_threshold: float) -> DataFrame:
    enough = F.col("recall") >= min_recall
    rule = F.when(enough & (F.col("threshold") <= max_threshold), 1).when(enough, 2).otherwise(3)
    worth = F.when(rule == 3, F.col("recall")).otherwise(F.col("precision"))
    return (
        points.withColumn("rule", rule).withColumn("_worth", worth)
        .orderBy("rule", F.desc("_worth"), "threshold").limit(1).drop("_worth")
        .withColumn("threshold_4dp", F.round("threshold", 4)))


def confusion(df: DataFrame, threshold: float, score: str = "score", label: str = "label",
              by: Sequence[str] = ()) -> DataFrame:
    hit, y = F.col(score) >= threshold, F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(~hit & ~y).alias("tn"), F.count_if(hit & ~y).alias("fp"),
        F.count_if(~hit & y).alias("fn"), F.count_if(hit & y).alias("tp"))


def metric_report(df: DataFrame, threshold: float, score: str = "score", label: str = "label") -> DataFrame:
    """Confusion matrix, point metrics and both areas in one row."""
    counts = settle(score_counts(df, (), score, label), "score-counts")
    hit = F.col("score") >= threshold
    matrix = counts.agg(*[
        F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).alias(name)
        for name, cond, c in (("tn", ~hit, "neg"), ("fp", hit, "neg"), ("fn", ~hit, "pos"), ("tp", hit, "pos"))
    ]).first()
    tp, fp, fn = (F.lit(matrix[c]) for c in ("tp", "fp", "fn"))
    return counts_metrics(counts).select(
        F.lit(threshold).alias("threshold"),
        *[F.lit(matrix[c]).alias(c) for c in ("tn", "fp", "fn", "tp")],
        *precision_recall_f1(tp, fp, fn), "average_precision", "roc_auc")


def segment_report(
    df: DataFrame, threshold: float, segment: str = "segment", score: str = "score", label: str = "label",
) -> DataFrame:
    """Row ``ALL`` and one row per segment, worst F1 first.

    A missing segment is a segment without a name; one that is called ``ALL``
    has a row of its own beside the total.
    """
    named = ["seg"]
    # the first letter tells the total, named and missing segments apart, so no key is null
    if segment in df.columns:
        name = F.col(segment).cast("string")
        source = df.withColumn("seg", F.when(name.isNull(), "-").otherwise(F.concat(F.lit("="), name)))
        per_segment = settle(score_counts(source, named, score, label), "score-counts")
        overall = per_segment.groupBy(F.lit("*").alias("seg"), "score").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        counts = settle(overall.unionByName(per_segment), "score-counts")
    else:
        counts = settle(score_counts(df.withColumn("seg", F.lit("*")), named, score, label), "score-counts")
    hit = F.col("score") >= threshold
    point = counts.groupBy("seg").agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_samples"), F.sum("pos").alias("n_fraud"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("n_fraud") - F.col("tp")
    areas = counts_metrics(counts, named).select("seg", F.col("average_precision").alias("pr_auc"))
    return point.join(areas, "seg").select(
        F.when(F.col("seg") == "*", ALL).when(F.col("seg") != "-", F.substring("seg", 2, 1 << 30)).alias("segment"),
        "n_samples", "n_fraud",
        (F.col("n_fraud") / F.col("n_samples") * 100).alias("fraud_rate"),
        *precision_recall_f1(tp, fp, fn),
        F.coalesce("pr_auc", F.lit(0.0)).alias("pr_auc"),
    ).orderBy("f1", "segment")


def named_segments(report: DataFrame, codes: DataFrame, column: str = "customer_tier") -> DataFrame:
    """Code -> label for the report; codes without a label keep their text."""
    labels = codes.filter(F.col("column") == column).select(
        F.col("code").cast("string").alias("segment"), F.col("value").alias("_label"))
    return report.join(labels, "segment", "left").withColumn(
        "segment", F.coalesce("_label", "segment")).drop("_label")


def regression_gate(
    current: DataFrame, baseline: DataFrame, tolerance: Mapping[str, float] = S.REGRESSION_TOLERANCE,
) -> DataFrame:
    """Compares ``(metric, value)`` tables; a metric that is absent counts 0."""
    spark = current.sparkSession
    limits = spark.createDataFrame(list(tolerance.items()), "metric string, tolerance double")
    out = (
        limits.join(current.select("metric", F.col("value").alias("current")), "metric", "left")
        .join(baseline.select("metric", F.col("value").alias("baseline")), "metric", "left")
        .fillna(0.0, ["current", "baseline"])
        .withColumn("delta", F.col("current") - F.col("baseline"))
        .withColumn("passed", F.col("delta") >= -F.col("tolerance")))
    everything = Window.partitionBy(F.lit(0))  # one row per tolerance entry
    return out.select(
        "metric", "baseline", "current", "delta", "tolerance",
        F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("status"),
        F.when(F.min("passed").over(everything), "PASS").otherwise("FAIL").alias("overall"))


def as_metrics(report: DataFrame) -> DataFrame:
    """The one-row metric report as ``(metric, value)``."""
    names = {"average_precision": "pr_auc", "roc_auc": "roc_auc", "f1": "f1",
             "precision": "precision", "recall": "recall"}
    one = report.select([F.col(c).cast("double").alias(n) for c, n in names.items()])
    return one.unpivot([], list(names.values()), "metric", "value")


def score_bands(df: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Batch response columns: score to 6 places, decision, risk band."""
    return df.withColumns({
        "is_fraud_pred": X.decision(score, threshold), "risk_level": X.risk_band(score),
        "fraud_score": F.round(score, 6)})


def batch_totals(banded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return banded.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.sum("is_fraud_pred").alias("fraud_detected"),
        F.avg("is_fraud_pred").alias("fraud_rate"))


def top_row(df: DataFrame, score: str = "score", row_id: str = "transaction_id") -> DataFrame:
    return df.orderBy(F.desc(score), row_id).limit(1)
