"""Profiling, validation and quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators.rank import exact_quantiles
from riskweave.session import scratch_path


def missing_columns(df: DataFrame, required: Sequence[str] = S.REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def type_faults(df: DataFrame) -> list[str]:
    faults = []
    kinds = {f.name: f.dataType for f in df.schema}
    if "timestamp" in kinds and not isinstance(kinds["timestamp"], (T.TimestampType, T.TimestampNTZType)):
        faults.append("timestamp is not a time column")
    if "amount" in kinds and not isinstance(kinds["amount"], T.NumericType):
        faults.append("amount is not numeric")
    return faults


def null_counts(df: DataFrame, only_present: bool = True) -> DataFrame:
    """``(column, nulls)`` in one pass; columns without nulls left out by default."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = one.unpivot([], df.columns, "column", "nulls")
    return long.filter("nulls > 0") if only_present else long


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of the non-null values, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def value_counts_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``value_counts`` of several columns in one pass: ``(column, value, n)``."""
    return (
        df.select([F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def label_rate(label: str = "is_fraud") -> Column:
    return F.avg(label) * 100


def class_distribution(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n_legit"),
        F.count_if(F.col(label) == 1).alias("n_fraud"),
        label_rate(label).alias("fraud_rate_pct"),
    )


def amount_profile(df: DataFrame, column: str = "amount") -> DataFrame:
    """Minimum, median, two upper percentiles and the rows above the first."""
    clean = df.select(X.finite_or_null(column).alias(column))
    n, (median, p99, p999) = exact_quantiles(clean, [column], [(1, 2), (99, 100), (999, 1000)])[column]
    return clean.agg(
        F.min(column).alias("min_amount"),
        F.lit(median).cast("double").alias("median_amount"),
        F.lit(p99).cast("double").alias("p99"),
        F.lit(p999).cast("double").alias("p999"),
        F.count_if(F.col(column) > F.lit(p99)).alias("rows_above_p99"),
    )


def first_values(df: DataFrame, column: str, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).orderBy(*order).limit(n).select(*dict.fromkeys([*order, column]))


def shape(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """Whole profile as ``(metric, column, key, value)``; absent columns are skipped.

    Row count, nulls and label rate share one pass, all value counts another.
    """
    has = set(df.columns)

    def row(metric: str, column: str | None, key: str | None, value: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), F.lit(column).cast("string").alias("column"),
            F.lit(key).cast("string").alias("key"), value.cast("double").alias("value"))

    facts = {"rows": F.count(F.lit(1)), **{f"nulls_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}}
    rows = [row("rows", None, None, F.col("rows")), row("columns", None, None, F.lit(len(df.columns)))]
    rows += [row("nulls", c, None, F.nullif(F.col(f"nulls_{c}"), F.lit(0))) for c in df.columns]
    if "is_fraud" in has:
        facts["rate"] = label_rate()
        rows.append(row("rate_pct", "is_fraud", None, F.col("rate")))
    wide = df.agg(*[v.alias(k) for k, v in facts.items()]).select(F.inline(F.array(*rows)))
    profile = wide.filter((F.col("metric") != "nulls") | F.col("value").isNotNull())
    types = [row("dtype", c, t, F.lit(None)) for c, t in df.dtypes]
    profile = profile.unionByName(df.sparkSession.range(1).select(F.inline(F.array(*types))))
    counted = [c for c in ("is_fraud", "customer_tier", "cvv_match", "is_3d_secure") if c in has]
    if counted:
        profile = profile.unionByName(value_counts_of(df, counted).select(
            F.lit("values").alias("metric"), "column", F.col("value").alias("key"),
            F.col("n").cast("double").alias("value")))
    if "amount" in has:
        names = ["min_amount", "median_amount", "p99", "p999", "rows_above_p99"]
        amounts = amount_profile(df).select(
            F.inline(F.array(*[row("amount", "amount", c, F.col(c)) for c in names])))
        profile = profile.unionByName(amounts)
    if "timestamp" in has:
        text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        order = [c for c in ("timestamp", "transaction_id") if c in has]
        samples = first_values(df.select(order), "timestamp", order)
        ends = df.agg(F.min("timestamp").alias("timestamp"), F.max("timestamp").alias("last"))
        named = samples.select(F.lit("timestamp_sample").alias("metric"), text.alias("key")).unionByName(
            ends.select(F.lit("first_time").alias("metric"), text.alias("key"))).unionByName(
            ends.select(F.lit("last_time").alias("metric"), F.date_format("last", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("key")))
        profile = profile.unionByName(named.select(
            "metric", F.lit("timestamp").alias("column"), "key", F.lit(None).cast("double").alias("value")))
    return profile


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first per key; repeated nulls count as repeats."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    )


SHOWN_LABELS = 1000


def unexpected_labels(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.select(label).filter(F.col(label).isNotNull() & ~F.col(label).isin(0, 1)).distinct()


TABLE_RULES = (
    ("not_null", "timestamp", lambda c: c.isNull()),
    ("not_negative", "amount", lambda c: c < 0),
    ("binary", "is_fraud", lambda c: c.isNotNull() & ~c.isin(0, 1)),
    ("not_null", "customer_id", lambda c: c.isNull()),
)


def validation_report(df: DataFrame) -> DataFrame:
    """All table rules as ``(rule, column, violations)``; absent columns are skipped."""
    rules = [r for r in TABLE_RULES if r[1] in df.columns]
    if not rules:
        raise ValueError("none of the checked columns is present")
    wide = df.agg(*[F.count_if(broken(F.col(c))).alias(f"r{i}") for i, (_, c, broken) in enumerate(rules)])
    stacked = F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(c).alias("column"), F.col(f"r{i}").alias("violations"))
        for i, (n, c, _) in enumerate(rules)])
    report = wide.select(F.explode(stacked).alias("s")).select("s.*")
    if "transaction_id" in df.columns:
        report = report.unionByName(duplicate_rows(df, "transaction_id").select(
            F.lit("unique").alias("rule"), F.lit("transaction_id").alias("column"), "violations"))
    return report


def validate(df: DataFrame) -> DataFrame:
    """Raises one error naming every fault, else returns ``df``.

    Up to ``SHOWN_LABELS`` unexpected labels are named; of more the error names
    the number, the lowest ones and a table that holds all.
    """
    faults = [f"missing column {c}" for c in missing_columns(df)] + type_faults(df)
    if not type_faults(df):
        faults += [
            f"{r['violations']} rows break {r['rule']}({r['column']})"
            for r in validation_report(df).filter("violations > 0").collect()]
    if "is_fraud" in df.columns and any("binary" in f for f in faults):
        path = scratch_path(df.sparkSession, "unexpected-labels")
        unexpected_labels(df).write.parquet(path)
        seen = df.sparkSession.read.parquet(path)
        n = seen.count()
        shown = [r[0] for r in seen.orderBy("is_fraud").limit(SHOWN_LABELS).collect()]
        faults.append(f"unexpected labels {shown}" if n <= SHOWN_LABELS else
                      f"{n} unexpected labels, all of them in {path}, the lowest {shown}")
    if faults:
        raise ValueError("validation failed: " + "; ".join(faults))
    return df


FULL_DATE = r"^\s*\d{4}-\d{2}-\d{2}([T ]|\s*$)"


def request_rules(columns: Sequence[str]) -> list[tuple[str, Column]]:
    """Per-field faults of a request, each true where the field is wrong."""
    has = set(columns)
    rules = [
        (f"{c}:required", F.col(c).isNull())
        for c in ("transaction_id", "timestamp", "customer_id", "amount", "customer_tier") if c in has]
    rules += [(f"{c}:required", F.lit(True)) for c in
              ("transaction_id", "timestamp", "customer_id", "amount", "customer_tier") if c not in has]
    if "timestamp" in has:
        text = F.col("timestamp").cast("string")
        rules.append(("timestamp:format", F.col("timestamp").isNotNull()
                      & (X.parse_timestamp(text).isNull() | ~text.rlike(FULL_DATE))))
    if "amount" in has:
        # NaN sorts above every number and would pass a plain comparison
        rules.append(("amount:positive", F.isnan(F.col("amount").cast("double")) | (F.col("amount") <= 0)))
    if "customer_tier" in has:
        rules.append(("customer_tier:domain", ~X.upper_tier("customer_tier").isin(*S.CUSTOMER_TIERS)))
    rules += [(f"{c}:not_negative", F.col(c) < 0) for c in (
        "account_age_days", "distance_from_home_km", "tx_count_last_1h", "tx_count_last_24h",
        "time_since_last_tx_min", "avg_amount_last_30d", "amount_ratio_vs_avg") if c in has]
    rules += [(f"{c}:range", ~F.col(c).between(0, 1))
              for c in ("is_new_device", "is_new_merchant", "is_weekend") if c in has]
    if "hour_of_day" in has:
        rules.append(("hour_of_day:range", ~F.col("hour_of_day").between(0, 23)))
    return rules


def with_errors(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", X.violations(request_rules(df.columns)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``; valid rows have the tier in upper case."""
    checked = with_errors(df)
    valid = checked.filter(F.size("errors") == 0).drop("errors")
    return (
        valid.withColumn("customer_tier", X.upper_tier("customer_tier")),
        checked.filter(F.size("errors") > 0),
    )


def batch_size_ok(items: Column | str) -> Column:
    """Rule on the array of a batch message."""
    low, high = S.BATCH_ROWS
    return F.coalesce(F.size(items).between(low, high), F.lit(False))


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("empty batch")
    return df
