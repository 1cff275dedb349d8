"""Behavioural history per customer without a window over the whole customer.

Rows of one customer and instant collapse to one point first. Range sums such
as "last 24 hours" are differences of two prefix sums, so each window only
runs a cumulative sum inside a (customer, time range) tile and a customer with
a third of all rows is spread over all tiles. Amounts are summed as decimals:
a difference of floating prefix sums would lose digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import scalars as X
from riskweave.operators.rank import ROWS_PER_BUCKET, cut_points, with_range
from riskweave.operators.skew import HOT_ROWS, hot_hashes, salted_left_join
from riskweave.session import settle

HOUR = 3_600_000_000
HORIZONS = {"1h": HOUR, "24h": 24 * HOUR, "30d": 720 * HOUR}
MONEY = "decimal(28,6)"


def customer_points(df: DataFrame, instant: str | Column | None = None) -> DataFrame:
    """One row per customer and instant; a stream groups by its own time column, which carries the watermark."""
    at = F.unix_micros("timestamp").alias("at") if instant is None else instant
    return df.groupBy("customer_id", at).agg(
        F.count(F.lit(1)).alias("n"), F.count(X.finite_or_null("amount")).alias("n_amount"),
        F.sum(X.finite_or_null("amount").try_cast(MONEY)).alias("amount_sum"),
        F.min("transaction_id").alias("first_id"))


def history(points: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Totals strictly before each point and before each horizon's start.

    Every point also asks for the totals at ``at - horizon``: these questions
    are sorted among the points and answered by the same cumulative sum.
    """
    asks = F.array(*[
        F.struct(F.lit(name).alias("ask"), (F.col("at") - back).alias("when"))
        for name, back in {"now": 0, **HORIZONS}.items()])
    nothing = F.lit(0).cast("long")
    is_point = F.col("ask") == "now"
    events = points.select("*", F.explode(asks).alias("q")).select(
        "customer_id", "at", "q.ask", "q.when", F.when(is_point, F.col("first_id")).alias("first_id"),
        F.when(is_point, F.col("n")).otherwise(nothing).alias("n"),
        F.when(is_point, F.col("n_amount")).otherwise(nothing).alias("n_amount"),
        F.when(is_point, F.coalesce("amount_sum", F.lit(0))).otherwise(F.lit(0)).cast("decimal(38,6)").alias("total"),
        F.when(is_point, F.col("when")).alias("seen"))
    # cut by all times, asked ones included: these may crowd where no point lies
    cuts = cut_points(events, "when", rows_per_bucket)
    events = with_range(events, "when", cuts).withColumnRenamed("_range", "tile")

    inside = Window.partitionBy("customer_id", "tile").orderBy("when", is_point).rowsBetween(
        Window.unboundedPreceding, -1)
    own = ["customer_id", "tile", "at", "ask", "first_id", "own_n"]
    local = events.withColumn("own_n", F.col("n")).select(
        *own, *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in ("n", "n_amount", "total")],
        F.max("seen").over(inside).alias("seen"))
    if cuts:
        # at most one row per customer and tile
        before = Window.partitionBy("customer_id").orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
        sums = events.groupBy("customer_id", "tile").agg(
            F.sum("n").alias("n"), F.sum("n_amount").alias("n_amount"),
            F.sum("total").alias("total"), F.max("seen").alias("seen"))
        carried = sums.select(
            "customer_id", "tile",
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"c_{c}") for c in ("n", "n_amount", "total")],
            F.max("seen").over(before).alias("c_seen"))
        local = local.join(carried, ["customer_id", "tile"]).select(
            *own, *[(F.col(c) + F.col(f"c_{c}")).alias(c) for c in ("n", "n_amount", "total")],
            F.coalesce("seen", "c_seen").alias("seen"))

    def at_ask(name: str, c: str):
        return F.max(F.when(F.col("ask") == name, F.col(c))).alias(f"{name}_{c}")

    return local.groupBy("customer_id", "at").agg(
        *[at_ask(name, c) for name in ("now", *HORIZONS) for c in ("n", "n_amount", "total")],
        at_ask("now", "seen"), F.max("first_id").alias("first_id"), F.max("own_n").alias("n"))


def behaviour(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``tx_count_last_1h``/``_24h`` (own row and its ties included),
    ``time_since_last_tx_min``, ``avg_amount_last_30d`` (strictly earlier rows)
    and ``amount_ratio_vs_avg``. Without a customer or a time all five are
    null; amounts that are not finite count in no average."""
    points = settle(customer_points(df), "points")
    past = history(points, rows_per_bucket)
    amounts_before = F.col("now_n_amount") - F.col("30d_n_amount")
    spent = (F.col("now_total") - F.col("30d_total")).cast("double")
    per_point = past.select(
        "customer_id", "at", "n", "first_id", F.col("now_seen").alias("previous"),
        (F.col("now_n") - F.col("1h_n") + F.col("n")).alias("tx_count_last_1h"),
        (F.col("now_n") - F.col("24h_n") + F.col("n")).alias("tx_count_last_24h"),
        F.try_divide(spent, amounts_before).alias("avg_amount_last_30d"))
    return attach(df, per_point, points, hot_rows)


def attach(df: DataFrame, per_point: DataFrame, counts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with their point's history; ``counts`` names the rows ``n`` of each point, to find hot ones."""
    hot = hot_hashes(counts, ["customer_id", "at"], "n", min_rows=hot_rows)
    rows = df.withColumn("at", F.unix_micros("timestamp"))
    joined = salted_left_join(rows, per_point, ["customer_id", "at"], hot, hot_rows)
    # the first id of an instant follows the previous instant, the others follow it
    since = F.when(F.col("n").isNull(), None).when(
        F.col("transaction_id") == F.col("first_id"), F.col("at") - F.col("previous")).otherwise(0)
    return joined.select(
        *df.columns, "tx_count_last_1h", "tx_count_last_24h",
        (since / 60_000_000.0).alias("time_since_last_tx_min"), "avg_amount_last_30d",
        F.try_divide("amount", "avg_amount_last_30d").alias("amount_ratio_vs_avg"))


def first_seen(df: DataFrame, what: str, flag: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``flag``: 1 on the customer's first row with this value of ``what``.

    A missing value is a value like others; rows without a customer get 0.
    """
    pair = ["customer_id", "_value", "_missing"]
    rows = df.withColumns({"_value": F.coalesce(F.col(what).cast("string"), F.lit("")), "_missing": F.col(what).isNull()})
    firsts = settle(
        rows.groupBy(*pair).agg(
            F.min(F.struct("timestamp", "transaction_id")).alias("first"), F.count(F.lit(1)).alias("n")),
        "first-seen")
    hot = hot_hashes(firsts, pair, "n", min_rows=hot_rows)
    joined = salted_left_join(rows, firsts, pair, hot, hot_rows)
    is_first = F.struct("timestamp", "transaction_id") == F.col("first")
    return joined.select(*df.columns, F.coalesce(is_first, F.lit(False)).cast("int").alias(flag))
