"""Chronological split by an exact cut key instead of a rank on every row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.rank import kth_text, order_statistics

_LAST = 2**63 - 1


@dataclass(frozen=True)
class Cut:
    """First key that belongs to the later part.

    Both conditions compare the bare time column, so they reach the scan;
    rows without a time belong to the end.
    """

    micros: int
    row_id: str | None

    def _tied(self, row_id: str) -> Column:
        return F.lit(False) if self.row_id is None else F.col(row_id).cast("string") < self.row_id

    def earlier(self, time: str, row_id: str) -> Column:
        t = F.col(time)
        if self.micros == _LAST:
            return t.isNotNull() | self._tied(row_id)
        at = F.timestamp_micros(F.lit(self.micros))
        return (t < at) | ((t == at) & self._tied(row_id))

    def later(self, time: str, row_id: str) -> Column:
        t = F.col(time)
        if self.micros == _LAST:
            return t.isNull() & ~self._tied(row_id)
        at = F.timestamp_micros(F.lit(self.micros))
        return (t > at) | ((t == at) & ~self._tied(row_id)) | t.isNull()


def _micros(time: str) -> Column:
    # rows without a time sort last
    return F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(_LAST))


def find_cut(df: DataFrame, ratio: float, time: str = "timestamp", row_id: str = "transaction_id") -> Cut:
    """The key at row ``int(n * ratio)`` in (time, id) order.

    The time is found by exact order statistics; ids are ranked only among the
    rows that share it.
    """
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")
    keys = df.select(_micros(time).alias("_micros"), F.col(row_id).cast("string").alias("_id"))
    n, found = order_statistics(keys, ["_micros"], [ratio], lambda n: [int(n * ratio)])
    if n == 0:
        raise ValueError("nothing to split")
    micros, below = found["_micros"][1][int(n * ratio)]
    ties = int(n * ratio) - below
    if ties == 0:
        return Cut(micros, None)
    return Cut(micros, kth_text(keys.filter(F.col("_micros") == micros), "_id", ties))


def chrono_split(
    df: DataFrame, ratio: float = 0.8, time: str = "timestamp", row_id: str = "transaction_id",
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: two disjoint filters whose union is ``df``."""
    cut = find_cut(df, ratio, time, row_id)
    return df.filter(cut.earlier(time, row_id)), df.filter(cut.later(time, row_id))


def split_summary(train: DataFrame, test: DataFrame, time: str = "timestamp", label: str = "is_fraud") -> DataFrame:
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_time"),
        F.max(time).alias("last_time"), (F.avg(label) * 100).alias("fraud_rate_pct"))
