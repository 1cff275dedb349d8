"""Joins of facts to per-key tables when one key may hold most of the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 1000          # a key is hot above 1/1000 of the rows ...
NULL_SALTS = 1000         # tasks that share the rows without a key
HOT_ROWS = 1_000_000      # ... and above this many rows


def hot_hashes(
    per_key: DataFrame, on: Sequence[str], weight: str,
    share: int = HOT_SHARE, min_rows: int = HOT_ROWS,
) -> dict[int, int]:
    """Hash of each hot key -> its rows; fewer than ``share`` keys can qualify."""
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    floor = max(total // share, min_rows)
    if total <= floor:
        return {}
    rows = per_key.filter(F.col(weight) > floor).select(F.xxhash64(*on).alias("h"), weight).collect()
    return {r["h"]: r[weight] for r in rows}


def salted_left_join(
    facts: DataFrame, per_key: DataFrame, on: Sequence[str],
    hot: dict[int, int], min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to a table with one row per key.

    Rows of a hot key are dealt over several salts and only that key's single
    row is repeated per salt. Facts without a key match nothing and are dealt
    over ``NULL_SALTS`` salts, so they do not meet in one task either. The
    join's strategy is left to the optimizer.
    """
    hashed = [f.name for f in facts.schema if not isinstance(f.dataType, T.MapType)]
    keyless = reduce(or_, [F.col(c).isNull() for c in on])
    spread = (F.pmod(F.xxhash64(*hashed) + F.spark_partition_id(), F.lit(NULL_SALTS)) + 1).cast("int")
    if not hot:
        dealt = facts.withColumn("_salt", F.when(keyless, spread).otherwise(0))
        return dealt.join(per_key.withColumn("_salt", F.lit(0)), [*on, "_salt"], "left").drop("_salt")
    salts = int(min(1000, max(2, -(-max(hot.values()) // min_rows))))
    is_hot = F.xxhash64(*on).isin(list(hot))
    # the input partition in the salt parts equal rows, too
    deal = F.pmod(F.xxhash64(*hashed) + F.spark_partition_id(), F.lit(salts))
    dealt = facts.withColumn("_salt", F.when(keyless, spread).when(is_hot, deal.cast("int")).otherwise(0))
    repeated = per_key.withColumn("_salt", F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(repeated, [*on, "_salt"], "left").drop("_salt")
