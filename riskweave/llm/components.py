"""Connected components by alternating large and small stars, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import settle


def _lowest(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, itself included; combined before the shuffle."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (src, dst: long) that is not its component's smallest.

    Self links and repeated links count once; null ends are ignored; no links
    give an empty table. Each round writes its links, so a lost executor costs
    a re-read. Rounds end when the links no longer change.
    """
    clean = links.filter("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    now = settle(clean.distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        joined = large.join(_lowest(large), "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = settle(small.select("e.u", "e.v").filter("u <> v").distinct(), "links")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
