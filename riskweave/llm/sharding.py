"""Contiguous shards of near equal bytes from global prefix sums.

Rows are put in ranges of the order key, every range is summed on its own, and
the running totals of the ranges turn local sums into global ones. A document
belongs to the shard that holds the middle of its bytes, so shards differ from
the equal target by at most one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import settle

RANGE = "__range"


def sized(docs: DataFrame, text: str, overhead: int) -> DataFrame:
    """Adds ``size`` (UTF-8 bytes, none for a null text, plus ``overhead``) and ``text_crc32``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return (docs.withColumn("size", (F.octet_length(whole) + F.lit(overhead)).cast("long"))
            .withColumn("text_crc32", F.crc32(whole.cast("binary"))))


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 8,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, size, text_crc32, shard, slot, *carry) for every row of ``docs``, in the order of ``key``.

    Null texts have ``overhead`` bytes and the checksum of the empty text; null
    keys come first; repeated rows keep one place each; an empty table gives an
    empty result. Only the named columns are read, so others may have any name.
    """
    spark = docs.sparkSession
    narrow = sized(docs.select(key, text, *(c for c in carry if c != text)), text, overhead)
    if text not in carry:
        narrow = narrow.drop(text)
    # the tie breaker deals rows of one key over ranges
    tie = F.xxhash64(F.monotonically_increasing_id())
    ranged = settle(narrow.withColumn("__tie", tie)
                    .repartitionByRange(*_parts(spark), key, "text_crc32", "__tie")
                    .withColumn(RANGE, F.spark_partition_id()), "shard-ranges")

    totals = ranged.groupBy(RANGE).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    total = sum(t["bytes"] for t in totals)
    before = {}  # a pair of numbers for each range: as many as shuffle partitions
    at_bytes = at_rows = 0
    for t in sorted(totals, key=lambda t: t[RANGE]):
        before[t[RANGE]] = (at_bytes, at_rows)
        at_bytes, at_rows = at_bytes + t["bytes"], at_rows + t["n"]
    starts = spark.createDataFrame([(k, *v) for k, v in before.items()],
                                   f"{RANGE} int, __bytes long, __rows long")
    in_range = Window.partitionBy(RANGE).orderBy(key, "text_crc32", "__tie")
    upto = F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (ranged.withColumn("__upto", upto).withColumn("__n", F.row_number().over(in_range))
              .join(starts, RANGE)
              .withColumn("__middle", F.col("__bytes") + F.col("__upto") - F.expr("size div 2 + 1"))
              .withColumn("shard", F.least(F.lit(shards - 1), F.floor(
                  F.greatest(F.lit(0), F.col("__middle")).cast("decimal(38,0)") * shards / max(total, 1))).cast("int"))
              .withColumn("__row", F.col("__rows") + F.col("__n") - 1))
    placed = settle(placed.select(key, "size", "text_crc32", "shard", "__row", *carry), "shard-rows")
    first = placed.groupBy("shard").agg(F.min("__row").alias("__first"))
    return (placed.join(first, "shard").withColumn("slot", F.col("__row") - F.col("__first"))
            .select(key, "size", "text_crc32", "shard", "slot", *carry))


def _parts(spark) -> tuple[int, ...]:
    return (int(spark.conf.get("spark.sql.shuffle.partitions")),)


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes whole documents under ``path/shard=N`` and returns their places."""
    placed = assign_shards(docs, shards, key, text, carry=(text,))
    placed.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)


def balance(placed: DataFrame) -> DataFrame:
    """Bytes and rows per shard."""
    return placed.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
