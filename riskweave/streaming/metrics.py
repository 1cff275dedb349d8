"""Metric aggregates of a stream, written as versions of each step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.metrics import per_step
from riskweave.session import scratch_path
from riskweave.streaming.requests import run_available


def stream_steps(
    log: DataFrame, labels: Sequence[str], aggs: Sequence[Column], step: str = "1 minute",
    late: str | None = None, time: str = "ts", label: str = "metrics",
) -> DataFrame:
    """Totals per step and label set, as the batch function gives them.

    The state holds a row per step and label set. A lateness bound ``late``
    lets old steps go, with whatever comes later than that; without one every
    row counts, in any order of the files. Each micro-batch writes the steps it
    changed to its own folder, so a repeated batch overwrites itself; the
    newest version of a step counts.
    """
    spark, out = log.sparkSession, scratch_path(log.sparkSession, label)
    totals = per_step(log if late is None else log.withWatermark(time, late), time, labels, aggs, step)
    schema = totals.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("version", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/part={batch_id}")

    run_available(totals.writeStream.outputMode("update").foreachBatch(write), label)
    versions = spark.read.parquet(out).drop("part")
    keys = ["step", *labels]
    values = [c for c in schema.names if c not in keys]
    return versions.groupBy(*keys).agg(
        F.max_by(F.struct(*values), "version").alias("v")).select(*keys, "v.*")
