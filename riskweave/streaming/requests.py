"""Streams of scoring requests: sources, message parsing and run helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskweave import schema as S
from riskweave.operators.quality import batch_size_ok
from riskweave.session import scratch_path


def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The files ``name*.parquet`` of a folder as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def parse_messages(messages: DataFrame, body: str = "value", schema: T.StructType = S.REQUEST_SCHEMA) -> DataFrame:
    """One row per request: a message holds one record or a list of records.

    Messages that break the size rule keep a single row with ``message_ok``
    false and no record.
    """
    parsed = messages.withColumn("_items", F.from_json(F.col(body), T.ArrayType(schema))).withColumn(
        "message_ok", batch_size_ok("_items"))
    items = F.when(F.col("message_ok"), F.col("_items")).otherwise(
        F.array(F.lit(None).cast(schema)))
    rest = [c for c in messages.columns if c != body]
    return parsed.select(*rest, "message_ok", F.explode(items).alias("_r")).select(*rest, "message_ok", "_r.*")


def run_available(writer, label: str, timeout_s: int | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Runs a stream over what is there and waits for its end, however long it takes.

    A caller with a ``timeout_s`` gets an error after that many seconds.

    With a ``checkpoint`` folder of the caller's a later run goes on where
    this one ended; without one every run starts anew.
    """
    folder = checkpoint or scratch_path(SparkSession.getActiveSession(), f"{label}-offsets")
    query = writer.option("checkpointLocation", folder).trigger(availableNow=True).start()
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {label} did not end in {timeout_s} s")
    return query
