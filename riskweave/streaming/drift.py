"""Rolling drift of a stream: last rows per slot, baseline, snapshot per batch."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.operators import drift as D
from riskweave.sources.tables import read_if_there


class RollingDrift:
    """State of one stream in the shared folder, one version per micro-batch.

    A version depends only on the one before and the batch, so a repeated
    batch writes the same rows again. A slot's state never exceeds the window
    and baseline sizes; there may be any number of slots.
    """

    def __init__(self, spark: SparkSession, folder: str, features: Sequence[str], slot: str = "slot",
                 time: str = "ts", row_id: str = "request_id", reference: DataFrame | None = None,
                 window: int = S.DRIFT_WINDOW, warmup_least: int = S.DRIFT_WARMUP_ROWS,
                 warmup_most: int = S.DRIFT_REFERENCE_ROWS, threshold: float = S.DRIFT_ALERT):
        self.spark, self.folder, self.features = spark, folder, list(features)
        self.slot, self.time, self.row_id = slot, time, row_id
        self.reference, self.window, self.threshold = reference, window, threshold
        self.warmup_least, self.warmup_most = warmup_least, warmup_most
        self._known: tuple[int, dict[str, D.Profile]] | None = None

    def _version(self, kind: str, batch_id: int) -> DataFrame | None:
        return read_if_there(self.spark, f"{self.folder}/{kind}/version={batch_id}")

    def _write(self, df: DataFrame, kind: str, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{kind}/version={batch_id}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{kind}/version={batch_id}")

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(self.slot, self.time, self.row_id, *self.features)
        rows = D.last_rows(rows, [self.slot], self.time, self.row_id, self.window).drop("row_no")
        before = self._version("window", batch_id - 1)
        merged = rows if before is None else D.last_rows(
            rows.unionByName(before), [self.slot], self.time, self.row_id, self.window).drop("row_no")
        current = self._write(merged, "window", batch_id)
        columns, batch_no = [self.slot, *self.features], batch_id
        fields = [f for f in D.SNAPSHOT_SCHEMA.fields]
        schema = T.StructType([T.StructField(self.slot, current.schema[self.slot].dataType), *fields])
        features, slot, threshold = self.features, self.slot, self.threshold

        # a slot has at most one window and one baseline: each is a bounded group, and any number of slots is one job
        if self.reference is not None:
            n_ref, profiles = self._profiles()

            def one(key: tuple, live: pd.DataFrame) -> pd.DataFrame:
                row = D.snapshot_row(profiles, n_ref, live[features], S.MODE_TRAIN, threshold)
                return pd.DataFrame([{slot: key[0], **row}])

            shots = current.select(columns).groupBy(slot).applyInPandas(one, schema)
        else:
            frozen = self._baseline(batch, batch_id).filter("frozen")

            def pair(key: tuple, live: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
                if not len(live):
                    return pd.DataFrame(columns=[f.name for f in schema])
                made = {c: D.profile_of(base[c].to_numpy(float, na_value=np.nan)) for c in features} if len(base) else {}
                row = D.snapshot_row({c: p for c, p in made.items() if p is not None}, len(base), live[features],
                                     S.MODE_WARMUP if len(base) else S.MODE_MISSING, threshold)
                if not len(base):
                    row |= {"reason": S.REASON_WARMUP}
                return pd.DataFrame([{slot: key[0], **row}])

            shots = current.select(columns).groupBy(slot).cogroup(frozen.select(columns).groupBy(slot)).applyInPandas(pair, schema)
        shots = shots.withColumnRenamed(slot, "slot").withColumn("batch_id", F.lit(batch_no).cast("long"))
        self._write(shots, "snapshots", batch_id)

    def _profiles(self) -> tuple[int, dict[str, D.Profile]]:
        """The reference is read once for the whole stream."""
        if self._known is None:
            self._known = D.reference_profiles(D.feature_frame(self.reference, self.features))
        return self._known

    def _baseline(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """First rows per slot; a slot's baseline freezes once it is long enough."""
        rows = batch.select(self.slot, self.time, self.row_id, *self.features)
        before = self._version("baseline", batch_id - 1)
        if before is not None:
            done = before.filter("frozen").select(self.slot).distinct()
            open_rows = before.filter("not frozen").drop("frozen")
            rows = rows.join(done, self.slot, "left_anti").unionByName(open_rows)
        first = D.warmup_rows(rows, [self.slot], self.time, self.row_id, 1, self.warmup_most).withColumn(
            "frozen", F.max("row_no").over(D.Window.partitionBy(self.slot)) >= self.warmup_least).drop("row_no")
        if before is not None:
            first = first.unionByName(before.filter("frozen"))
        return self._write(first, "baseline", batch_id)

    def snapshots(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/snapshots").drop("version")
