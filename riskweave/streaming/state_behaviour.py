"""Behavioural history on a stream of requests: the columns of ``operators.behaviour``, by event time.

Rows of one customer and instant fold to one point before the shuffle; a point
goes on once the watermark has passed it. Customers are dealt over slots, and
one call answers a slot's points of a batch together. Per customer the state
store holds the points of thirty days as one value; a busy customer's older
ones lie in chunks, whose totals tell enough unless a range begins inside.
First sightings are kept per (customer, value) and spread over the values of a
busy customer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskweave.operators import behaviour as B
from riskweave.operators.skew import HOT_ROWS
from riskweave.sources.tables import read_if_there
from riskweave.streaming.state_alerts import STORE, STORE_KEY

DAY_MS = 24 * B.HOUR // 1000
LONGEST = max(B.HORIZONS.values())
MICRO = 10 ** 6           # amounts are whole numbers of this part
MONEY = pa.decimal128(38, 6)
LOW = 0xFFFFFFFF
SLOTS = 1024
CHUNK = 512               # points of a chunk
POINT_COLUMNS = ("n", "first_id", "previous", "tx_count_last_1h", "tx_count_last_24h", "amounts_30d", "spent_30d")


def _decimal(amount: int) -> str:
    whole, part = divmod(abs(amount), MICRO)
    return f"{'-' if amount < 0 else ''}{whole}.{part:06d}"


def _words(texts: pd.Series) -> np.ndarray:
    """Amounts as 128-bit numbers of two longs, the low one first; a missing amount is 0."""
    amounts = pa.array(texts, pa.string(), from_pandas=True).cast(MONEY).fill_null(0)
    return np.frombuffer(amounts.buffers()[1], np.int64, 2 * len(amounts), 16 * amounts.offset).reshape(-1, 2)


def _texts(words: np.ndarray) -> np.ndarray:
    buffer = pa.py_buffer(np.ascontiguousarray(words))
    return pa.Array.from_buffers(MONEY, len(words), [None, buffer]).cast(pa.string()).to_numpy(zero_copy_only=False)


def _limbs(words: np.ndarray) -> np.ndarray:
    """Four limbs of 32 bits, the lowest first and the highest signed: sums of two billion of them are exact."""
    return np.column_stack([words[:, 0] & LOW, words[:, 0] >> 32 & LOW, words[:, 1] & LOW, words[:, 1] >> 32])


def _joined(limbs: np.ndarray) -> np.ndarray:
    rest, carry = [], np.zeros(len(limbs), np.int64)
    for i in range(4):
        whole = limbs[:, i] + carry
        rest.append(whole & LOW)
        carry = whole >> 32
    return np.column_stack([rest[0] | rest[1] << 32, rest[2] | rest[3] << 32])


def _before(values: np.ndarray) -> np.ndarray:
    """Sum of what stands before each place, and of all at the end."""
    out = np.zeros((len(values) + 1, *values.shape[1:]), np.int64)
    np.cumsum(values, axis=0, out=out[1:])
    return out


class CustomerState(StatefulProcessor):
    """Points of a slot's customers, or of one customer; those of a batch are later than all before them.

    A point is five longs: time, rows, amounts and the two words of their sum.
    A chunk's totals are these of its first instant, and its last one.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getMapState("points", "customer string", "rows binary, chunks int")
        self.totals = handle.getMapState("totals", "customer string", "rows binary")
        self.chunks = handle.getMapState("chunks", "customer string, first long", "rows binary")
        self.last = handle.getMapState("last", "customer string", "at long")
        self.newest = handle.getValueState("newest", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows), ignore_index=True)
        if "customer_id" not in fresh:
            fresh["customer_id"] = key[0]
        code, customers = pd.factorize(fresh["customer_id"])
        order = np.lexsort((fresh["at"].to_numpy(np.int64), code))
        fresh, code = fresh.iloc[order], code[order]
        own = np.column_stack([fresh["at"], fresh["n"], fresh["n_amount"], _words(fresh["amount_sum"])]).astype(np.int64, copy=False)
        at, n = own[:, 0], own[:, 1]
        ends = np.append(np.flatnonzero(np.diff(code)) + 1, len(code)).tolist()

        known = self.newest.exists()
        names = [str(c) for c in customers]
        pieces: list[np.ndarray] = []
        starts, opens, unknown, previous, folded = [], [], [], [], []    # by customer; a place is one in all pieces
        place = start = 0
        for name, end in zip(names, ends):
            mine, stored, folds = own[start:end], self.points.getValue((name,)) if known else None, None
            starts.append(place)
            unknown.append(stored is None)
            last = self.last.getValue((name,)) if known and stored is None else None
            previous.append(None if last is None else last[0])
            if stored is not None:
                if stored[1]:
                    folds = np.frombuffer(self.totals.getValue((name,))[0], np.int64).reshape(-1, 6)
                    for old in self._opened(name, folds, mine[:, 0]):
                        pieces.append(old)
                        place += len(old)
                opens.append(place)
                pieces.append(np.frombuffer(stored[0], np.int64).reshape(-1, 5))
                place += len(pieces[-1])
            else:
                opens.append(place)
            folded.append(folds)
            pieces.append(mine)
            place += len(mine)
            start = end
        starts.append(place)

        held = np.concatenate(pieces)
        sizes = np.diff(starts)
        owner = np.repeat(np.arange(len(names)), sizes)
        mine = np.bincount(code, minlength=len(names))
        # a customer's fresh points come last of theirs
        now = np.arange(len(at)) + np.repeat(np.array(starts[1:]) - np.cumsum(mine), mine)
        instants = np.unique(held[:, 0])
        step = len(instants) + 1
        ranked = owner * step + np.searchsorted(instants, held[:, 0])
        since = {name: np.searchsorted(ranked, code * step + np.searchsorted(instants, at - back)) for name, back in B.HORIZONS.items()}
        rows_before = _before(held[:, 1])
        amounts_before = _before(held[:, 2])
        spent_before = _before(_limbs(held[:, 3:]))
        before = pd.array(held[now - 1, 0], "Int64")
        firsts = np.flatnonzero(now == np.array(starts)[code])
        before[firsts] = pd.array([previous[c] for c in code[firsts].tolist()], "Int64")
        out = pd.DataFrame({
            "customer_id": customers.take(code), "at": at, "n": n, "first_id": fresh["first_id"].to_numpy(), "previous": before,
            "tx_count_last_1h": rows_before[now] - rows_before[since["1h"]] + n,
            "tx_count_last_24h": rows_before[now] - rows_before[since["24h"]] + n,
            "amounts_30d": amounts_before[now] - amounts_before[since["30d"]],
            "spent_30d": _texts(_joined(spent_before[now] - spent_before[since["30d"]]))})

        for k, (name, end) in enumerate(zip(names, ends)):
            # what begins before the newest point's longest range is asked for no more
            self._keep(name, held[max(opens[k], int(since["30d"][end - 1])):starts[k + 1]], folded[k], unknown[k])
        newest = int(at.max())
        if known:
            newest = max(newest, self.newest.get()[0])
        self.newest.update((newest,))
        # whole days: a slot has one timer a day at most
        self.handle.registerTimer(((newest + LONGEST) // 1000 // DAY_MS + 1) * DAY_MS)
        yield out

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Points that no later row can ask for go, the newest instant stays."""
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        idle = []
        for name, value in self.points.iterator():
            newest = int(np.frombuffer(value[0][-40:], np.int64)[0])
            if newest + LONGEST <= reached:
                idle.append((name[0], newest, value[1]))
        for name, newest, chunks in idle:
            if chunks:
                for fold in np.frombuffer(self.totals.getValue((name,))[0], np.int64).reshape(-1, 6).tolist():
                    self.chunks.removeKey((name, fold[0]))
            self.last.updateValue((name,), (newest,))
            self.totals.removeKey((name,))
            self.points.removeKey((name,))
        return iter([])

    def _opened(self, name: str, folds: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        """A customer's chunks: the points of those in which a range of ``at`` begins, the totals of the others."""
        starts = np.sort(np.concatenate([at - back for back in B.HORIZONS.values()]))
        inside = np.searchsorted(starts, folds[:, 5], "right") > np.searchsorted(starts, folds[:, 0], "right")
        for fold, cut in zip(folds, inside.tolist()):
            yield np.frombuffer(self.chunks.getValue((name, int(fold[0])))[0], np.int64).reshape(-1, 5) if cut else fold[None, :5]

    def _keep(self, name: str, points: np.ndarray, folds: np.ndarray | None, is_new: bool) -> None:
        """Stores a customer's points of no chunk; many of them make chunks, chunks that are too old go."""
        made = []
        if folds is not None:
            gone = folds[:, 5] < points[-1, 0] - LONGEST
            for first in folds[gone, 0].tolist():
                self.chunks.removeKey((name, first))
            made.append(folds[~gone])
        while len(points) >= 2 * CHUNK:
            full, points = points[:CHUNK], points[CHUNK:]
            self.chunks.updateValue((name, int(full[0, 0])), (full.tobytes(),))
            total = _joined(_limbs(full[:, 3:]).sum(axis=0, keepdims=True))[0]
            made.append(np.array([[full[0, 0], full[:, 1].sum(), full[:, 2].sum(), *total, full[-1, 0]]], np.int64))
        folds = np.concatenate(made) if made else None
        chunks = 0 if folds is None else len(folds)
        if made or is_new:
            self.totals.updateValue((name,), (b"" if folds is None else folds.tobytes(),))
        self.points.updateValue((name,), (points.tobytes(), chunks))

    def close(self) -> None:
        pass


class SightingState(StatefulProcessor):
    """Lets the first sighting of a (customer, value) through, and none after it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        first = min(rows, key=lambda r: (r["at"], r["first_id"] is None, r["first_id"]))
        self.seen.update((first["at"],))
        yield Row(customer_id=key[0], _value=key[1], _missing=key[2], at=first["at"], first_id=first["first_id"])

    def close(self) -> None:
        pass


def _needs_store(spark: SparkSession) -> None:
    if spark.conf.get(STORE_KEY) != STORE:
        raise RuntimeError(f"set {STORE_KEY} to {STORE}, or start the stream inside timer_store(spark)")


def history_stream(rows: DataFrame, late: str = "1 hour", slots: int = SLOTS) -> DataFrame:
    """One row per customer and instant, once the watermark has passed it: what ``operators.behaviour`` says of it.

    Rows may come in any order within ``late`` of the newest; later ones are
    left out. Rows without a time or a customer have no history. State per
    customer: 40 bytes per instant of the last thirty days, then the newest
    instant alone. One task handles the instants of a batch of a slot, all
    customers whose hash it is; a checkpoint keeps its number of ``slots``.
    Bound the batch by ``maxFilesPerTrigger`` when catching up.
    """
    _needs_store(rows.sparkSession)
    known = rows.filter(F.col("timestamp").isNotNull() & F.col("customer_id").isNotNull()).withWatermark("timestamp", late)
    points = B.customer_points(known, "timestamp").select(
        F.pmod(F.xxhash64("customer_id"), F.lit(slots)).alias("slot"), "customer_id", F.unix_micros("timestamp").alias("at"), "n", "n_amount",
        F.col("amount_sum").cast("decimal(38,6)").cast("string").alias("amount_sum"), "first_id")
    kinds = {"n": "long", "first_id": points.schema["first_id"].dataType.simpleString(), "spent_30d": "string"}
    schema = T.StructType([points.schema["customer_id"], T.StructField("at", T.LongType())])
    for c in POINT_COLUMNS:
        schema = schema.add(c, kinds.get(c, "long"))
    told = points.groupBy("slot").transformWithStateInPandas(CustomerState(), schema, "Append", "EventTime")
    return told.withColumn("avg_amount_last_30d", F.try_divide(
        F.col("spent_30d").cast("decimal(38,6)").cast("double"), F.col("amounts_30d"))).drop("spent_30d", "amounts_30d")


def sighting_stream(rows: DataFrame, what: str, late: str = "1 hour", step: str = "1 hour") -> DataFrame:
    """(customer_id, _value, _missing, at, first_id) of each first sighting, once its step has passed the watermark.

    Sightings fold to one per step before the shuffle. The state is one long
    per (customer, value) and grows with their number, as the question asks.
    """
    _needs_store(rows.sparkSession)
    known = rows.filter(F.col("timestamp").isNotNull() & F.col("customer_id").isNotNull()).withWatermark("timestamp", late)
    value = F.coalesce(F.col(what).cast("string"), F.lit("")).alias("_value")
    firsts = known.groupBy("customer_id", value, F.col(what).isNull().alias("_missing"), F.window("timestamp", step)).agg(
        F.min(F.struct("timestamp", "transaction_id")).alias("first")).select(
        "customer_id", "_value", "_missing", F.unix_micros("first.timestamp").alias("at"), F.col("first.transaction_id").alias("first_id"))
    return firsts.groupBy("customer_id", "_value", "_missing").transformWithState(
        SightingState(), firsts.schema, "Append", "EventTime")


class HistoryTable:
    """What a stream told, by micro-batch; a repeated batch overwrites its own folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def rows(self) -> DataFrame | None:
        told = read_if_there(self.spark, self.folder)
        return None if told is None else told.drop("batch")

    def attach(self, df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
        """``df`` with the columns of ``operators.behaviour``; null where the stream has not come yet."""
        told = self.rows()
        return B.attach(df, told, told, hot_rows)

    def attach_first(self, df: DataFrame, what: str, flag: str) -> DataFrame:
        """``df`` with ``flag`` as ``operators.behaviour.first_seen`` sets it; rows the stream has not come to get 0."""
        told = self.rows().select("customer_id", F.col("first_id").alias("transaction_id"), "at", "_value", "_missing", F.lit(1).alias("_first"))
        keyed = df.withColumns({"at": F.unix_micros("timestamp"), "_value": F.coalesce(F.col(what).cast("string"), F.lit("")),
                                "_missing": F.col(what).isNull()})
        return keyed.join(told, ["customer_id", "transaction_id", "at", "_value", "_missing"], "left").select(
            *df.columns, F.coalesce("_first", F.lit(0)).alias(flag))
