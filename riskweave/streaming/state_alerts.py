"""Alert rules on a stream: pending, firing and resolved per label set, by event time.

Rows are first folded to one row per step and label set, which combines before
the shuffle; a step goes on once the watermark has passed it and can no longer
change. Per label set the state store then holds the steps of the rule's range
and where the alert stands; timers at event time evaluate steps without rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskweave.operators.alerts import Rule
from riskweave.operators.metrics import per_step
from riskweave.sources.tables import read_if_there

PENDING, FIRING, RESOLVED = "pending", "firing", "resolved"
STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MOMENTS = ("at_time", "pending_from", "firing_from", "firing_to")


@contextmanager
def timer_store(spark: SparkSession):
    """The state store that knows timers, for streams that start inside the block."""
    before = spark.conf.get(STORE_KEY)
    spark.conf.set(STORE_KEY, STORE)
    try:
        yield
    finally:
        spark.conf.set(STORE_KEY, before)


def millis(length: str) -> int:
    return int(pd.Timedelta(length).total_seconds() * 1000)


class RuleState(StatefulProcessor):
    """Evaluates one label set at every step's end that the watermark has reached."""

    def __init__(self, labels: Sequence[str], values: Sequence[str], met: Callable[[Mapping[str, float]], bool],
                 rule: Rule, step: str, absent: bool, start: int | None):
        self.labels, self.values, self.met, self.absent, self.start = list(labels), list(values), met, absent, start
        self.step, self.width, self.hold = millis(step), millis(rule.width), millis(rule.hold)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.standing = handle.getValueState("standing", "upcoming long, pending long, held long, firing boolean")
        self.steps = handle.getMapState("steps", "step long", ", ".join(f"v{i} double" for i in range(len(self.values))))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            for step, *values in frame[["step_ms", *self.values]].itertuples(index=False):
                self.steps.updateValue((int(step),), tuple(None if pd.isna(v) else float(v) for v in values))
                first = int(step) if first is None else min(first, int(step))
        if first is not None and not self.standing.exists():
            begin = first if self.start is None else min(first, self.start)
            self.standing.update((begin + self.step, None, None, False))
        yield from self._evaluate(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._evaluate(key, timerValues.getCurrentWatermarkInMs())

    def _evaluate(self, key: tuple, reached: int) -> Iterator[pd.DataFrame]:
        if not self.standing.exists():
            return
        at, pending, held, firing = self.standing.get()
        if at > reached:
            self.handle.registerTimer(at)
            return
        known = {k[0]: v for k, v in self.steps.iterator()}
        out: list[tuple] = []

        def tell(state: str) -> None:
            out.append((state, at, pending, pending + self.hold if state != PENDING else None, held if state != PENDING else None))

        while at <= reached:
            inside = [v for s, v in known.items() if at - self.width <= s < at]
            if not inside and pending is None and not self.absent:
                # nothing can be true before the range of the next step begins
                later = [s for s in known if s >= at]
                if not later:
                    break
                at = min(later) + self.step
                continue
            if self._holds(inside):
                pending, held = at if pending is None else pending, at
                if pending == at:
                    tell(PENDING)
                if not firing and at - pending >= self.hold:
                    firing = True
                    tell(FIRING)
            else:
                if firing:
                    tell(RESOLVED)
                pending, held, firing = None, None, False
            at += self.step
        if firing and (not out or out[-1][1] != held):
            out.append((FIRING, held, pending, pending + self.hold, held))     # one row a batch tells how far it has come
        for s in [s for s in known if s < at - self.width]:
            self.steps.removeKey((s,))
        left = any(s >= at - self.width for s in known)
        if left or pending is not None or self.absent:
            self.standing.update((at, pending, held, firing))
            self.handle.registerTimer(at)
        else:
            self.standing.clear()
        if out:
            told = pd.DataFrame(out, columns=["state", *MOMENTS])
            for i, label in enumerate(self.labels):
                told.insert(i, label, key[i])
            told[list(MOMENTS)] = told[list(MOMENTS)].astype("Int64")
            yield told

    def _holds(self, inside: list[tuple]) -> bool:
        if not inside:
            return self.absent
        sums = {}
        for i, name in enumerate(self.values):
            there = [v[i] for v in inside if v[i] is not None]
            sums[name] = sum(there) if there else None
        return bool(self.met(sums))

    def close(self) -> None:
        pass


def alert_stream(
    rows: DataFrame, time: str, labels: Sequence[str], aggs: Sequence[Column], met: Callable[[Mapping[str, float]], bool],
    rule: Rule, step: str = "1 minute", late: str = "5 minutes", absent: bool = False, start: int | None = None,
) -> DataFrame:
    """What becomes of ``rule`` in a stream of rows: one row per change, and one per batch for what fires.

    ``aggs`` are totals per step; ``met`` gets their sums over the last
    ``rule.width`` (None where all are null) and says whether the rule is true
    at the range's end. A range without any row is ``absent``. With ``start``
    (epoch milliseconds) a label set is evaluated from there once it is known,
    else from its first step on. Rows may come in any order within ``late`` of
    the newest; later ones are left out. Rows without a time are no
    measurements; a missing label is a label set of its own. Evaluations reach
    as far as the watermark. State per label set: the steps of one range and
    four numbers, nothing at all for a quiet one whose absence is no alert.
    """
    labels = list(labels)
    spark = rows.sparkSession
    if spark.conf.get(STORE_KEY) != STORE:
        raise RuntimeError(f"set {STORE_KEY} to {STORE}, or start the stream inside timer_store(spark)")
    totals = per_step(rows.withWatermark(time, late), time, labels, aggs, step)
    values = [c for c in totals.columns if c not in ("step", *labels)]
    keyed = totals.select(*labels, F.lit(rule.name).alias("_rule"), F.unix_millis("step").alias("step_ms"),
                          *[F.col(c).cast("double").alias(c) for c in values])
    schema = T.StructType([totals.schema[c] for c in labels] + [T.StructField("state", T.StringType())]
                          + [T.StructField(c, T.LongType()) for c in MOMENTS])
    told = keyed.groupBy(*labels, "_rule").transformWithStateInPandas(
        RuleState(labels, values, met, rule, step, absent, start), schema, "Append", "EventTime")
    return told.select(F.lit(rule.name).alias("alert"), F.lit(rule.severity).alias("severity"), *labels, "state",
                       *[F.timestamp_millis(c).alias(c) for c in MOMENTS])


class AlertTable:
    """Changes by micro-batch; a repeated batch overwrites its own folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def changes(self) -> DataFrame | None:
        return read_if_there(self.spark, self.folder)

    def fired(self, labels: Sequence[str] = ()) -> DataFrame:
        """Stretches as ``operators.alerts.firing`` gives them; open ones reach as far as the stream has come."""
        keys = ["alert", "severity", *labels, "pending_from", "firing_from"]
        return self.spark.read.parquet(self.folder).filter(F.col("state") != PENDING).groupBy(*keys).agg(
            F.max("firing_to").alias("firing_to"))
