"""Rolling drift kept in the stream's own state store.

A slot's last rows and its baseline are one state value, written with the
batch's offsets: a restart goes on from the checkpoint, and only the slots of a
batch are read or written. The store keeps a fixed number of versions, so what
it takes on disk follows the number of slots and not of batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskweave import schema as S
from riskweave.operators import drift as D
from riskweave.sources.tables import read_if_there

HELD_ROWS = 500_000     # that a task holds of all its slots
STATE = "held binary, baseline binary, frozen boolean, seen long"


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_all().to_pandas()


def _cut(rows: pa.Table, order: Sequence[str], first: int, last: int) -> pa.Table:
    """The ``first`` and the ``last`` rows by ``order``, in the order of arrival."""
    if len(rows) <= first + last:
        return rows
    at = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in order]).to_numpy()
    return rows.take(pa.array(np.sort(np.concatenate([at[:first], at[len(at) - last:]]))))


def slot_ends(rows: DataFrame, slot: str, order: Sequence[str], first: int, last: int) -> DataFrame:
    """``rows`` of which each task keeps a slot's ``first`` and ``last`` by ``order``; ``_rows`` counts those left out as well.

    What a task holds is bounded: with very many slots it hands on what it has and starts anew.
    """
    most = first + last

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, tuple[pa.Table, int]] = {}       # rows and how many came

        def handed() -> Iterator[pa.RecordBatch]:
            for kept, came in held.values():
                kept = _cut(kept, order, first, last)
                n = np.ones(len(kept), np.int64)
                n[:1] += came - len(kept)
                yield from kept.append_column("_rows", pa.array(n)).to_batches()
            held.clear()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = batch.column(batch.schema.get_field_index(slot)).dictionary_encode("encode")
            for i, key in enumerate(keys.dictionary.to_pylist()):
                own = table.filter(pc.equal(keys.indices, i))
                before, came = held.get(key, (own.slice(0, 0), 0))
                kept = pa.concat_tables([before, own])
                held[key] = (_cut(kept, order, first, last) if len(kept) > 2 * most else kept, came + len(own))
            if sum(len(t) for t, _ in held.values()) > HELD_ROWS:
                yield from handed()
        yield from handed()

    schema = T.StructType([*rows.schema.fields, T.StructField("_rows", T.LongType())])
    return rows.mapInArrow(work, schema)


def drift_stream(
    rows: DataFrame, features: Sequence[str], slot: str = "slot", time: str = "ts", row_id: str = "request_id",
    reference: DataFrame | None = None, window: int = S.DRIFT_WINDOW, warmup_least: int = S.DRIFT_WARMUP_ROWS,
    warmup_most: int = S.DRIFT_REFERENCE_ROWS, threshold: float = S.DRIFT_ALERT,
) -> DataFrame:
    """A snapshot of each slot that a micro-batch touches; ``seen`` counts the slot's rows so far.

    A slot's window is its last ``window`` rows by time and id, in any order of
    arrival. Without a ``reference`` a slot's first rows become its baseline: it
    takes up to ``warmup_most`` rows and freezes with the batch that brings it to
    ``warmup_least``. Rows without a slot are one slot. The state of a slot is
    bounded by the two sizes. Tasks first keep what a slot's window and baseline
    can take of their rows, so a slot's Python sees a few thousand rows of each.
    """
    features = list(features)
    known = D.reference_profiles(D.feature_frame(reference, features)) if reference is not None else None
    kind = rows.schema[slot].dataType
    schema = T.StructType([T.StructField("slot", kind), T.StructField("seen", T.LongType()), *D.SNAPSHOT_SCHEMA.fields])
    order = [time, row_id]
    columns = [*order, *features]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        both = partial(pd.concat, ignore_index=True)
        held, baseline, frozen, seen = None, None, False, 0
        if state.exists:
            a, b, frozen, seen = state.get
            held, baseline = _unpacked(a), _unpacked(b)
        for new in frames:
            seen += int(new["_rows"].sum())
            new = new[columns]
            held = both([new.iloc[:0] if held is None else held, new]).sort_values(order, kind="stable").tail(window)
            if known is None and not frozen:
                baseline = both([new.iloc[:0] if baseline is None else baseline, new]).sort_values(order, kind="stable").head(warmup_most)
            elif baseline is None:
                baseline = new.iloc[:0]
        frozen = frozen or known is None and len(baseline) >= warmup_least
        state.update((_packed(held), _packed(baseline), frozen, seen))
        if known is not None:
            n_ref, profiles = known
            row = D.snapshot_row(profiles, n_ref, held[features], S.MODE_TRAIN, threshold)
        elif frozen:
            made = {c: D.profile_of(baseline[c].to_numpy(float, na_value=float("nan"))) for c in features}
            row = D.snapshot_row({c: p for c, p in made.items() if p is not None}, len(baseline), held[features], S.MODE_WARMUP, threshold)
        else:
            row = D.snapshot_row({}, 0, held[features], S.MODE_MISSING, threshold) | {"reason": S.REASON_WARMUP}
        yield pd.DataFrame([{"slot": key[0], "seen": seen, **row}])

    ends = slot_ends(rows.select(slot, *columns), slot, order, warmup_most if known is None else 0, window)
    return ends.groupBy(slot).applyInPandasWithState(step, schema, STATE, "update", GroupStateTimeout.NoTimeout)


class SnapshotTable:
    """Snapshots by micro-batch; a repeated batch overwrites its own folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def all(self) -> DataFrame | None:
        return read_if_there(self.spark, self.folder)

    def latest(self) -> DataFrame:
        """The newest snapshot of each slot."""
        every = self.spark.read.parquet(self.folder)
        names = [c for c in every.columns if c not in ("slot", "batch")]
        newest = every.groupBy("slot").agg(F.max_by(F.struct(*names), "batch").alias("s"))
        return newest.select("slot", "s.*")
