"""Behavioural history on a stream against the batch operators on the rows the watermark has passed."""

import numpy as np
import pandas as pd
import pytest
from data import lopsided
from pyspark.sql import Row
from pyspark.sql import functions as F

from riskweave.operators import behaviour as B
from riskweave.streaming import requests as SR
from riskweave.streaming import state_behaviour as SB
from riskweave.streaming.state_alerts import timer_store

LATE_S = 36 * 3600


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """A hot customer with a crowded instant; customers, times and amounts missing; one customer idle for over thirty days."""
    i = F.col("transaction_id").cast("int")
    idle = (i % 40 == 1) & F.unix_seconds("timestamp").between(1_700_300_000, 1_703_500_000)
    dirty = lopsided(spark).filter(~idle).withColumns({
        "amount": F.when(i % 50 == 3, F.lit(None)).when(i % 50 == 4, float("nan")).when(i % 50 == 6, -F.col("amount")).otherwise(F.col("amount")),
        "customer_id": F.when(i % 101 != 5, F.col("customer_id")),
        "device_type": F.when(i % 7 != 2, F.col("device_type")),
        "timestamp": F.when(i % 103 != 5, F.col("timestamp"))})
    path = str(tmp_path_factory.mktemp("rows") / "all")
    dirty.write.parquet(path)
    return spark.read.parquet(path)


def _run(spark, rows, folder, stream):
    """Three parts, up to a day out of order at their borders, each by a run of its own."""
    moved = F.unix_seconds("timestamp") + F.pmod(F.xxhash64("transaction_id"), F.lit(86_400))
    part = F.coalesce(F.least(((moved - 1_700_000_000) / 1_350_000).cast("int"), F.lit(2)), F.lit(0))
    told = SB.HistoryTable(spark, str(folder / "told"))
    with timer_store(spark):
        for k in range(3):
            rows.filter(part == k).coalesce(2).write.parquet(str(folder / "in" / f"p{k}"))
            feed = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option(
                "maxFilesPerTrigger", 2).parquet(str(folder / "in"))
            out = stream(feed).writeStream.outputMode("append").foreachBatch(told.on_batch)
            SR.run_available(out, "behaviour", checkpoint=str(folder / "offsets"))
    return told


def _reached(rows):
    return rows.agg(F.max(F.unix_seconds("timestamp"))).first()[0] - LATE_S


def test_history_equals_batch_in_any_order_and_after_restarts(spark, rows, tmp_path):
    told = _run(spark, rows, tmp_path, lambda feed: SB.history_stream(feed, f"{LATE_S} seconds"))
    reached = _reached(rows)
    past = F.unix_seconds("timestamp") <= reached
    got = {r.transaction_id: r for r in told.attach(rows).filter(past).collect()}
    want = {r.transaction_id: r for r in B.behaviour(rows).filter(past).collect()}
    assert len(want) > 2000 and [k for k in want if str(got[k]) != str(want[k])] == []
    assert {r.tx_count_last_1h for r in told.attach(rows).filter(F.unix_seconds("timestamp") > reached).collect()} == {None}
    assert told.rows().groupBy("customer_id", "at").count().filter("count > 1").isEmpty()


def test_first_sightings_equal_batch(spark, rows, tmp_path):
    told = _run(spark, rows, tmp_path, lambda feed: SB.sighting_stream(feed, "device_type", f"{LATE_S} seconds"))
    timed = rows.filter("timestamp is not null")
    past = (F.floor(F.unix_seconds("timestamp") / 3600) + 1) * 3600 <= _reached(rows)
    got = {r.transaction_id: r.flag for r in told.attach_first(timed, "device_type", "flag").filter(past).collect()}
    want = {r.transaction_id: r.flag for r in B.first_seen(timed, "device_type", "flag").filter(past).collect()}
    assert got == want and sum(want.values()) > 60


class _Map(dict):
    def iterator(self):
        return iter(list(self.items()))

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class _Value:
    now = None

    def exists(self):
        return self.now is not None

    def get(self):
        return self.now

    def update(self, value):
        self.now = value


class _Handle:
    def __init__(self):
        self.maps, self.value, self.timers = {}, _Value(), set()

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Map())

    def getValueState(self, *_):
        return self.value

    def registerTimer(self, at):
        self.timers.add(at)


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _points(at):
    return pd.DataFrame({"at": at, "n": 1, "n_amount": 1, "amount_sum": "9999999999999999999999.999999", "first_id": "x"})


def test_state_stays_within_thirty_days_and_sums_stay_exact():
    handle, state = _Handle(), SB.CustomerState()
    state.init(handle)
    step = 6 * B.HOUR
    for start in range(0, 1200, 40):
        at = np.arange(start, start + 40, dtype=np.int64) * step
        (out,) = state.handleInputRows(("c",), iter([_points(at[::-1])]), None)
        assert out["amounts_30d"].tolist() == [min(k, 120) for k in range(start, start + 40)]
        k = int(out["amounts_30d"].iloc[-1])
        assert out["spent_30d"].iloc[-1] == SB._decimal(k * (10 ** 28 - 1))
        assert len(handle.maps["totals"]) <= 162 and handle.maps["totals"].keys() == handle.maps["points"].keys()
    assert len(handle.timers) <= 300
    newest = handle.value.get()[0]
    list(state.handleExpiredTimer(("c",), _Clock(newest // 1000), None))
    assert len(handle.maps["points"]) > 0
    list(state.handleExpiredTimer(("c",), _Clock((newest + SB.LONGEST) // 1000), None))
    assert not handle.maps["points"] and not handle.maps["totals"] and handle.value.exists()


def test_a_sighting_is_told_once_and_takes_rows():
    handle, state = _Handle(), SB.SightingState()
    state.init(handle)
    rows = [Row(at=at, first_id=i) for at, i in ((7, "b"), (5, None), (5, "c"), (5, "a"))]
    assert list(state.handleInputRows(("c", "", True), iter(rows), None)) == [
        Row(customer_id="c", _value="", _missing=True, at=5, first_id="a")]
    assert list(state.handleInputRows(("c", "", True), iter([Row(at=1, first_id="z")]), None)) == []
    assert handle.value.get() == (5,)


def test_the_store_is_named(spark, rows, tmp_path):
    rows.limit(0).write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    with pytest.raises(RuntimeError, match="providerClass"):
        SB.history_stream(feed)


class _Store(_Map):
    """Counts what is read and written one by one."""

    calls = 0

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value


class _SlotHandle(_Handle):
    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Store())


def _slot_points(rows):
    """Points of (customer, time, amount in cents)."""
    return pd.DataFrame({"slot": 0, "customer_id": [c for c, _, _ in rows], "at": [at for _, at, _ in rows], "n": 2, "n_amount": 1,
                         "amount_sum": [None if a is None else SB._decimal(a * 10_000) for _, _, a in rows], "first_id": "x"})


def _told(seen, rows):
    """What is to be said of ``rows`` after ``seen``, all points of the slot up to them."""
    out = {}
    for c, at, _ in rows:
        past = [(t, a) for who, t, a in seen if who == c and t < at]
        span = [a for t, a in past if t >= at - SB.LONGEST]
        recent = [2 * sum(t >= at - back for t, _ in past) + 2 for back in (B.HORIZONS["1h"], B.HORIZONS["24h"])]
        out[c, at] = (max((t for t, _ in past), default=None), *recent, len(span), SB._decimal(sum(a or 0 for a in span) * 10_000))
    return out


@pytest.mark.parametrize("chunk", [4, 512])
def test_a_slot_tells_its_customers_apart_and_reads_chunks(chunk, monkeypatch):
    monkeypatch.setattr(SB, "CHUNK", chunk)
    handle, state = _SlotHandle(), SB.CustomerState()
    state.init(handle)
    seen = []
    for batch in range(12):
        # a busy customer, sparse ones, one that stays away for over thirty days and one that comes late
        lo = batch * 5 * 24
        rows = [("busy", lo + k / 2, k - 20) for k in range(0, 240, 3)]
        rows += [(f"c{i}", lo + 7 * i + 20 * k, None if i == 2 else 10 ** 11 * i) for i in range(4) for k in range(3)]
        rows += [("away", lo + 3, 5)] if batch in (0, 10) else []
        rows += [("late", lo + 4, -7)] if batch > 6 else []
        rows = [(c, int(h * B.HOUR), a) for c, h, a in rows]
        seen += rows
        (out,) = state.handleInputRows((0,), iter([_slot_points(rows[5:]), _slot_points(rows[:5])]), None)
        got = {(r.customer_id, r.at): (None if pd.isna(r.previous) else r.previous, r.tx_count_last_1h, r.tx_count_last_24h, r.amounts_30d, r.spent_30d)
               for r in out.itertuples()}
        assert got == _told(seen, rows)
        list(state.handleExpiredTimer((0,), _Clock(max(at for _, at, _ in rows) // 1000), None))
        assert (("away",) in handle.maps["points"]) == (batch < 6 or batch >= 10)
        assert len(handle.maps["chunks"]) <= (6 * 80 + 80) // chunk
    assert bool(handle.maps["chunks"]) == (chunk == 4)
    list(state.handleExpiredTimer((0,), _Clock((handle.value.get()[0] + SB.LONGEST) // 1000), None))
    assert not any(handle.maps[m] for m in ("points", "totals", "chunks")) and len(handle.maps["last"]) == 7


def test_a_customer_costs_few_calls_of_the_store_however_many_hours():
    handle, state = _SlotHandle(), SB.CustomerState()
    state.init(handle)
    for day in range(0, 20, 5):
        rows = [(f"c{i}", (day * 24 + 3 * k) * B.HOUR + i, 1) for i in range(10) for k in range(40)]
        list(state.handleInputRows((0,), iter([_slot_points(rows)]), None))
    assert sum(m.calls for m in handle.maps.values()) <= 10 * 4 * 2


def test_amounts_of_any_size_and_sign_add_up_exactly():
    amounts = [10 ** 37, -1, 0, -(10 ** 28) + 1, 2 ** 96, -(2 ** 64), 2 ** 32 - 1]
    words = SB._words(pd.Series([SB._decimal(a) for a in amounts] + [None]))
    assert SB._texts(words).tolist() == [SB._decimal(a) for a in [*amounts, 0]]
    sums = SB._joined(SB._before(SB._limbs(words)))
    assert SB._texts(sums).tolist() == [SB._decimal(sum(amounts[:k])) for k in range(len(amounts) + 1)] + [SB._decimal(sum(amounts))]


def test_customers_that_come_late_or_again_equal_batch(spark, tmp_path):
    """Parts of a month each, so that the store has let go of a customer's points when new ones come."""
    i = F.col("id")
    at = 1_700_000_000 + i * 8_000
    rows = spark.range(1200).select(
        i.cast("string").alias("transaction_id"), F.timestamp_seconds(at).alias("timestamp"), (i % 7 - 2.5).alias("amount"),
        F.when((i % 50 == 0) & ((i < 200) | (i > 900)), 1000).when((i % 50 == 1) & (i > 700), 2000).otherwise(i % 9).alias("customer_id"))
    number = F.col("transaction_id").cast("int")
    told = SB.HistoryTable(spark, str(tmp_path / "told"))
    with timer_store(spark):
        for k in range(3):
            rows.filter(F.floor(number / 400) == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{k}"))
            feed = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
            out = SB.history_stream(feed, slots=2).writeStream.outputMode("append").foreachBatch(told.on_batch)
            SR.run_available(out, "behaviour", checkpoint=str(tmp_path / "offsets"))
    past = number < 1199
    got = {r.transaction_id: str(r) for r in told.attach(rows).filter(past).collect()}
    assert got == {r.transaction_id: str(r) for r in B.behaviour(rows).filter(past).collect()} and len(got) == 1199
