"""Alert rules on a stream against the batch rules on the rows the watermark has passed."""

import pytest
from pyspark.sql import functions as F

from riskweave.operators import alerts as AL
from riskweave.operators import metrics as M
from riskweave.streaming import requests as SR
from riskweave.streaming import state_alerts as SA

START = 1_767_225_600
RULE = AL.Rule("R", "warning", "5 minutes", "4 minutes")


def _log(spark, n=1500):
    """Spells of faults per path; one path stops for a while, one label and some times are missing."""
    i = F.col("id")
    path = F.when(i % 3 == 2, F.lit(None)).otherwise((i % 3).cast("string"))
    rows = spark.range(n).select(
        F.when(i % 97 != 0, F.timestamp_seconds(START + i * 7)).alias("ts"), path.alias("path"),
        F.when((i / 200).cast("int") % 2 == 1, i % 2).otherwise(0).alias("bad"), i)
    return rows.filter("path is null or path = '0' or id not between 400 and 900")


def _write(df, folder):
    df.coalesce(1).write.parquet(str(folder))


def _want(log, absent, late, start=None):
    """Batch: ranges up to the watermark on a grid from the first evaluation on."""
    reached = F.timestamp_seconds(F.lit(log.agg(F.max(F.unix_seconds("ts"))).first()[0] - late))
    steps = M.per_step(log.filter("ts is not null"), "ts", ["path"], [F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")])
    ranges = M.over_range(steps, ["path"], ["n", "bad"], RULE.width).filter(F.col("at_time") <= reached)
    grid = AL.evaluation_grid(ranges, "at_time", "1 minute", ranges.select("path"))
    cond = F.lit(False) if absent else F.col("bad") / F.col("n") > 0.05
    out = AL.firing(AL.on_grid(grid, ranges, cond, absent), "at_time", ["path"], RULE)
    return sorted(map(str, out.select("path", "pending_from", "firing_from", "firing_to").collect()))


@pytest.mark.parametrize("absent", [False, True])
def test_stream_equals_batch_in_any_order_and_after_restarts(spark, tmp_path, absent):
    log = _log(spark)
    # rows move up to 20 minutes; the end of the log stays the newest row of the last part
    moved = F.col("id") + F.pmod(F.xxhash64("id"), F.lit(170))
    parts = log.withColumn("part", F.least((moved / 400).cast("int"), F.lit(3)))
    rows, offsets, told = tmp_path / "rows", str(tmp_path / "offsets"), SA.AlertTable(spark, str(tmp_path / "told"))

    def met(sums):
        return not absent and sums["bad"] / sums["n"] > 0.05

    with SA.timer_store(spark):
        for k in range(4):
            _write(parts.filter(F.col("part") == k).drop("part", "id"), rows / f"p{k}")
            feed = spark.readStream.schema(log.drop("id").schema).option("recursiveFileLookup", True).parquet(str(rows))
            out = SA.alert_stream(feed, "ts", ["path"], [F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")], met,
                                  RULE, late="25 minutes", absent=absent, start=START * 1000)
            SR.run_available(out.writeStream.outputMode("append").foreachBatch(told.on_batch), "alerts", checkpoint=offsets)
    got = told.fired(["path"])
    assert sorted(map(str, got.select("path", "pending_from", "firing_from", "firing_to").collect())) == _want(log, absent, 1500)
    assert got.count() > (0 if absent else 3)
    changes = told.changes()
    ended = changes.filter("state = 'resolved'")
    assert ended.filter("at_time <= firing_to or firing_to < firing_from").isEmpty()
    assert changes.groupBy("path", "pending_from").agg(F.count_if(F.col("state") == "pending").alias("n")).filter("n <> 1").isEmpty()


def test_an_empty_stream_tells_nothing_and_the_store_is_named(spark, tmp_path):
    log = _log(spark, 10).drop("id")
    _write(log.limit(0), tmp_path / "rows")
    feed = spark.readStream.schema(log.schema).parquet(str(tmp_path / "rows"))
    told = SA.AlertTable(spark, str(tmp_path / "told"))
    aggs = [F.count(F.lit(1)).alias("n")]
    with pytest.raises(RuntimeError, match="providerClass"):
        SA.alert_stream(feed, "ts", ["path"], aggs, lambda sums: True, RULE)
    before = spark.conf.get(SA.STORE_KEY)
    with SA.timer_store(spark):
        out = SA.alert_stream(feed, "ts", ["path"], aggs, lambda sums: True, RULE)
        SR.run_available(out.writeStream.outputMode("append").foreachBatch(told.on_batch), "none")
    changes = told.changes()
    assert changes is None or changes.isEmpty()
    assert spark.conf.get(SA.STORE_KEY) == before
