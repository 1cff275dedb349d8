import numpy as np
import pytest
from data import numbers
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import rank as R
from riskweave.operators.skew import hot_hashes, salted_left_join


def _windowed(df, by, descending):
    order = F.col("k").desc() if descending else F.col("k").asc()
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cum_n", F.sum("n").over(w))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("parts", [1, 5, 37])
def test_prefix_sums_do_not_depend_on_ranges_or_partitions(spark, descending, parts):
    df = spark.range(900).select((F.col("id") % 3 % 2).alias("g"), (F.col("id") * 0.5 - 100).alias("k"), (F.col("id") % 7).alias("n"))
    want = sorted(map(tuple, _windowed(df, ["g"], descending).collect()))
    got = R.prefix_sums(df.repartition(parts), ["g"], "k", ["n"], descending=descending, rows_per_bucket=40)
    assert sorted(map(tuple, got.collect())) == want


def test_prefix_sums_over_texts_and_without_groups(spark):
    df = spark.range(500).select(F.concat(F.lit("v'\\"), F.col("id").cast("string")).alias("k"), F.lit(1).alias("n"))
    got = R.prefix_sums(df, [], "k", ["n"], rows_per_bucket=20).orderBy("k").collect()
    assert [r["cum_n"] for r in got] == list(range(1, 501))


@pytest.mark.parametrize("edges", [[], [0.0], [float(i) for i in range(-3, 4)], [i / 10 for i in range(300)]])
def test_bucket_searches_agree(spark, edges):
    values = [-5.0, -0.0, 0.0, 0.05, 0.1, 1.0, 29.9, 1e9, float("inf"), float("-inf")]
    df = R.with_buckets(numbers(spark, values), {"v": edges}).withColumn("c", R.count_at_or_below("v", edges))
    for r in df.collect():
        assert r["_bucket_0"] == r["c"] == sum(e <= r["v"] for e in edges)


@pytest.mark.parametrize("values", [
    [float(i * 7919 % 1000) / 8 for i in range(1000)],
    [1.0] * 700 + [float(i) for i in range(300)],
    [3.0], [3.0, 4.0], [-0.0, 0.0, 1.0]])
def test_quantiles_equal_numpy(spark, values):
    fractions = [(i, 10) for i in range(11)] + [(99, 100), (1, 2)]
    n, got = R.exact_quantiles(numbers(spark, values).repartition(3), ["v"], fractions)["v"]
    assert n == len(values)
    np.testing.assert_allclose(got, np.quantile(values, [a / b for a, b in fractions]), rtol=1e-12)


def test_rough_sketch_still_gives_exact_ranks(spark):
    df = numbers(spark, [float(i * 7919 % 20000) for i in range(20000)]).repartition(6)
    rows, found = R.order_statistics(df, ["v"], [0.25, 0.9], lambda n: [5000, 18000], accuracy=20)
    assert rows == 20000
    assert {k: v[0] for k, v in found["v"][1].items()} == {5000: 5000.0, 18000: 18000.0}
    assert found["v"][1][5000][1] == 5000


def test_crowded_brackets_are_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "ROWS_PER_BUCKET", 500)
    monkeypatch.setitem(R.prefix_sums.__kwdefaults__, "rows_per_bucket", 500)
    df = numbers(spark, [float(i * 7919 % 20000) for i in range(20000)])
    _, found = R.order_statistics(df, ["v"], [0.25, 0.9], lambda n: [5000, 18000], accuracy=20)
    assert {k: v for k, v in found["v"][1].items()} == {5000: (5000.0, 5000), 18000: (18000.0, 18000)}


def test_several_columns_nulls_and_an_empty_one(spark):
    df = spark.range(101).select(
        F.col("id").cast("double").alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") * 2.0).alias("b"),
        F.lit(None).cast("double").alias("c"))
    rows, got = R.counted_quantiles(df, ["a", "b", "c"], [(1, 2)])
    assert rows == 101
    assert got == {"a": (101, [50.0]), "b": (51, [100.0]), "c": (0, [None])}


def test_whole_numbers_beyond_double_precision(spark):
    big = 2**60
    df = numbers(spark, [big + i for i in range(100)], kind=T.LongType())
    _, found = R.order_statistics(df, ["v"], [0.5], lambda n: [50])
    assert found["v"][1][50] == (big + 50, 50)


def test_kth_text_narrows_down(spark, monkeypatch):
    monkeypatch.setattr(R, "CUT_SAMPLE", 50)
    values = [f"id-{i:05d}" for i in range(2000)] + ["id-00500"] * 800
    df = numbers(spark, values, kind=T.StringType())
    for k in (0, 499, 500, 1300, 1301, 2799):
        assert R.kth_text(df, "v", k) == sorted(values)[k]
    with pytest.raises(IndexError):
        R.kth_text(df, "v", 2800)


@pytest.mark.parametrize("k", [3, 1500])
def test_top_per_group_with_a_hot_group_and_copies(spark, k):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("g"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 100).alias("v"))
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    want = df.withColumn("row_no", F.row_number().over(w)).filter(F.col("row_no") <= k)
    got = R.top_per_group(df.repartition(8), ["g"], [F.desc("v")], k)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_salted_join_keeps_every_row_once(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    copies = facts.unionByName(facts.filter("k = 'hot'"))
    per_key = facts.filter("id % 5 <> 1").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_hashes(per_key, ["k"], "n", share=10, min_rows=100)
    assert len(hot) == 1
    got = salted_left_join(copies, per_key, ["k"], hot, min_rows=100)
    want = copies.join(per_key, "k", "left")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
