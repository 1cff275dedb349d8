import datetime as dt
import math

import pytest
from data import START, lopsided, raw_transactions
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import scalars as X
from riskweave.operators import behaviour as B
from riskweave.operators import clean as C
from riskweave.operators import features as FX
from riskweave.operators import quality as Q
from riskweave.operators import split as SP
from riskweave.plans import prepare as P
from riskweave.sources import tables as TB


def _one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("value,want", [("Y", 1), ("N", 0), ("N/A", 0), ("y", 0), (None, 0)])
def test_flag(spark, value, want):
    assert _one(spark, value, "string", X.flag) == want


@pytest.mark.parametrize("value,want", [(0.0, "LOW"), (0.29, "LOW"), (0.30, "MEDIUM"), (0.59, "MEDIUM"), (0.6, "HIGH"), (1.0, "HIGH"), (None, None)])
def test_risk_band(spark, value, want):
    assert _one(spark, value, "double", X.risk_band) == want


@pytest.mark.parametrize("value,want", [(-5.0, 0.0), (0.0, 0.0), (math.e - 1, 1.0), (None, None)])
def test_amount_log(spark, value, want):
    got = _one(spark, value, "double", X.amount_log)
    assert got is None if want is None else got == pytest.approx(want)


@pytest.mark.parametrize("hour,want", [(23, 1), (0, 1), (5, 1), (6, 0), (22, 0), (None, 0)])
def test_night(spark, hour, want):
    assert _one(spark, hour, "int", X.is_night) == want


def test_parsing_bad_texts_gives_null(spark):
    assert _one(spark, "2026-03-14T10:23:00", "string", X.parse_timestamp) == dt.datetime(2026, 3, 14, 10, 23)
    assert _one(spark, "soon", "string", X.parse_timestamp) is None
    assert _one(spark, "1e3", "string", X.parse_double) == 1000.0
    assert _one(spark, "x", "string", lambda c: X.parse_double(c, 0.0)) == 0.0
    assert _one(spark, float("nan"), "double", X.finite_or_null) is None
    assert _one(spark, float("-inf"), "double", X.finite_or_null) is None


@pytest.mark.parametrize("value,want", [(80.0, 0.8), (0.8, 0.8), (1.0, 1.0)])
def test_as_fraction(spark, value, want):
    assert _one(spark, value, "double", X.as_fraction) == want


def test_label_matching_is_whole_text(spark):
    df = spark.createDataFrame([("500",), ("5000",), (None,)], "s string")
    assert [r[0] for r in df.select(X.label_matches("s", "5..")).collect()] == [True, False, False]
    assert _one(spark, "/docker/0123456789abcdef", "string", lambda c: X.relabel(c, "/docker/([0-9a-f]{12}).*")) == "0123456789ab"


@pytest.mark.parametrize("percent,low,high", [(-5, 0, 0), (0, 0, 0), (25, 200, 300), (100, 1000, 1000), (140, 1000, 1000)])
def test_traffic_split_share(spark, percent, low, high):
    n = spark.range(1000).filter(X.hashed_slot("id", percent) == "candidate").count()
    assert low <= n <= high


def test_csv_round_trip_and_missing_texts(spark, tmp_path):
    raw = raw_transactions(spark)
    TB.write_transactions_csv(raw, str(tmp_path / "a"))
    back = TB.read_transactions_csv(spark, str(tmp_path / "a"))
    assert dict(back.dtypes) == dict(raw.dtypes)
    assert back.count() == 100
    (tmp_path / "b.csv").write_text(
        "transaction_id,timestamp,customer_id,amount,customer_tier,is_fraud\n"
        "t1,2026-01-01 10:00:00,NULL,12.5,MASS,0\nt2,not a time,c1,abc,N/A,1\nt3,2026-01-01,c2,NaN,None,\n")
    rows = TB.read_transactions_csv(spark, str(tmp_path / "b.csv")).orderBy("transaction_id").collect()
    assert [r["customer_id"] for r in rows] == [None, "c1", "c2"]
    assert [r["amount"] for r in rows] == [12.5, None, None]
    assert [r["customer_tier"] for r in rows] == ["MASS", None, None]
    assert rows[1]["timestamp"] is None and rows[2]["is_fraud"] is None


def test_validation_collects_every_fault(spark):
    raw = raw_transactions(spark)
    assert Q.validate(raw).count() == 100
    bad = raw.withColumn("amount", F.when(F.col("transaction_id") == "txn-000003", -1.0).otherwise(F.col("amount"))) \
        .withColumn("is_fraud", F.when(F.col("transaction_id") == "txn-000004", 99).otherwise(F.col("is_fraud"))) \
        .withColumn("customer_id", F.when(F.col("transaction_id") != "txn-000005", F.col("customer_id")))
    bad = bad.unionByName(bad.limit(5))
    report = {(r["rule"], r["column"]): r["violations"] for r in Q.validation_report(bad).collect()}
    assert report[("unique", "transaction_id")] == 5
    with pytest.raises(ValueError) as e:
        Q.validate(bad)
    for text in ("unique", "not_negative", "binary", "customer_id", "99"):
        assert text in str(e.value)
    with pytest.raises(ValueError, match="missing column is_fraud"):
        Q.validate(raw.drop("is_fraud"))
    with pytest.raises(ValueError, match="not a time"):
        Q.validate(raw.withColumn("timestamp", F.col("timestamp").cast("string")))


def test_repeated_null_keys_count_as_repeats(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("a",)], "k string")
    assert Q.duplicate_rows(df, "k").first()[0] == 2


def test_request_rules(spark):
    good = dict(transaction_id="TX", timestamp="2026-03-14 10:23:00", customer_id="C", amount=350000.0,
                customer_tier="priority", hour_of_day=10, is_weekend=0, is_new_device=0, account_age_days=730)
    changes = [{}, {"amount": 0.0}, {"customer_tier": "GOLD"}, {"timestamp": "x"}, {"hour_of_day": 24},
               {"account_age_days": -1}, {"customer_id": None}]
    schema = ("transaction_id string, timestamp string, customer_id string, amount double, customer_tier string, "
              "hour_of_day int, is_weekend int, is_new_device int, account_age_days int")
    names = [p.split()[0] for p in schema.split(", ")]
    df = spark.createDataFrame([tuple({**good, **c}[n] for n in names) for c in changes], schema)
    errors = [r["errors"] for r in Q.with_errors(df).collect()]
    assert errors == [[], ["amount:positive"], ["customer_tier:domain"], ["timestamp:format"],
                      ["hour_of_day:range"], ["account_age_days:not_negative"], ["customer_id:required"]]
    valid, bad = Q.split_valid(df)
    assert valid.first()["customer_tier"] == "PRIORITY" and bad.count() == 6
    with pytest.raises(ValueError):
        Q.require_rows(df.filter("false"))


def test_clean_encodes_imputes_and_keeps_first(spark):
    raw = raw_transactions(spark)
    late = raw.limit(5).withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 day")).withColumn("amount", F.lit(-7.0))
    out = C.clean(raw.unionByName(late))
    assert out.count() == 100 and out.filter("amount < 0").count() == 0
    assert out.filter("os is null").count() == 0
    assert {r[0] for r in out.select("cvv_match").distinct().collect()} == {0, 1}
    assert dict(out.dtypes)["transaction_status"] == "int"
    again = C.encode_flags(out)
    assert again.filter("cvv_match = 1").count() == out.filter("cvv_match = 1").count()


@pytest.mark.parametrize("ratio", [0.0, 1.0, 1.5])
def test_split_ratio_must_be_inside(spark, ratio):
    with pytest.raises(ValueError):
        SP.chrono_split(raw_transactions(spark), ratio)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_split_with_ties_and_missing_times(spark, parts):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 50 != 0, F.timestamp_seconds(F.col("id") % 3 * 86400)).alias("timestamp")).repartition(parts)
    for ratio in (0.2, 0.5, 0.979, 0.985):
        train, test = SP.chrono_split(df, ratio)
        cut = int(1000 * ratio)
        rows = sorted(df.collect(), key=lambda r: (r[1] is None, r[1] or START, r[0]))
        assert {r[0] for r in train.collect()} == {r[0] for r in rows[:cut]}
        assert {r[0] for r in test.collect()} == {r[0] for r in rows[cut:]}


def test_state_comes_from_train_only(spark):
    raw = C.clean(raw_transactions(spark))
    train, test = SP.chrono_split(raw)
    a, b = FX.FeatureState.fit(train), FX.FeatureState.fit(train)
    assert a.maps() == b.maps() and a.median == b.median
    assert a.maps()["customer_tier"] == {"INSPIRE": 0, "MASS": 1, "PRIORITY": 2, "PRIVATE": 3}
    out = a.transform(test)
    assert not {"customer_tier", "merchant_name", "merchant_city", "hour_of_day"} & set(out.columns)
    assert out.filter("card_type < 0").count() == 0
    bare = out.select([c for c in out.columns if c not in S.NON_FEATURE_COLUMNS])
    assert Q.null_counts(bare).count() == 0
    stranger = test.limit(1).withColumns({"customer_id": F.lit("NEW"), "customer_tier": F.lit("OTHER"), "os": F.lit("BeOS")})
    row = a.transform(stranger).first()
    assert (row["customer_tx_count"], row["customer_avg_amount"], row["segment_encoded"], row["os"]) == (0, a.median, -1, -1)


def test_transform_edge_cases(spark):
    state = FX.FeatureState.fit(C.clean(raw_transactions(spark)))
    request = raw_transactions(spark, 1).drop("is_fraud").withColumns({
        "timestamp": F.lit("2026-03-14T23:10:00"), "amount": F.lit("oops")})
    row = state.transform(request.drop("hour_of_day")).first()
    assert (row["transaction_hour"], row["transaction_day_of_week"], row["is_night_transaction"]) == (23, 5, 1)
    assert row["amount"] == 0.0 and row["cvv_match"] == 1
    assert state.transform(request).first()["transaction_hour"] == 0
    lonely = state.transform(request.drop("customer_id")).first()
    assert (lonely["customer_tx_count"], lonely["customer_avg_amount"]) == (0, state.median)
    with pytest.raises(KeyError):
        state.transform(request.drop("timestamp"))


def test_big_code_maps_use_a_join(spark, monkeypatch):
    raw = C.clean(raw_transactions(spark))
    small = FX.FeatureState.fit(raw).transform(raw)
    monkeypatch.setattr(FX, "MAP_LIMIT", 1)
    big = FX.FeatureState.fit(raw).transform(raw).select(small.columns)
    assert sorted(map(str, big.collect())) == sorted(map(str, small.collect()))


def test_hot_customers_do_not_change_the_features(spark):
    df = lopsided(spark).withColumns({"customer_tier": F.lit("MASS"), "is_fraud": F.lit(0)})
    plain = FX.FeatureState.fit(df)
    salted = FX.FeatureState.fit(df, hot_rows=50)
    assert not plain.hot and salted.hot
    want = plain.transform(df)
    got = salted.transform(df).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_state_and_codes_survive_files(spark, tmp_path):
    state = FX.FeatureState.fit(C.clean(raw_transactions(spark)))
    state.save(str(tmp_path))
    back = FX.FeatureState.load(spark, str(tmp_path))
    assert back.maps() == state.maps() and back.median == state.median
    (tmp_path / "t.json").write_text('{"VISA_TIER": 3, "MASS": 1}')
    (tmp_path / "c.json").write_text('{"card_type": {"VISA": 2, "MASTERCARD": 3}}')
    codes = FX.codes_from_json(spark, str(tmp_path / "t.json"), str(tmp_path / "c.json")).collect()
    assert ("card_type", "MASTERCARD", 3) in [tuple(r) for r in codes]
    assert ("customer_tier", "VISA_TIER", 3) in [tuple(r) for r in codes]


def test_projection_and_alignment(spark):
    df = raw_transactions(spark, 3)
    with pytest.raises(ValueError, match="nowhere"):
        FX.project_features(df, ["amount", "nowhere"])
    out = FX.align_features(df, ["card_bin", "nowhere", "card_type"])
    assert out.columns == ["card_bin", "nowhere", "card_type"]
    assert tuple(out.first()) == (400000.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        FX.with_class_weight(df.withColumn("is_fraud", F.lit(0)))


def test_end_to_end_files(spark, tmp_path):
    done = P.run_preparation(raw_transactions(spark), str(tmp_path))
    train, test = TB.read_split(spark, str(tmp_path))
    assert (train.count(), test.count()) == (80, 20)
    assert train.agg(F.max("timestamp")).first()[0] <= test.agg(F.min("timestamp")).first()[0]
    listed = TB.read_feature_list(spark, str(tmp_path)).first()
    assert listed["features"] == done.features and listed["feature_count"] == len(done.features)
    assert set(S.MODEL_FEATURES) <= set(done.features)


def _brute_behaviour(rows):
    out = {}
    for r in rows:
        mine = [o for o in rows if o["customer_id"] == r["customer_id"]]
        at = r["timestamp"]
        key = lambda o: (o["timestamp"], o["transaction_id"])
        before = sorted((o for o in mine if key(o) < key(r)), key=key)
        month = [o["amount"] for o in mine if at - dt.timedelta(days=30) <= o["timestamp"] < at]
        avg = sum(month) / len(month) if month else None
        out[r["transaction_id"]] = (
            sum(at - dt.timedelta(hours=1) <= o["timestamp"] <= at for o in mine),
            sum(at - dt.timedelta(hours=24) <= o["timestamp"] <= at for o in mine),
            (at - before[-1]["timestamp"]).total_seconds() / 60 if before else None, avg)
    return out


@pytest.mark.parametrize("rows_per_bucket,hot_rows", [(10**6, 10**6), (100, 40)])
def test_behaviour_of_a_lopsided_table(spark, rows_per_bucket, hot_rows):
    df = lopsided(spark, 900).repartition(5)
    got = B.behaviour(df, rows_per_bucket, hot_rows).collect()
    want = _brute_behaviour(df.collect())
    assert len(got) == 900
    for r in got:
        n1, n24, gap, avg = want[r["transaction_id"]]
        assert (r["tx_count_last_1h"], r["tx_count_last_24h"]) == (n1, n24)
        assert r["time_since_last_tx_min"] == (None if gap is None else pytest.approx(gap))
        assert r["avg_amount_last_30d"] == (None if avg is None else pytest.approx(avg))


def test_first_seen_with_hot_pairs(spark):
    df = lopsided(spark, 900)
    w = Window.partitionBy("customer_id", "device_type").orderBy("timestamp", "transaction_id")
    want = {r[0] for r in df.withColumn("n", F.row_number().over(w)).filter("n = 1").select("transaction_id").collect()}
    got = B.first_seen(df, "device_type", "is_new_device", hot_rows=20)
    assert got.count() == 900
    assert {r["transaction_id"] for r in got.filter("is_new_device = 1").collect()} == want
