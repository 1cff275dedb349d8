"""Small transaction tables built from a rule; no random state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S

START = dt.datetime(2026, 1, 1)


def raw_transactions(spark, n=100):
    """All raw columns; 3% positives, every third customer value missing nowhere."""
    rows = []
    for i in range(n):
        ts = START + dt.timedelta(minutes=15 * i)
        rows.append((
            f"txn-{i:06d}", ts, ts.hour, int(ts.weekday() >= 5), f"CUST_{i * 7 % 50:05d}", 400000 + i,
            ("CREDIT", "DEBIT")[i % 2], ("PLATINUM", "SPARK", "EVERYDAY")[i % 3], 1 + i * 29 % 2999,
            1000.0 + (i * 7919 % 5000) * 100, "VND", ("WinMart", "Shopee", "Grab")[i % 3], 4000 + i * 13 % 4999,
            ("Groceries", "Electronics", "Travel")[i % 3], ("Ha Noi", "Da Nang")[i % 2], ("VN", "US", "SG")[i % 3],
            ("Mobile", "Desktop", "POS")[i % 3], ("Android", "iOS", "Windows", None)[i % 4], ("VN", "US")[i % 2],
            float(i * 37 % 200), ("Y", "N", "N/A", "Y", "Y")[i % 5], ("Y", "Y", "N", "N/A")[i % 4],
            "DECLINED" if i % 10 == 0 else "APPROVED", i % 9 + 1, i % 59 + 1, float(i * 31 % 2000),
            2e6 + i, (i % 500) / 100, i % 2, i % 3 % 2, ("PRIVATE", "PRIORITY", "INSPIRE", "MASS")[i % 4],
            int(i % 33 == 1)))
    return spark.createDataFrame(rows, S.TRANSACTION_SCHEMA)


def numbers(spark, values, column="v", kind=T.DoubleType()):
    schema = T.StructType([T.StructField(column, kind)])
    return spark.createDataFrame([(v,) for v in values], schema)


def lopsided(spark, n=3000):
    """Events where one customer holds a third of all rows, a third of these at one instant."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(n).select(
        i.cast("string").alias("transaction_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), (i % 40).cast("string"))).alias("customer_id"),
        F.timestamp_seconds(F.when(i % 9 == 0, 1_700_000_000).otherwise(1_700_000_000 + (i * 7919) % 4_000_000)).alias("timestamp"),
        ((i * 37) % 1000 / 100).alias("amount"),
        F.concat(F.lit("d"), (i % 4).cast("string")).alias("device_type"))
