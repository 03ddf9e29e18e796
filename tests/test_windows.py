import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import sequence, windows


def _events(n=400, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 5)     # key 0 is hot
        ts = t0 + dt.timedelta(seconds=rnd.randint(0, 4 * 3600))
        rows.append((i, key, ts, 25.0 + rnd.choice([0, 0.1, 2.0]), 45.0))
    # exact 300 s boundary and equal timestamps
    rows += [(n, 9, t0, 25.0, 45.0), (n + 1, 9, t0 + dt.timedelta(seconds=300), 25.0, 45.0),
             (n + 2, 9, t0 + dt.timedelta(seconds=300), 26.0, 45.0),
             # across a bucket edge (3600 s)
             (n + 3, 8, t0 + dt.timedelta(seconds=3599), 25.0, 45.0), (n + 4, 8, t0 + dt.timedelta(seconds=3601), 30.0, 45.0)]
    return rows


def test_rolling_time_count_matches_brute_force(spark):
    rows = _events()
    df = spark.createDataFrame(rows, "id LONG, k LONG, ts TIMESTAMP, lat DOUBLE, lng DOUBLE")
    got = {r["id"]: r["rolling_count"] for r in windows.rolling_time_count(df, "k", "ts", 300, 900).collect()}
    for i, k, ts, _, _ in rows:
        exp = sum(1 for _, k2, t2, _, _ in rows if k2 == k and ts - dt.timedelta(seconds=300) <= t2 <= ts)
        assert got[i] == exp, i


def test_geo_jumps_match_brute_force(spark):
    rows = _events()
    df = spark.createDataFrame(rows, "transaction_id LONG, customer_id LONG, ts TIMESTAMP, lat DOUBLE, lng DOUBLE")
    got = {(r["transaction_id"], r["prev_transaction_id"]) for r in windows.consecutive_geo_jumps(df, bucket_seconds=900).collect()}
    import math
    exp = set()
    by = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        by.setdefault(r[1], []).append(r)
    for seq in by.values():
        for a, b in zip(seq, seq[1:]):
            d = (b[2] - a[2]).total_seconds()
            p1, p2 = math.radians(a[3]), math.radians(b[3])
            h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[4] - a[4]) / 2) ** 2
            km = 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
            if d <= 300 and km > 50:
                exp.add((b[0], a[0]))
    assert got == exp and len(exp) > 0


def test_rolling_rows_mean_matches_pandas(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        k = 0 if i % 3 else rnd.randint(1, 4)
        d = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 200))
        v = None if rnd.random() < 0.1 else float(rnd.randint(-50, 50))
        rows.append((i, k, d, v))
    rows.append((1000, 77, dt.date(2020, 5, 5), 3.0))   # series shorter than the frame
    df = spark.createDataFrame(rows, "id LONG, k LONG, d DATE, v DOUBLE")
    got = {r["id"]: r["m"] for r in sequence.rolling_mean(
        df, "k", ["d", "id"], "v", 7, F.month("d"), "m").collect()}
    pdf = pd.DataFrame(rows, columns=["id", "k", "d", "v"]).sort_values(["k", "d", "id"])
    pdf["m"] = pdf.groupby("k")["v"].transform(lambda s: s.fillna(0).rolling(7, min_periods=1).mean())
    for _, r in pdf.iterrows():
        assert got[r["id"]] == pytest.approx(r["m"])
    lag = {r["id"]: r["m"] for r in sequence.rolling_mean(
        df, "k", ["d", "id"], "v", 7, F.month("d"), "m", exclude_current=True).collect()}
    pdf["lag"] = pdf.groupby("k")["v"].transform(lambda s: s.fillna(0).rolling(7, min_periods=1).mean().shift(1))
    for _, r in pdf.iterrows():
        if pd.isna(r["lag"]):
            assert lag[r["id"]] is None
        else:
            assert lag[r["id"]] == pytest.approx(r["lag"])


def test_dense_row_id_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).withColumn("x", (F.col("id") * 7919) % 1000)
    ids = sequence.dense_row_id(df, ["x", "id"]).orderBy("x", "id").collect()
    assert [r["row_id"] for r in ids] == list(range(1, 1001))


def test_spike_flags_columns(spark):
    rows = [(i, 1, dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(seconds=10 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "transaction_id LONG, merchant_id LONG, ts TIMESTAMP")
    out = windows.spike_flags(df).orderBy("transaction_id").collect()
    assert out[0]["rolling_count"] == 1 and out[0]["prev_hours_count"] == 0 and out[0]["baseline"] == 0.5
    assert out[-1]["hour_count"] == 20
