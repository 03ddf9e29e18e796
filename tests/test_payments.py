import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import fees
from tessera.functions.timeparts import parse_iso_timestamp
from tessera.operators import payments as pay
from tessera.operators import quality


def test_fee_models_edges(spark):
    amounts = [299_999, 300_000, 1_000_000, 1_000_001, 1_500_000, 1_500_001]
    df = spark.createDataFrame([(a,) for a in amounts], "amount BIGINT")
    got = {r["amount"]: r for r in df.select(
        "amount", fees.flat_commission("amount").alias("flat"), fees.progressive_commission("amount").alias("prog"),
        fees.tiered_commission("amount").alias("tier")).collect()}
    assert got[1_000_000]["prog"] == pytest.approx(15_000.0)
    assert got[1_000_001]["prog"] == pytest.approx(30_000.03)
    assert got[1_500_000]["tier"] == pytest.approx(30_000.0)
    assert got[1_500_001]["tier"] == pytest.approx(1_500_001 * 0.025)
    assert got[299_999]["flat"] == pytest.approx(5_999.98)


def test_recommendation_and_simulated_fee(spark):
    rows = [(299_999, "retail", "individual"), (300_000, "retail", "individual"), (1_500_000, "retail", "business"),
            (2_000_000, "retail", "CIP"), (1_000_001, "government", "individual"), (1_000_000, "government", "individual")]
    df = spark.createDataFrame(rows, "amount BIGINT, merchant_category STRING, customer_type STRING")
    x = df.withColumn("t", fees.recommend_commission("amount", "merchant_category", "customer_type")) \
          .withColumn("fee", fees.simulate_fee("amount", "t")).collect()
    assert [r["t"] for r in x] == ["flat", "progressive", "tiered", "flat", "tiered", "progressive"]
    assert x[0]["fee"] == 20_000.0
    assert x[1]["fee"] == pytest.approx(6_000.0)
    assert x[2]["fee"] == pytest.approx(15_000 + 500_000 * 0.01)


def test_day_parts_and_segments(spark):
    df = spark.createDataFrame([(h,) for h in (4, 5, 11, 12, 17, 18, 23, 0)], "h INT")
    parts = [r[0] for r in df.select(fees.day_part("h")).collect()]
    assert parts == ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night"]
    seg = spark.createDataFrame([(20, 1), (19, 22_000_001), (19, 22_000_000)], "n INT, t BIGINT")
    assert [r[0] for r in seg.select(fees.customer_segment("n", "t")).collect()] == ["power_user", "big_spender", "regular"]


def test_out_of_hours_wraps_midnight(spark):
    rows = [("food_service", 0), ("food_service", 1), ("food_service", 2), ("food_service", 7),
            ("unknown", 8), ("unknown", 20), ("transportation", 23)]
    df = spark.createDataFrame([(c, dt.datetime(2024, 1, 1, h, 30)) for c, h in rows], "merchant_category STRING, ts TIMESTAMP")
    flags = [r["out_of_hours"] for r in pay.out_of_hours(df).collect()]
    assert flags == [False, True, True, False, False, True, False]


def test_validation_codes(spark):
    now = "2024-01-30 00:00:00"
    base = dict(amount=100, vat_amount=9, commission_amount=2, total_amount=111, payment_method="pos", device_os=None)
    def row(ts, **kw):
        r = dict(base, **kw)
        return (r["amount"], r["vat_amount"], r["commission_amount"], r["total_amount"], r["payment_method"],
                r["device_os"], ts)
    rows = [
        row(dt.datetime(2024, 1, 29, 12)),                                   # valid
        row(dt.datetime(2024, 1, 29, 12), total_amount=112),                 # total off by one
        row(dt.datetime(2024, 1, 30, 0, 0, 1)),                              # future
        row(dt.datetime(2024, 1, 29, 0, 0, 0)),                              # exactly 86 400 s old
        row(dt.datetime(2024, 1, 28, 23, 59, 59)),                           # 86 401 s old
        row(dt.datetime(2024, 1, 29, 12), payment_method="mobile", device_os="Windows"),
        row(dt.datetime(2024, 1, 29, 12), payment_method="mobile", device_os=None),
        row(dt.datetime(2024, 1, 1), payment_method="mobile", device_os="iOS", total_amount=1),
    ]
    df = spark.createDataFrame(rows, "amount BIGINT, vat_amount BIGINT, commission_amount BIGINT, total_amount BIGINT, "
                                     "payment_method STRING, device_os STRING, ts TIMESTAMP")
    errs = [r["errors"] for r in quality.validation_errors(df, now).collect()]
    assert errs == [[], ["ERR_AMOUNT"], ["ERR_TIME"], [], ["ERR_TIME"], ["ERR_DEVICE"], ["ERR_DEVICE"],
                    ["ERR_AMOUNT", "ERR_TIME"]]
    valid, dead = quality.route_dead_letter(quality.validation_errors(df, now).withColumn("transaction_id", F.lit(1)))
    assert valid.count() == 2 and dead.count() == 6
    assert set(dead.columns) == {"transaction_id", "errors", "original_data"}


def test_iso_timestamp_parse(spark):
    df = spark.createDataFrame([("2024-01-29T12:00:00.123456Z",), ("2024-01-29T12:00:00Z",), ("garbage",)], "s STRING")
    got = [r[0] for r in df.select(parse_iso_timestamp("s")).collect()]
    assert got[0] == dt.datetime(2024, 1, 29, 12, 0, 0, 123456)
    assert got[1] == dt.datetime(2024, 1, 29, 12)
    assert got[2] is None


def test_parse_transaction_requires_fields(spark):
    good = ('{"transaction_id":"t1","timestamp":"2024-01-29T12:00:00.5Z","customer_id":"c","merchant_id":"m",'
            '"merchant_category":"retail","payment_method":"pos","amount":100,"location":{"lat":1,"lng":2},'
            '"status":"approved","commission_type":"flat","commission_amount":2,"vat_amount":9,'
            '"total_amount":111,"customer_type":"CIP","risk_level":1}')
    missing = good.replace('"customer_id":"c",', "")
    bad_amount = good.replace('"amount":100', '"amount":"x1"')
    df = spark.createDataFrame([(good,), (missing,), (bad_amount,)], "value STRING")
    ok = [r["parse_ok"] for r in quality.parse_transactions(df).collect()]
    assert ok == [True, False, False]
