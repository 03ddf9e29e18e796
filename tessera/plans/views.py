"""Derived views: the reference's domain tables expressed over the test tables.

Each view is a pure projection of a driver table (no made-up rows), so its
size grows with the data.  ``*_SQL`` strings are the same derivations in
DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import load_table

# ---- fixed derivation rules of the payments view ----------------------------
PAYMENT_METHODS = ("online", "pos", "mobile", "nfc")          # by event_id mod 4
CUSTOMER_TYPES = ("individual", "CIP", "business")            # by user_id mod 3
COMMISSION_TYPES = ("flat", "progressive", "tiered")          # by event_id mod 3
DEVICE_OS = ("Android", "iOS", "Windows")                     # by event_id div 4 mod 3
CATEGORY_OF_EVENT = (("click", "retail"), ("view", "food_service"), ("purchase", "entertainment"),
                     ("signup", "transportation"), ("error", "government"))
AMOUNT_SCALE = 200      # amount = round(value*100) * 200, an integer like the source
COMMISSION_PCT = 2      # commission = 2 % of amount
VAT_PCT = 9             # vat = 9 % of amount
# Rows that make the alert and validation rules fire, picked by id:
BURST_START = "2024-01-01 00:00:00"
BURST_LEN, BURST_EVERY = 8, 12   # every 12th block of 8 ids is one customer at one merchant, 10 s apart
LARGE_EVERY, LARGE_FACTOR = 101, 40   # every 101st amount is 40 times as large
BROKEN_EVERY, BROKEN_BY = 83, 1000    # every 83rd total does not add up
# -----------------------------------------------------------------------------


def _pick(values, idx_col):
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx_col == i, v) if expr is None else expr.when(idx_col == i, v)
    return expr


def _category(c):
    expr = None
    for ev, cat in CATEGORY_OF_EVENT:
        expr = F.when(c == ev, cat) if expr is None else expr.when(c == ev, cat)
    return expr.otherwise(c)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions view over the ``events`` table."""
    return payments_from(load_table(spark, sf_dir, "events"))


def payments_from(ev: DataFrame) -> DataFrame:
    """Transactions view over an events frame, batch or streaming (PRJ1: ``props`` parsed by schema)."""
    eid = F.col("event_id")
    block = F.floor(eid / BURST_LEN)
    burst = F.pmod(block, F.lit(BURST_EVERY)) == 0
    uid = F.when(burst, F.pmod(block * 31, F.lit(150))).otherwise(F.col("user_id"))
    minutes, seconds = F.pmod(block * 7919, F.lit(41_760)), F.pmod(eid, F.lit(BURST_LEN)) * 10
    burst_ts = F.lit(BURST_START).cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"), secs=seconds.cast("decimal(18,6)"))
    large = F.when(F.pmod(eid, F.lit(LARGE_EVERY)) == 0, F.lit(LARGE_FACTOR)).otherwise(F.lit(1))
    amount = F.round(F.col("value") * 100).cast("bigint") * AMOUNT_SCALE * large
    method = _pick(PAYMENT_METHODS, F.pmod(eid, F.lit(4)))
    props = F.from_json("props", "k INT")
    ts_type = ev.schema["ts"].dataType
    df = ev.select(
        eid.alias("transaction_id"),
        F.when(burst, burst_ts).otherwise(F.col("ts").cast("timestamp_ntz")).cast(ts_type).alias("ts"),
        uid.alias("customer_id"),
        F.when(burst, F.pmod(block, F.lit(100)).cast("int")).otherwise(props["k"]).alias("merchant_id"),
        _category(F.col("event_type")).alias("merchant_category"),
        method.alias("payment_method"),
        amount.alias("amount"),
        _pick(CUSTOMER_TYPES, F.pmod(uid, F.lit(3))).alias("customer_type"),
        _pick(COMMISSION_TYPES, F.pmod(eid, F.lit(3))).alias("commission_type"),
        (F.pmod(eid, F.lit(5)) + 1).cast("int").alias("risk_level"),
        F.when(method.isin("mobile", "online"),
               _pick(DEVICE_OS, F.pmod(F.floor(eid / 4), F.lit(3)))).alias("device_os"),
    )
    df = (df.withColumn("commission_amount", F.col("amount") * COMMISSION_PCT / 100)
            .withColumn("commission_amount", F.col("commission_amount").cast("bigint"))
            .withColumn("vat_amount", (F.col("amount") * VAT_PCT / 100).cast("bigint"))
            .withColumn("total_amount", F.col("amount") + F.col("commission_amount") + F.col("vat_amount")
                        + F.when(F.pmod("transaction_id", F.lit(BROKEN_EVERY)) == 0, F.lit(BROKEN_BY)).otherwise(F.lit(0)))
            # no coordinates in the tables: a merchant's site is a fixed grid point from its id
            .withColumn("lat", F.lit(25.0) + F.pmod(F.col("merchant_id"), F.lit(10)) * 2.0)
            .withColumn("lng", F.lit(45.0) + F.floor(F.col("merchant_id") / 10) * 2.0))
    return df


PAYMENTS_SQL = """
ev AS (SELECT *, event_id // 8 AS block, (event_id // 8) % 12 = 0 AS burst FROM events),
payments AS (
  SELECT event_id AS transaction_id,
         CASE WHEN burst THEN TIMESTAMP '2024-01-01 00:00:00' + ((block * 7919) % 41760 * 60 + event_id % 8 * 10) * INTERVAL 1 SECOND
              ELSE ts END AS ts,
         CASE WHEN burst THEN (block * 31) % 150 ELSE user_id END AS customer_id,
         CASE WHEN burst THEN CAST(block % 100 AS INTEGER)
              ELSE CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS INTEGER) END AS merchant_id,
         CASE event_type WHEN 'click' THEN 'retail' WHEN 'view' THEN 'food_service'
              WHEN 'purchase' THEN 'entertainment' WHEN 'signup' THEN 'transportation'
              WHEN 'error' THEN 'government' ELSE event_type END AS merchant_category,
         CASE event_id % 4 WHEN 0 THEN 'online' WHEN 1 THEN 'pos' WHEN 2 THEN 'mobile' ELSE 'nfc' END AS payment_method,
         CAST(round(value * 100) AS BIGINT) * 200 * (CASE WHEN event_id % 101 = 0 THEN 40 ELSE 1 END) AS amount,
         CASE (CASE WHEN burst THEN (block * 31) % 150 ELSE user_id END) % 3
              WHEN 0 THEN 'individual' WHEN 1 THEN 'CIP' ELSE 'business' END AS customer_type,
         CASE event_id % 3 WHEN 0 THEN 'flat' WHEN 1 THEN 'progressive' ELSE 'tiered' END AS commission_type,
         CAST(event_id % 5 + 1 AS INTEGER) AS risk_level,
         CASE WHEN event_id % 4 IN (0, 2) THEN
           CASE (event_id // 4) % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Windows' END END AS device_os
  FROM ev
),
pay AS (
  SELECT *, amount * 2 // 100 AS commission_amount, amount * 9 // 100 AS vat_amount,
         amount + amount * 2 // 100 + amount * 9 // 100 + (CASE WHEN transaction_id % 83 = 0 THEN 1000 ELSE 0 END) AS total_amount,
         25.0 + (merchant_id % 10) * 2.0 AS lat, 45.0 + (merchant_id // 10) * 2.0 AS lng
  FROM payments
)
"""


def with_payments(sql_body: str) -> str:
    """Prefix a DuckDB query with the payments view CTEs (``pay``)."""
    return "WITH " + PAYMENTS_SQL.strip() + "\n" + sql_body


# ---- flights view: lineitem x orders with customer/supplier nations ---------
# origin = customer's nation, destination = supplier's nation, airline = supplier.
# Nations carry no coordinates; a fixed rule on the key places them:
#   lat = (key * 37) mod 140 - 70, lng = (key * 71) mod 340 - 170


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    o = load_table(spark, sf_dir, "orders")
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    f = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, o.o_custkey == c.c_custkey)
           .join(s, li.l_suppkey == s.s_suppkey))
    return f.select(
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("flight_id"),
        F.year("o_orderdate").alias("a_year"), F.month("o_orderdate").alias("a_month"),
        F.dayofmonth("o_orderdate").alias("a_day"),
        F.col("l_suppkey").alias("airline"),
        F.col("c_nationkey").alias("origin_airport"),
        F.col("s_nationkey").alias("destination_airport"),
        F.pmod(F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101, F.lit(2400)).cast("int").alias("scheduled_departure"),
        F.when(F.col("l_linestatus") != "O",
               F.datediff(F.col("l_shipdate"), F.col("o_orderdate")).cast("double")).alias("arrival_delay"),
        (F.col("l_quantity") * 10).alias("air_time"),
        (F.col("l_returnflag") == "R").cast("int").alias("cancelled"),
        F.when(F.col("l_returnflag") == "R", F.col("o_orderpriority")).alias("cancellation_reason"),
        F.col("l_extendedprice"), F.col("l_discount"), F.col("l_quantity"), F.col("l_partkey"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load_table(spark, sf_dir, "nation")
    return n.select("n_nationkey", "n_name",
                    (F.pmod(F.col("n_nationkey") * 37, F.lit(140)) - 70).cast("double").alias("latitude"),
                    (F.pmod(F.col("n_nationkey") * 71, F.lit(340)) - 170).cast("double").alias("longitude"))


FLIGHTS_SQL = """
flights AS (
  SELECT l_orderkey * 1000 + l_linenumber AS flight_id, year(o_orderdate) AS a_year, month(o_orderdate) AS a_month,
         day(o_orderdate) AS a_day, l_suppkey AS airline, c_nationkey AS origin_airport,
         s_nationkey AS destination_airport,
         CAST((l_orderkey * 37 + l_linenumber * 101) % 2400 AS INTEGER) AS scheduled_departure,
         CASE WHEN l_linestatus <> 'O' THEN CAST(datediff('day', o_orderdate, l_shipdate) AS DOUBLE) END AS arrival_delay,
         l_quantity * 10 AS air_time, CAST(l_returnflag = 'R' AS INTEGER) AS cancelled,
         CASE WHEN l_returnflag = 'R' THEN o_orderpriority END AS cancellation_reason,
         l_extendedprice, l_discount, l_quantity, l_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
),
airports AS (
  SELECT n_nationkey, n_name, CAST((n_nationkey * 37) % 140 - 70 AS DOUBLE) AS latitude,
         CAST((n_nationkey * 71) % 340 - 170 AS DOUBLE) AS longitude FROM nation
)
"""


def with_flights(sql_body: str) -> str:
    return "WITH " + FLIGHTS_SQL.strip() + "\n" + sql_body


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order series: one row per order date (bounded by the calendar)."""
    o = load_table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("d"))
             .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"),
                  F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low")))


DAILY_SQL = """
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders, sum(o_totalprice) AS total,
         max(o_totalprice) AS high, min(o_totalprice) AS low
  FROM orders GROUP BY 1
)
"""


def with_daily(sql_body: str) -> str:
    return "WITH " + DAILY_SQL.strip() + "\n" + sql_body
