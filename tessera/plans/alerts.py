"""Queries for windows, validation and the batch twins of the streaming metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality, windows
from tessera.plans.registry import REGISTRY, query
from tessera.plans.views import payments, with_payments
from tessera.sources.tables import cores, spread
from tessera.streaming import metrics as M

AS_OF = "2024-01-30 00:00:00"  # replaces the wall clock of the validation rule


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


VALIDATION_CTE = f""",
v AS (SELECT transaction_id,
        concat_ws(',',
          CASE WHEN total_amount <> amount + vat_amount + commission_amount THEN 'ERR_AMOUNT' END,
          CASE WHEN ts > TIMESTAMP '{AS_OF}' OR ts < TIMESTAMP '{AS_OF}' - INTERVAL 86400 SECOND THEN 'ERR_TIME' END,
          CASE WHEN payment_method = 'mobile' AND coalesce(device_os, '') NOT IN ('Android', 'iOS')
               THEN 'ERR_DEVICE' END) AS error_codes
      FROM pay)"""


@query("flt1_validation_dead_letter", covers="FLT1 SNK2 STR12", sql=with_payments(VALIDATION_CTE + """
SELECT transaction_id, error_codes, CAST(length(error_codes) - length(replace(error_codes, ',', '')) + 1 AS INTEGER)
       AS n_errors
FROM v WHERE error_codes <> ''"""))
def flt1(spark, sf):
    v = quality.validation_errors(payments(spark, sf), AS_OF)
    _valid, dead = quality.route_dead_letter(v)
    return dead.select("transaction_id", F.array_join("errors", ",").alias("error_codes"),
                       F.size("errors").alias("n_errors"))


@query("prj3_json_round_trip", covers="PRJ3 PRJ4 PRJ5 PRJ2 SRC1", sql=with_payments("""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, ts AS event_time, amount, lat, lng,
       total_amount, risk_level, device_os
FROM pay"""))
def prj3(spark, sf):
    p = spread(payments(spark, sf), cores(spark))
    msg = p.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("timestamp"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("merchant_id").cast("string").alias("merchant_id"),
        "merchant_category", "payment_method", "amount",
        F.struct("lat", "lng").alias("location"),
        F.when(F.col("device_os").isNotNull(), F.struct(F.col("device_os").alias("os"))).alias("device_info"),
        F.lit("approved").alias("status"), "commission_type", "commission_amount", "vat_amount",
        "total_amount", "customer_type", "risk_level")
    parsed = quality.parse_transactions(quality.to_json_value(msg))
    return (quality.keep_if(parsed, "parse_ok")
                  .select("transaction_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"),
                          "amount", "lat", "lng", "total_amount", "risk_level", "device_os"))


@query("win6_rolling_merchant_count", covers="WIN6", sql=with_payments("""
SELECT transaction_id, merchant_id,
       count(*) OVER (PARTITION BY merchant_id ORDER BY ts
                      RANGE BETWEEN INTERVAL 300 SECOND PRECEDING AND CURRENT ROW) AS rolling_count
FROM pay"""))
def win6(spark, sf):
    df = windows.rolling_time_count(payments(spark, sf), "merchant_id", "ts", 300)
    return df.select("transaction_id", "merchant_id", "rolling_count")


def _spike_sql(horizon: int) -> str:
    return with_payments(f""",
r AS (SELECT transaction_id, merchant_id, ts, date_trunc('hour', ts) AS hr,
        count(*) OVER (PARTITION BY merchant_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 300 SECOND PRECEDING AND CURRENT ROW) AS rolling_count,
        count(*) OVER (PARTITION BY merchant_id, date_trunc('hour', ts) ORDER BY ts, transaction_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hour_count
      FROM pay),
h AS (SELECT merchant_id, hr + i * INTERVAL 1 HOUR AS hr, sum(n) AS n
      FROM (SELECT merchant_id, date_trunc('hour', ts) AS hr, count(*) AS n FROM pay GROUP BY 1, 2), range(1, {horizon + 1}) t(i)
      GROUP BY 1, 2)
SELECT r.transaction_id, r.merchant_id, r.rolling_count, r.hour_count,
       CAST(coalesce(h.n, 0) AS BIGINT) AS prev_hours_count,
       round((r.hour_count + coalesce(h.n, 0)) / {horizon + 1}.0, 6) AS baseline,
       ((r.hour_count + coalesce(h.n, 0)) / {horizon + 1}.0 > 0
        AND r.rolling_count > 3 * (r.hour_count + coalesce(h.n, 0)) / {horizon + 1}.0) AS is_spike
FROM r LEFT JOIN h ON r.merchant_id = h.merchant_id AND r.hr = h.hr""")


# With the default horizon of one hour the rolling count can never exceed three
# times the baseline (the window lies in the two hours that the baseline
# averages): is_spike is false on every row by construction.
@query("win7_spike_detection", covers="WIN7 WIN6", sql=_spike_sql(1))
def win7(spark, sf):
    df = windows.spike_flags(payments(spark, sf))
    return df.select("transaction_id", "merchant_id", "rolling_count", "hour_count", "prev_hours_count",
                     _r("baseline"), "is_spike")


@query("win7_spike_three_hours", covers="WIN7 WIN6", sql=_spike_sql(3))
def win7h(spark, sf):
    df = windows.spike_flags(payments(spark, sf), horizon_hours=3)
    return df.select("transaction_id", "merchant_id", "rolling_count", "hour_count", "prev_hours_count",
                     _r("baseline"), "is_spike")


@query("win8_geo_consecutive_jumps", covers="WIN8 SCA14", sql=with_payments(""",
l AS (SELECT customer_id, transaction_id, ts, lat, lng,
        lag(transaction_id) OVER w AS prev_transaction_id, lag(ts) OVER w AS pts,
        lag(lat) OVER w AS plat, lag(lng) OVER w AS plng
      FROM pay WINDOW w AS (PARTITION BY customer_id ORDER BY ts, transaction_id)),
d AS (SELECT *, (epoch_us(ts) - epoch_us(pts)) / 1e6 AS seconds_apart,
        2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)) AS distance_km
      FROM (SELECT *, pow(sin(radians(lat - plat) / 2), 2)
                      + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lng - plng) / 2), 2) AS a
            FROM l WHERE prev_transaction_id IS NOT NULL))
SELECT customer_id, transaction_id, prev_transaction_id, round(seconds_apart, 6) AS seconds_apart,
       round(distance_km, 4) AS distance_km
FROM d WHERE seconds_apart <= 300 AND distance_km > 50"""))
def win8(spark, sf):
    df = windows.consecutive_geo_jumps(payments(spark, sf))
    return df.select("customer_id", "transaction_id", "prev_transaction_id", _r("seconds_apart"),
                     _r("distance_km", 4))


def _sliding_sql(size_s: int, slide_s: int, body_cols: str) -> str:
    n = size_s // slide_s
    return f""",
sw AS (SELECT make_timestamp((epoch_us(ts) // {slide_s * 1000000}) * {slide_s * 1000000}
                             - i * {slide_s * 1000000}) AS start_time, {body_cols}
       FROM pay, range(0, {n}) t(i))"""


@query("str1_sliding_category_commission_batch", covers="STR1 SET2", sql=with_payments(
    _sliding_sql(60, 20, "merchant_category, commission_amount") + """
SELECT start_time, start_time + INTERVAL 60 SECOND AS end_time, merchant_category,
       CAST(sum(commission_amount) AS BIGINT) AS total_commission, round(avg(commission_amount), 6) AS avg_commission
FROM sw GROUP BY 1, 2, 3"""))
def str1(spark, sf):
    df = M.sliding_category_commission(M.event_time(payments(spark, sf)))
    return df.select(F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                     F.col("end_time").cast("timestamp_ntz").alias("end_time"),
                     "merchant_category", "total_commission", _r("avg_commission"))


@query("str2_velocity_alerts_batch", covers="STR2 FLT4 STR9", sql=with_payments("""
SELECT customer_id, time_bucket(INTERVAL 2 MINUTE, ts, TIMESTAMP '1970-01-01') AS start_time,
       time_bucket(INTERVAL 2 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 2 MINUTE AS end_time,
       CAST(count(*) AS VARCHAR) AS detail, 'velocity' AS fraud_reason
FROM pay GROUP BY 1, 2, 3 HAVING count(*) > 5"""))
def str2(spark, sf):
    df = M.velocity_alerts(M.event_time(payments(spark, sf)), watermark=None)
    return df.select("customer_id", F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                     F.col("end_time").cast("timestamp_ntz").alias("end_time"), "detail", "fraud_reason")


@query("str3_geo_window_alerts_batch", covers="STR3 UDF3 WIN8", sql=with_payments(""",
b AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS start_time FROM pay),
l AS (SELECT customer_id, start_time, ts, lat, lng, lag(ts) OVER w AS pts, lag(lat) OVER w AS plat,
             lag(lng) OVER w AS plng
      FROM b WINDOW w AS (PARTITION BY customer_id, start_time ORDER BY ts, transaction_id)),
d AS (SELECT *, pow(sin(radians(lat - plat) / 2), 2)
                + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lng - plng) / 2), 2) AS a
      FROM l WHERE pts IS NOT NULL)
SELECT DISTINCT customer_id, start_time, start_time + INTERVAL 5 MINUTE AS end_time, CAST(NULL AS VARCHAR) AS detail,
       'geographical_impossibility' AS fraud_reason
FROM d WHERE epoch_us(ts) - epoch_us(pts) <= 300000000 AND 2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)) > 50"""))
def str3(spark, sf):
    df = M.geo_window_alerts(M.event_time(payments(spark, sf)), watermark=None)
    return df.select("customer_id", F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                     F.col("end_time").cast("timestamp_ntz").alias("end_time"), "detail", "fraud_reason")


def alert_union_sql(closed: str = "TRUE") -> str:
    """Velocity, geographic and amount alerts; ``closed`` filters windows by ``end_time``."""
    return with_payments(f""",
a AS (SELECT customer_id, avg(amount) AS avg_amount FROM pay GROUP BY 1),
w AS (SELECT customer_id, start_time, end_time, detail, fraud_reason FROM (
        SELECT customer_id, time_bucket(INTERVAL 2 MINUTE, ts, TIMESTAMP '1970-01-01') AS start_time,
               time_bucket(INTERVAL 2 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 2 MINUTE AS end_time,
               CAST(count(*) AS VARCHAR) AS detail, 'velocity' AS fraud_reason
        FROM pay GROUP BY 1, 2, 3 HAVING count(*) > 5
        UNION ALL SELECT * FROM ({REGISTRY["str3_geo_window_alerts_batch"][1]})) WHERE {closed})
SELECT customer_id, start_time, detail, fraud_reason FROM w
UNION ALL
SELECT p.customer_id, CAST(NULL AS TIMESTAMP) AS start_time, CAST(p.amount AS VARCHAR) AS detail,
       'amount_anomaly' AS fraud_reason
FROM pay p JOIN a ON p.customer_id = a.customer_id WHERE p.amount > a.avg_amount * 10""")


def alert_union(txns, averages, watermark: bool):
    """Velocity, geographic and amount alerts of a batch or a stream, against static averages."""
    wm = {} if watermark else {"watermark": None}
    return M.union_alerts(M.velocity_alerts(txns, **wm), M.geo_window_alerts(txns, **wm), M.amount_alerts(txns, averages))


def alert_columns(df):
    return df.select("customer_id", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "detail", "fraud_reason")


@query("str5_alert_union_batch", covers="SET1 PRJ9 FLT5 JOI5", sql=alert_union_sql())
def str5(spark, sf):
    t = M.event_time(payments(spark, sf))
    avg = t.groupBy("customer_id").agg(F.avg("amount").alias("avg_amount"))
    return alert_columns(alert_union(t, avg, watermark=False))


@query("str6_metric_commission_by_type_batch", covers="STR6", sql=with_payments(
    _sliding_sql(60, 20, "commission_type, commission_amount") + """
SELECT start_time, start_time + INTERVAL 60 SECOND AS end_time, 'total_commission_by_type' AS metric,
       commission_type AS dimension, CAST(sum(commission_amount) AS DOUBLE) AS value
FROM sw GROUP BY 1, 2, 3, 4"""))
def str6(spark, sf):
    df = M.metric_commission_by_type(M.event_time(payments(spark, sf)), watermark=None)
    return df.select(F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                     F.col("end_time").cast("timestamp_ntz").alias("end_time"), "metric", "dimension", "value")


@query("str7_metric_commission_ratio_batch", covers="STR7 SCA4", sql=with_payments(
    _sliding_sql(60, 20, "merchant_category, commission_amount, amount") + """
SELECT start_time, start_time + INTERVAL 60 SECOND AS end_time, 'commission_ratio_by_category' AS metric,
       merchant_category AS dimension, round(sum(commission_amount) / sum(amount), 6) AS value
FROM sw GROUP BY 1, 2, 3, 4"""))
def str7(spark, sf):
    df = M.metric_commission_ratio(M.event_time(payments(spark, sf)), watermark=None)
    return df.select(F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                     F.col("end_time").cast("timestamp_ntz").alias("end_time"), "metric", "dimension",
                     _r("value"))


@query("win13_top_merchant_per_window", covers="WIN13 STR8 SRT7", sql=with_payments(
    _sliding_sql(300, 20, "merchant_id, commission_amount") + """,
s AS (SELECT start_time, merchant_id, sum(commission_amount) AS tot FROM sw GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY start_time ORDER BY tot DESC, merchant_id DESC) AS rn FROM s)
SELECT start_time, start_time + INTERVAL 300 SECOND AS end_time, 'highest_commission_merchant' AS metric,
       CAST(merchant_id AS VARCHAR) AS dimension, CAST(tot AS DOUBLE) AS value
FROM r WHERE rn = 1"""))
def win13(spark, sf):
    df = M.metric_top_merchant(M.event_time(payments(spark, sf)), watermark=None)
    return df.select(F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                     F.col("end_time").cast("timestamp_ntz").alias("end_time"), "metric", "dimension", "value")
