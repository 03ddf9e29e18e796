"""Payment-domain queries over the ``payments`` view of ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import payments as pay
from tessera.plans.registry import query
from tessera.plans.views import payments, with_payments

R = 6  # decimals kept for float results on both sides of the oracle check


def _r(c, d=R):
    return F.round(F.col(c), d).alias(c)


@query("agg1_commission_by_category", covers="SRC8 PRJ1 AGG1 SCA4", sql=with_payments("""
SELECT merchant_category, CAST(sum(commission_amount) AS BIGINT) AS total_commission,
       round(avg(commission_amount), 6) AS avg_commission, count(*) AS transaction_count,
       round(avg(commission_amount / total_amount), 6) AS avg_commission_ratio
FROM pay GROUP BY merchant_category"""))
def agg1(spark, sf):
    df = pay.commission_by_category(payments(spark, sf))
    return df.select("merchant_category", "total_commission", _r("avg_commission"),
                     "transaction_count", _r("avg_commission_ratio"))


@query("agg2_commission_what_if", covers="AGG2 SCA1 UDF1", sql=with_payments("""
SELECT merchant_category, CAST(sum(commission_amount) AS BIGINT) AS actual_total_commission,
       round(sum(amount * 0.02), 2) AS sim_flat_total,
       round(sum(CASE WHEN amount <= 1000000 THEN amount * 0.015 ELSE amount * 0.03 END), 2) AS sim_progressive_total,
       round(sum(amount * 0.02 + CASE WHEN amount > 1500000 THEN amount * 0.005 ELSE 0 END), 2) AS sim_tiered_total
FROM pay GROUP BY merchant_category"""))
def agg2(spark, sf):
    df = pay.commission_what_if(payments(spark, sf))
    return df.select("merchant_category", "actual_total_commission",
                     *[_r(c, 2) for c in ("sim_flat_total", "sim_progressive_total", "sim_tiered_total")])


@query("agg3_method_statistics", covers="AGG3", sql=with_payments("""
SELECT payment_method, count(*) AS num_transactions, CAST(sum(amount) AS BIGINT) AS total_amount,
       round(avg(amount), 6) AS avg_amount, round(stddev_samp(amount), 4) AS stddev_amount
FROM pay GROUP BY payment_method"""))
def agg3(spark, sf):
    df = pay.method_statistics(payments(spark, sf))
    return df.select("payment_method", "num_transactions", "total_amount", _r("avg_amount"),
                     _r("stddev_amount", 4))


@query("agg4_hourly_counts", covers="AGG4 SCA7 SRT1", sql=with_payments("""
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS transaction_count FROM pay GROUP BY 1"""))
def agg4_hour(spark, sf):
    return pay.hourly_counts(payments(spark, sf)).orderBy("hour")


@query("agg4_weekday_counts", covers="AGG4 SCA7", sql=with_payments("""
SELECT dayname(ts) AS day_of_week, count(*) AS transaction_count FROM pay GROUP BY 1"""))
def agg4_weekday(spark, sf):
    return pay.weekday_counts(payments(spark, sf))


@query("agg5_customer_segments", covers="AGG5 SCA5", sql=with_payments("""
SELECT customer_id, count(*) AS num_transactions, CAST(sum(amount) AS BIGINT) AS total_spent,
       round(avg(amount), 6) AS avg_spent,
       CASE WHEN count(*) > 19 THEN 'power_user' WHEN sum(amount) > 22000000 THEN 'big_spender'
            ELSE 'regular' END AS segment
FROM pay GROUP BY customer_id"""))
def agg5(spark, sf):
    df = pay.customer_segments(payments(spark, sf))
    return df.select("customer_id", "num_transactions", "total_spent", _r("avg_spent"), "segment")


@query("srt3_top10_customers", covers="SRT3 SRT1", sql=with_payments("""
SELECT customer_id, count(*) AS num_transactions, CAST(sum(amount) AS BIGINT) AS total_spent
FROM pay GROUP BY customer_id ORDER BY total_spent DESC, customer_id LIMIT 10"""))
def srt3(spark, sf):
    df = pay.customer_segments(payments(spark, sf)).select("customer_id", "num_transactions", "total_spent")
    return pay.top_n(df, 10, "total_spent", "customer_id")


@query("agg6_category_comparison", covers="AGG6", sql=with_payments("""
SELECT merchant_category, count(*) AS num_transactions, round(avg(amount), 6) AS avg_amount,
       CAST(sum(amount) AS BIGINT) AS total_amount, round(avg(risk_level), 6) AS avg_risk_level
FROM pay GROUP BY merchant_category"""))
def agg6(spark, sf):
    df = pay.category_comparison(payments(spark, sf))
    return df.select("merchant_category", "num_transactions", _r("avg_amount"), "total_amount",
                     _r("avg_risk_level"))


@query("agg7_day_part_statistics", covers="AGG7 SCA6", sql=with_payments("""
SELECT CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'afternoon'
            WHEN hour(ts) BETWEEN 18 AND 23 THEN 'evening' ELSE 'night' END AS day_part,
       count(*) AS num_transactions, round(avg(amount), 6) AS avg_amount
FROM pay GROUP BY 1"""))
def agg7(spark, sf):
    df = pay.day_part_statistics(payments(spark, sf))
    return df.select("day_part", "num_transactions", _r("avg_amount"))


@query("agg8_daily_trend", covers="AGG8 SCA7", sql=with_payments("""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, CAST(sum(amount) AS BIGINT) AS total_amount, count(*) AS transaction_count,
       round(avg(amount), 6) AS avg_amount
FROM pay GROUP BY 1"""))
def agg8(spark, sf):
    df = pay.daily_trend(payments(spark, sf))
    return df.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "total_amount", "transaction_count",
                     _r("avg_amount")).orderBy("date")


@query("agg9_merchant_daily_summary", covers="AGG9", sql=with_payments("""
SELECT merchant_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date,
       CAST(sum(commission_amount) AS BIGINT) AS total_commission, count(*) AS transaction_count,
       CAST(sum(amount) AS BIGINT) AS total_amount
FROM pay GROUP BY 1, 2"""))
def agg9(spark, sf):
    return pay.merchant_daily_summary(payments(spark, sf))


@query("agg10_hourly_volume", covers="AGG10", sql=with_payments("""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(transaction_id) AS transaction_count
FROM pay GROUP BY 1, 2"""))
def agg10(spark, sf):
    return pay.hourly_volume(payments(spark, sf))


@query("agg11_minute_volume", covers="AGG11 SCA7", sql=with_payments("""
SELECT date_trunc('minute', ts) AS minute, count(*) AS transaction_count FROM pay GROUP BY 1"""))
def agg11(spark, sf):
    return pay.minute_volume(payments(spark, sf))


@query("agg12_merchant_counts", covers="AGG12 SRT4", sql=with_payments("""
SELECT merchant_id, count(*) AS transaction_count FROM pay GROUP BY 1"""))
def agg12m(spark, sf):
    return pay.count_per(payments(spark, sf), "merchant_id").orderBy(F.desc("transaction_count"), "merchant_id")


@query("agg12_customer_counts", covers="AGG12 SRT4", sql=with_payments("""
SELECT customer_id, count(*) AS transaction_count FROM pay GROUP BY 1"""))
def agg12c(spark, sf):
    return pay.count_per(payments(spark, sf), "customer_id").orderBy(F.desc("transaction_count"), "customer_id")


@query("srt3_top5_merchants", covers="SRT3", sql=with_payments("""
SELECT merchant_id, count(*) AS transaction_count FROM pay GROUP BY 1
ORDER BY transaction_count DESC, merchant_id LIMIT 5"""))
def srt3m(spark, sf):
    return pay.top_n(pay.count_per(payments(spark, sf), "merchant_id"), 5, "transaction_count", "merchant_id")


_HCOLS = ",\n       ".join(
    f"CAST(count(*) FILTER (WHERE hour(ts) = {h}) AS BIGINT) AS h{h:02d}" for h in range(24))


@query("agg13_category_hour_histogram", covers="AGG13", sql=with_payments(f"""
SELECT merchant_category,
       {_HCOLS}
FROM pay GROUP BY merchant_category"""))
def agg13(spark, sf):
    return pay.category_hour_histogram(payments(spark, sf))


_REC_SQL = """CASE WHEN customer_type = 'CIP' THEN 'flat'
            WHEN merchant_category = 'government' AND amount > 1000000 THEN 'tiered'
            WHEN amount < 300000 THEN 'flat' WHEN amount < 1500000 THEN 'progressive' ELSE 'tiered' END"""
_SIM_SQL = """CASE WHEN recommended_type = 'flat' THEN 20000.0
            WHEN recommended_type = 'progressive' THEN amount * 0.02
            WHEN amount <= 1000000 THEN amount * 0.015
            ELSE 1000000 * 0.015 + (amount - 1000000) * 0.01 END"""


@query("agg14_fee_audit", covers="AGG14 SCA2 SCA3 SCA4 UDF4", sql=with_payments(f""",
rec AS (SELECT *, {_REC_SQL} AS recommended_type FROM pay),
sim AS (SELECT *, {_SIM_SQL} AS sim_fee FROM rec),
s AS (SELECT recommended_type, avg(sim_fee - commission_amount) AS avg_gain, sum(sim_fee) AS total_simulated,
             sum(commission_amount) AS total_actual FROM sim GROUP BY 1)
SELECT recommended_type, round(avg_gain, 4) AS avg_gain, round(total_simulated, 2) AS total_simulated,
       CAST(total_actual AS BIGINT) AS total_actual,
       round((sum(total_simulated) OVER () - sum(total_actual) OVER ()) / sum(total_actual) OVER () * 100, 6)
         AS improvement_pct
FROM s"""))
def agg14(spark, sf):
    df = pay.fee_audit(payments(spark, sf))
    return df.select("recommended_type", _r("avg_gain", 4), _r("total_simulated", 2), "total_actual",
                     _r("improvement_pct"))


@query("agg15_customer_average", covers="AGG15", sql=with_payments("""
SELECT customer_id, round(avg(amount), 6) AS avg_amount FROM pay GROUP BY 1"""))
def agg15(spark, sf):
    return pay.customer_average(payments(spark, sf)).select("customer_id", _r("avg_amount"))


@query("flt5_amount_anomalies", covers="JOI5 FLT5 UDF2", sql=with_payments(""",
a AS (SELECT customer_id, avg(amount) AS avg_amount FROM pay GROUP BY 1)
SELECT p.transaction_id, p.customer_id, p.amount, round(a.avg_amount, 6) AS avg_amount
FROM pay p JOIN a ON p.customer_id = a.customer_id WHERE p.amount > a.avg_amount * 10"""))
def flt5(spark, sf):
    p = payments(spark, sf)
    df = pay.amount_anomalies(p, p)
    return df.select("transaction_id", "customer_id", "amount", _r("avg_amount"))


@query("flt6_out_of_hours", covers="FLT6", sql=with_payments(""",
h AS (SELECT *, hour(ts) AS hr,
        CASE merchant_category WHEN 'retail' THEN 8 WHEN 'food_service' THEN 7 WHEN 'entertainment' THEN 10
             WHEN 'transportation' THEN 0 WHEN 'government' THEN 8 ELSE 8 END AS open_h,
        CASE merchant_category WHEN 'retail' THEN 22 WHEN 'food_service' THEN 1 WHEN 'entertainment' THEN 2
             WHEN 'transportation' THEN 24 WHEN 'government' THEN 17 ELSE 20 END AS close_h FROM pay)
SELECT transaction_id, merchant_category, CAST(hr AS INTEGER) AS hour
FROM h WHERE NOT (CASE WHEN open_h < close_h THEN hr >= open_h AND hr < close_h
                       ELSE hr >= open_h OR hr < close_h END)"""))
def flt6(spark, sf):
    df = pay.out_of_hours(payments(spark, sf))
    return df.where("out_of_hours").select("transaction_id", "merchant_category", "hour")
