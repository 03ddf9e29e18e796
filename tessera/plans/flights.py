"""Flight-domain queries: role joins, SQL joins, integrity, calendar features,
rolling windows, null handling, encoders, daily-series windows, splits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions.geo import haversine_km
from tessera.functions.timeparts import calendar_features, hhmm_to_hour, left_closed_bins
from tessera.operators import features as fe
from tessera.operators import joins, nulls, sampling, sequence
from tessera.plans.registry import query
from tessera.plans.sqlhash import h_sql, split_sql
from tessera.plans.views import airports, daily_series, flights, with_daily, with_flights
from tessera.session import cut_lineage
from tessera.streaming.runner import shared_path
from tessera.sources.tables import load_table

# ---- fixed values of the reference's feature rules -------------------------
DEP_BINS = (0, 6, 12, 18, 24)
DEP_LABELS = ("early_morning", "morning", "afternoon", "evening")
LATE_MINUTES = 15
ROLL_ROWS = 7
# -----------------------------------------------------------------------------


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def _day_bucket(c):
    """Row-frame bucket: a day, so even a key holding a third of the rows is
    spread over one task per day it is active."""
    return F.to_date(c)


def flight_features(spark, sf):
    f = flights(spark, sf)
    ap = airports(spark, sf).select("n_nationkey", "n_name", "latitude", "longitude")
    sup = load_table(spark, sf, "supplier").select("s_suppkey", "s_name")
    x = joins.role_join(f, ap, "origin_airport", "n_nationkey", "orig_")
    x = joins.role_join(x, ap, "destination_airport", "n_nationkey", "dest_")
    x = joins.role_join(x, sup, "airline", "s_suppkey", "airline_")
    x = x.withColumn("flight_date", F.make_date("a_year", "a_month", "a_day"))
    x = x.withColumns(calendar_features("flight_date"))
    x = x.withColumn("dep_hour", hhmm_to_hour("scheduled_departure"))
    x = x.withColumn("dep_time_bucket", left_closed_bins("dep_hour", DEP_BINS, DEP_LABELS))
    x = x.withColumn("distance_km", haversine_km("orig_latitude", "orig_longitude", "dest_latitude", "dest_longitude"))
    # a missing delay compares false, as in the reference's pandas comparison
    x = x.withColumn("is_late", F.coalesce((F.col("arrival_delay") > LATE_MINUTES).cast("int"), F.lit(0)))
    x = x.withColumn("delay_per_km", F.coalesce(
        F.try_divide(F.col("arrival_delay"), F.nullif(F.col("distance_km"), F.lit(0.0))), F.lit(0.0)))
    return x


@query("joi1_flight_features", covers="JOI1 JOI2 SCA8 SCA9 SCA10 SCA11 SCA13 FEA8 FLT9 SCA4", sql=with_flights(""",
x AS (
  SELECT f.*, o.n_name AS orig_n_name, o.latitude AS olat, o.longitude AS olng, d.n_name AS dest_n_name,
         d.latitude AS dlat, d.longitude AS dlng, s.s_name AS airline_s_name,
         make_date(a_year, a_month, a_day) AS flight_date
  FROM flights f LEFT JOIN airports o ON f.origin_airport = o.n_nationkey
       LEFT JOIN airports d ON f.destination_airport = d.n_nationkey
       LEFT JOIN supplier s ON f.airline = s.s_suppkey),
y AS (SELECT *, 2 * 6371.0 * asin(sqrt(pow(sin(radians(dlat - olat) / 2), 2)
                 + cos(radians(olat)) * cos(radians(dlat)) * pow(sin(radians(dlng - olng) / 2), 2))) AS distance_km,
             scheduled_departure // 100 AS dep_hour FROM x)
SELECT flight_id, orig_n_name, dest_n_name, airline_s_name, strftime(flight_date, '%Y-%m-%d') AS flight_date,
       CAST(dayofyear(flight_date) AS INTEGER) AS day_of_year, CAST(weekofyear(flight_date) AS INTEGER) AS week_of_year,
       CAST(quarter(flight_date) AS INTEGER) AS quarter, CAST(isodow(flight_date) >= 6 AS INTEGER) AS is_weekend,
       CAST(dep_hour AS INTEGER) AS dep_hour,
       CASE WHEN dep_hour >= 0 AND dep_hour < 6 THEN 'early_morning' WHEN dep_hour >= 6 AND dep_hour < 12 THEN 'morning'
            WHEN dep_hour >= 12 AND dep_hour < 18 THEN 'afternoon' WHEN dep_hour >= 18 AND dep_hour < 24 THEN 'evening'
       END AS dep_time_bucket,
       round(distance_km, 4) AS distance_km, CAST(coalesce(arrival_delay > 15, false) AS INTEGER) AS is_late,
       round(coalesce(arrival_delay / nullif(distance_km, 0), 0), 6) AS delay_per_km
FROM y"""))
def joi1(spark, sf):
    x = flight_features(spark, sf)
    return x.select("flight_id", "orig_n_name", "dest_n_name", "airline_s_name",
                    F.date_format("flight_date", "yyyy-MM-dd").alias("flight_date"),
                    "day_of_year", "week_of_year", "quarter", "is_weekend", "dep_hour", "dep_time_bucket",
                    _r("distance_km", 4), "is_late", _r("delay_per_km"))


@query("win1_airline_rolling_mean", covers="WIN1 SRT2", sql=with_flights("""
SELECT flight_id, airline,
       round(avg(coalesce(arrival_delay, 0)) OVER (PARTITION BY airline
             ORDER BY make_date(a_year, a_month, a_day), flight_id, l_partkey, l_extendedprice
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6)
         AS airline_7d_mean
FROM flights"""))
def win1(spark, sf):
    f = flights(spark, sf).withColumn("flight_date", F.make_date("a_year", "a_month", "a_day"))
    # the 4-way join feeds several consumers: compute it once (needed columns only)
    f = cut_lineage(f.select("flight_id", "airline", "flight_date", "l_partkey", "l_extendedprice", "arrival_delay"))
    # (order, line) repeats in the test data; part and price complete a total order
    x = sequence.rolling_mean(f, "airline", ["flight_date", "flight_id", "l_partkey", "l_extendedprice"],
                              "arrival_delay", ROLL_ROWS,
                              _day_bucket(F.col("flight_date")), "airline_7d_mean")
    return x.select("flight_id", "airline", _r("airline_7d_mean"))


def _flight_views(spark, sf):
    flights(spark, sf).createOrReplaceTempView("flights")
    airports(spark, sf).createOrReplaceTempView("airports")
    load_table(spark, sf, "supplier").createOrReplaceTempView("suppliers")


@query("agg16_airline_stats_sql", covers="AGG16 SNK8", sql=with_flights("""
SELECT airline, count(*) AS n_flights, round(avg(arrival_delay), 6) AS avg_delay,
       CAST(sum(cancelled) AS BIGINT) AS n_cancelled
FROM flights GROUP BY airline"""))
def agg16(spark, sf):
    _flight_views(spark, sf)
    return spark.sql("""SELECT airline, COUNT(*) AS n_flights, ROUND(AVG(arrival_delay), 6) AS avg_delay,
                               CAST(SUM(cancelled) AS BIGINT) AS n_cancelled
                        FROM flights GROUP BY airline""")


@query("agg17_route_air_time_sql", covers="AGG17", sql=with_flights("""
SELECT origin_airport, destination_airport, round(avg(air_time), 6) AS avg_air_time
FROM flights GROUP BY 1, 2"""))
def agg17(spark, sf):
    _flight_views(spark, sf)
    return spark.sql("""SELECT origin_airport, destination_airport, ROUND(AVG(air_time), 6) AS avg_air_time
                        FROM flights GROUP BY origin_airport, destination_airport""")


@query("joi3_comma_join_routes_sql", covers="JOI3", sql=with_flights("""
SELECT a1.n_name AS origin_name, a2.n_name AS destination_name, count(*) AS n_flights
FROM flights f, airports a1, airports a2
WHERE f.origin_airport = a1.n_nationkey AND f.destination_airport = a2.n_nationkey GROUP BY 1, 2"""))
def joi3(spark, sf):
    _flight_views(spark, sf)
    return spark.sql("""SELECT a1.n_name AS origin_name, a2.n_name AS destination_name, COUNT(*) AS n_flights
                        FROM flights f, airports a1, airports a2
                        WHERE f.origin_airport = a1.n_nationkey AND f.destination_airport = a2.n_nationkey
                        GROUP BY a1.n_name, a2.n_name""")


@query("joi4_airline_names_sql", covers="JOI4", sql=with_flights("""
SELECT s.s_name AS airline_name, count(*) AS n_flights, round(avg(f.arrival_delay), 6) AS avg_delay
FROM flights f, supplier s WHERE f.airline = s.s_suppkey GROUP BY 1"""))
def joi4(spark, sf):
    _flight_views(spark, sf)
    return spark.sql("""SELECT s.s_name AS airline_name, COUNT(*) AS n_flights, ROUND(AVG(f.arrival_delay), 6) AS avg_delay
                        FROM flights f, suppliers s WHERE f.airline = s.s_suppkey GROUP BY s.s_name""")


@query("joi9_integrity_report", covers="JOI9 SNK5", sql="""
SELECT 'lineitem.l_orderkey -> orders' AS check_name,
       (SELECT count(*) FROM lineitem WHERE l_orderkey IS NOT NULL
          AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS n_violations
UNION ALL SELECT 'lineitem.l_partkey -> part', (SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL
          AND l_partkey NOT IN (SELECT p_partkey FROM part))
UNION ALL SELECT 'lineitem.l_suppkey -> supplier', (SELECT count(*) FROM lineitem WHERE l_suppkey IS NOT NULL
          AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'orders.o_custkey -> customer', (SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL
          AND o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'customer.c_nationkey -> nation', (SELECT count(*) FROM customer WHERE c_nationkey IS NOT NULL
          AND c_nationkey NOT IN (SELECT n_nationkey FROM nation))
UNION ALL SELECT 'orders pk duplicates', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'lineitem pk duplicates', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem
          GROUP BY 1, 2 HAVING count(*) > 1))
UNION ALL SELECT 'events pk duplicates', (SELECT count(*) FROM (SELECT event_id FROM events GROUP BY 1 HAVING count(*) > 1))
""")
def joi9(spark, sf):
    t = {n: load_table(spark, sf, n) for n in ("lineitem", "orders", "part", "supplier", "customer", "nation", "events")}
    checks = [
        ("lineitem.l_orderkey -> orders", joins.orphans(t["lineitem"], t["orders"], "l_orderkey", "o_orderkey")),
        ("lineitem.l_partkey -> part", joins.orphans(t["lineitem"], t["part"], "l_partkey", "p_partkey")),
        ("lineitem.l_suppkey -> supplier", joins.orphans(t["lineitem"], t["supplier"], "l_suppkey", "s_suppkey")),
        ("orders.o_custkey -> customer", joins.orphans(t["orders"], t["customer"], "o_custkey", "c_custkey")),
        ("customer.c_nationkey -> nation", joins.orphans(t["customer"], t["nation"], "c_nationkey", "n_nationkey")),
        ("orders pk duplicates", joins.duplicate_keys(t["orders"], ["o_orderkey"])),
        ("lineitem pk duplicates", joins.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])),
        ("events pk duplicates", joins.duplicate_keys(t["events"], ["event_id"])),
    ]
    out = None
    for name, df in checks:
        one = df.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations")
        out = one if out is None else out.unionByName(one)
    return out


@query("nul2_cancelled_then_median", covers="NUL1 NUL2 NUL3 NUL4", sql=with_flights(""",
a AS (SELECT flight_id, CASE WHEN cancelled = 1 AND arrival_delay IS NULL THEN -1.0 ELSE arrival_delay END AS arrival_delay,
             coalesce(cancellation_reason, 'Unknown') AS cancellation_reason FROM flights)
SELECT flight_id, coalesce(arrival_delay, (SELECT median(arrival_delay) FROM a)) AS arrival_delay, cancellation_reason
FROM a"""))
def nul2(spark, sf):
    f = flights(spark, sf).select("flight_id", "arrival_delay", "cancelled", "cancellation_reason")
    f = nulls.fill_constants(f, {"cancellation_reason": "Unknown"})
    x = nulls.impute_cancelled_then_median(f, ["arrival_delay"], "cancelled")
    return x.select("flight_id", "arrival_delay", "cancellation_reason")


@query("nul5_mean_fill_customer_totals", covers="NUL5 NUL1 JOI8", sql="""
WITH t AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1),
     j AS (SELECT c_custkey, t.total FROM customer LEFT JOIN t ON c_custkey = o_custkey)
SELECT c_custkey, round(coalesce(total, (SELECT avg(total) FROM j)), 4) AS total FROM j""")
def nul5(spark, sf):
    o = load_table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    c = load_table(spark, sf, "customer").select("c_custkey")
    j = c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "total")
    return nulls.impute_mean(j, ["total"]).select("c_custkey", _r("total", 4))


@query("fea1_standard_scale", covers="FEA1 FEA2", sql="""
SELECT l_orderkey, l_linenumber,
       round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity_z,
       round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) AS l_extendedprice_z,
       round(l_quantity, 6) AS l_quantity_back
FROM lineitem""")
def fea1(spark, sf):
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    st = fe.fit_standard(li, ["l_quantity", "l_extendedprice"])
    x = fe.apply_standard(li, st, "_z")
    # FEA2: the inverse transform brings a scaled column back to its units
    x = fe.inverse_standard(x.withColumn("l_quantity_back", F.col("l_quantity_z")), st,
                            {"l_quantity_back": "l_quantity"})
    return x.select("l_orderkey", "l_linenumber", _r("l_quantity_z"), _r("l_extendedprice_z"), _r("l_quantity_back"))


@query("fea3_minmax_daily", covers="FEA3", sql=with_daily("""
SELECT strftime(d, '%Y-%m-%d') AS d,
       round((total - min(total) OVER ()) / (max(total) OVER () - min(total) OVER ()), 6) AS total_scaled,
       round(total, 4) AS total_back
FROM daily"""))
def fea3(spark, sf):
    d = daily_series(spark, sf)
    st = fe.fit_minmax(d, ["total"])
    x = fe.apply_minmax(d, st, "_scaled")
    x = fe.inverse_minmax(x.withColumn("total_back", F.col("total_scaled")), st, {"total_back": "total"})
    return x.select(F.date_format("d", "yyyy-MM-dd").alias("d"), _r("total_scaled"), _r("total_back", 4))


@query("fea4_ordinal_encode_unknown", covers="FEA4 FEA5", sql="""
WITH lv AS (SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 10 AND p_type <> 'PROMO'))
SELECT p_partkey, p.p_type, CAST(coalesce(lv.code, -1) AS INTEGER) AS p_type_code
FROM part p LEFT JOIN lv ON p.p_type = lv.p_type""")
def fea4(spark, sf):
    p = load_table(spark, sf, "part")
    levels = fe.fit_ordinal(p.where("p_size <= 10 AND p_type <> 'PROMO'"), "p_type")
    # FEA5: the fitted encoder is a table; it is stored and re-read to encode later data
    path = shared_path(spark, "encoders", "p_type", uuid.uuid4().hex[:12])
    levels.write.parquet(path)
    return fe.apply_ordinal(p, spark.read.parquet(path), "p_type").select("p_partkey", "p_type", "p_type_code")


@query("fea6_one_hot_status", covers="FEA6 PRJ10 PRJ11", sql="""
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F,
       CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P,
       CAST(o_totalprice AS FLOAT) AS num__o_totalprice
FROM orders""")
def fea6(spark, sf):
    o = load_table(spark, sf, "orders")
    x = fe.one_hot(o, "o_orderstatus", fe.fit_levels(o, "o_orderstatus"))
    x = x.withColumnRenamed("o_totalprice", "num__o_totalprice")
    x = fe.downcast_by_prefix(x, {"num__": "float"})
    keep = ["o_orderkey"] + [c for c in fe.columns_of_kind(x, "numeric") if c.startswith(("o_orderstatus_", "num__"))]
    return x.select(*keep)


@query("win10_dense_row_id", covers="WIN10", sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders""")
def win10(spark, sf):
    o = load_table(spark, sf, "orders")
    x = sequence.dense_row_id(o.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
    return x.select("o_orderkey", "row_id")


@query("win11_first_row_per_class", covers="WIN11", sql="""
SELECT label, min(vec_id) AS first_vec_id, count(*) AS n_rows FROM embeddings GROUP BY label""")
def win11(spark, sf):
    e = load_table(spark, sf, "embeddings")
    # first row = min by id: a partial aggregate, no window over a whole class
    return e.groupBy("label").agg(F.min("vec_id").alias("first_vec_id"), F.count(F.lit(1)).alias("n_rows"))


# ---- daily series (WIN2-WIN5, WIN12, AGG19): one row per calendar day, so the
# ---- unpartitioned windows run over a table bounded by the number of days.

@query("win2_centered_5_row_mean", covers="WIN2 AGG19", sql=with_daily("""
SELECT strftime(d, '%Y-%m-%d') AS d,
       CASE WHEN count(*) OVER w = 5 THEN round(avg(total) OVER w, 6) END AS total_c5
FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"""))
def win2(spark, sf):
    x = sequence.row_frame(daily_series(spark, sf), "d", -2, 2, "total", "total_c5", decimals=6)
    return x.select(F.date_format("d", "yyyy-MM-dd").alias("d"), "total_c5")


@query("win3_trailing_60_row_mean", covers="WIN3", sql=with_daily("""
SELECT strftime(d, '%Y-%m-%d') AS d,
       CASE WHEN count(*) OVER w = 60 THEN round(avg(total) OVER w, 6) END AS total_ma60
FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"""))
def win3(spark, sf):
    x = sequence.row_frame(daily_series(spark, sf), "d", -59, 0, "total", "total_ma60", decimals=6)
    return x.select(F.date_format("d", "yyyy-MM-dd").alias("d"), "total_ma60")


@query("win4_next_day_mid_target", covers="WIN4", sql=with_daily("""
SELECT * FROM (
  SELECT strftime(d, '%Y-%m-%d') AS d, round((lead(high) OVER w + lead(low) OVER w) / 2, 4) AS target
  FROM daily WINDOW w AS (ORDER BY d)) WHERE target IS NOT NULL"""))
def win4(spark, sf):
    x = sequence.next_mid(daily_series(spark, sf), "d", "high", "low")
    return x.select(F.date_format("d", "yyyy-MM-dd").alias("d"), F.round("target", 4).alias("target"))


@query("win5_lookback_sequences", covers="WIN5", sql=with_daily("""
SELECT * FROM (
  SELECT strftime(d, '%Y-%m-%d') AS d, n_orders AS target,
         array_to_string(list(n_orders) OVER w, ',') AS seq, count(*) OVER w AS seq_len
  FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)) WHERE seq_len = 30"""))
def win5(spark, sf):
    x = sequence.lookback_sequences(daily_series(spark, sf), "d", ["n_orders"], "n_orders", 30)
    seq = F.array_join(F.transform("seq", lambda v: v["n_orders"].cast("string")), ",")
    return x.select(F.date_format("d", "yyyy-MM-dd").alias("d"), "target", F.size("seq").cast("bigint").alias("seq_len"),
                    seq.alias("seq"))


# 60 days of two features, two days ahead, inside chronological splits by calendar year
@query("win5_lookback_60_by_split", covers="WIN5 SMP4", sql=with_daily("""
SELECT strftime(d, '%Y-%m-%d') AS d, split, n_orders AS target, first_orders, last_total FROM (
  SELECT d, split, n_orders, first_value(n_orders) OVER w AS first_orders, round(last_value(total) OVER w, 4) AS last_total,
         count(*) OVER w AS k
  FROM (SELECT *, CASE WHEN year(d) < 1996 THEN 'train' WHEN year(d) < 1997 THEN 'validation' ELSE 'test' END AS split FROM daily)
  WINDOW w AS (PARTITION BY split ORDER BY d ROWS BETWEEN 61 PRECEDING AND 2 PRECEDING)) WHERE k = 60"""))
def win5s(spark, sf):
    split = F.when(F.year("d") < 1996, "train").when(F.year("d") < 1997, "validation").otherwise("test")
    x = sequence.lookback_sequences(daily_series(spark, sf).withColumn("split", split), "d", ["n_orders", "total"], "n_orders",
                                    60, horizon=2, by=["split"])
    return x.select(F.date_format("d", "yyyy-MM-dd").alias("d"), "split", "target", F.element_at("seq", 1)["n_orders"].alias("first_orders"),
                    F.round(F.element_at("seq", -1)["total"], 4).alias("last_total"))


@query("win1_customer_seven_day_mean", covers="WIN1", sql="""
SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)
                         RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 4) AS mean_7d FROM orders""")
def win1r(spark, sf):
    o = load_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    x = sequence.range_mean(o, "o_custkey", "o_orderdate", "o_totalprice", 7, "mean_7d")
    return x.select("o_orderkey", F.round("mean_7d", 4).alias("mean_7d"))


@query("win12_lagged_trailing_means", covers="WIN12 NUL1", sql=with_daily(""",
x AS (SELECT d, avg(total) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS l7,
             avg(total) OVER (ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS l30 FROM daily)
SELECT strftime(d, '%Y-%m-%d') AS d, round(coalesce(l7, (SELECT avg(l7) FROM x)), 4) AS total_lag7,
       round(coalesce(l30, (SELECT avg(l30) FROM x)), 4) AS total_lag30 FROM x"""))
def win12(spark, sf):
    x = daily_series(spark, sf)
    for n in (7, 30):
        x = sequence.row_frame(x, "d", -n, -1, "total", f"total_lag{n}", full=False)
    filled = nulls.fill_constants(x, x.agg(*[F.avg(c).alias(c) for c in ("total_lag7", "total_lag30")]).first().asDict())
    return filled.select(F.date_format("d", "yyyy-MM-dd").alias("d"), _r("total_lag7", 4), _r("total_lag30", 4))


@query("win1_customer_lagged_mean_7", covers="WIN12 WIN1", sql="""
SELECT o_orderkey, o_custkey,
       round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS prev7_mean
FROM orders""")
def win1c(spark, sf):
    o = load_table(spark, sf, "orders")
    x = sequence.rolling_mean(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 7,
                              _day_bucket(F.col("o_orderdate")), "prev7_mean", exclude_current=True)
    return x.select("o_orderkey", "o_custkey", _r("prev7_mean"))


# ---- splits and samples ------------------------------------------------------

_SPLIT3 = {"train": 0.8, "validation": 0.1, "test": 0.1}
_SPLIT_G = {"train": 0.85, "test": 0.15}


@query("smp1_hash_split_sizes", covers="SMP1 SMP3", sql=f"""
SELECT split, count(*) AS n_rows FROM (SELECT {split_sql(42, ["o_orderkey"], _SPLIT3)} AS split FROM orders) GROUP BY 1
UNION ALL
SELECT 'group_' || split, count(*) FROM (SELECT {split_sql(42, ["o_custkey"], _SPLIT_G)} AS split FROM orders) GROUP BY 1""")
def smp1(spark, sf):
    o = load_table(spark, sf, "orders")
    x = sampling.hash_split(o, ["o_orderkey"], _SPLIT3)
    g = sampling.hash_split(o, ["o_custkey"], _SPLIT_G, out="group_split")
    return (x.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
             .unionByName(g.groupBy(F.col("group_split").alias("split")).agg(F.count(F.lit(1)).alias("n_rows"))
                           .withColumn("split", F.concat(F.lit("group_"), F.col("split")))))


@query("smp2_stratified_folds", covers="SMP2", sql=f"""
SELECT quality, CAST((p - 1) % 5 AS INTEGER) AS fold, count(*) AS n_rows FROM (
  SELECT quality, row_number() OVER (PARTITION BY quality ORDER BY {h_sql(42, "doc_id")}, doc_id) AS p FROM labels)
GROUP BY 1, 2""")
def smp2(spark, sf):
    lab = load_table(spark, sf, "labels")
    x = sampling.stratified_folds(lab, "quality", ["doc_id"], k=5)
    return x.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query("smp4_chronological_split", covers="SMP4", sql="""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS p, count(*) OVER () AS n FROM orders)
SELECT CASE WHEN p <= floor(n * 0.7) THEN 'train' WHEN p <= floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split,
       count(*) AS n_rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
FROM r GROUP BY 1""")
def smp4(spark, sf):
    o = load_table(spark, sf, "orders")
    x = sampling.chrono_split(o.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
    return x.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("min_key"),
                                  F.max("o_orderkey").alias("max_key"))


@query("smp5_hash_sample", covers="SMP5", sql=f"""
SELECT doc_id, lang FROM documents ORDER BY {h_sql(42, "doc_id")}, doc_id LIMIT 20""")
def smp5(spark, sf):
    return sampling.hash_sample(load_table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], 20)


@query("smp6_first_5000_rows", covers="SMP6 SRT6", sql="""
SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5000""")
def smp6(spark, sf):
    return sampling.first_rows(load_table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 5000)


@query("set3_remove_labelled_docs", covers="SET3 SET4 JOI6", sql="""
SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS n_unlabelled,
       (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS n_common""")
def set3(spark, sf):
    d = load_table(spark, sf, "documents").select("doc_id")
    lab = load_table(spark, sf, "labels").select("doc_id")
    # one pass: left join with a membership flag counts both the anti and the semi side
    j = d.join(lab.distinct().withColumn("__in", F.lit(1)), "doc_id", "left")
    return j.agg(F.count(F.when(F.col("__in").isNull(), 1)).alias("n_unlabelled"),
                 F.count(F.when(F.col("__in") == 1, 1)).alias("n_common"))


@query("agg19_daily_means", covers="AGG19", sql="""
SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d, round(avg(o_totalprice), 6) AS avg_totalprice,
       round(avg(CAST(o_custkey AS DOUBLE)), 6) AS avg_custkey, count(*) AS n_orders
FROM orders GROUP BY 1""")
def agg19(spark, sf):
    o = load_table(spark, sf, "orders")
    g = o.groupBy(F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("d")).agg(
        F.avg("o_totalprice").alias("avg_totalprice"), F.avg(F.col("o_custkey").cast("double")).alias("avg_custkey"),
        F.count(F.lit(1)).alias("n_orders"))
    return g.select("d", _r("avg_totalprice"), _r("avg_custkey"), "n_orders")


@query("set2_union_missing_columns", covers="SET2", sql="""
SELECT kind, count(*) AS n_rows, count(acctbal) AS n_acctbal, count(segment) AS n_segment FROM (
  SELECT 'customer' AS kind, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'supplier', s_acctbal, NULL FROM supplier)
GROUP BY 1""")
def set2(spark, sf):
    c = load_table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("acctbal"),
                                                 F.col("c_mktsegment").alias("segment"))
    s_ = load_table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("acctbal"))
    u = c.unionByName(s_, allowMissingColumns=True)       # pd.concat(axis=0) with differing columns
    return u.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"), F.count("acctbal").alias("n_acctbal"),
                                 F.count("segment").alias("n_segment"))
