"""Windowed payment metrics and fraud alerts (STR1-STR9, WIN13).

Every function takes a batch *or* streaming DataFrame: the same plan runs as
a batch twin (checked against SQL) and under Structured Streaming.  Event
time must be ``TIMESTAMP`` (not ``TIMESTAMP_NTZ``) for ``withWatermark``;
``event_time`` does that cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.geo import haversine_atan2_km

# ---- fixed values of the reference's stream definitions ---------------------
CATEGORY_WINDOW, CATEGORY_SLIDE = "1 minute", "20 seconds"      # STR1
VELOCITY_WINDOW, VELOCITY_MIN_COUNT = "2 minutes", 5            # STR2: count > 5
GEO_WINDOW, GEO_MAX_SECONDS, GEO_MIN_KM = "5 minutes", 300, 50.0  # STR3
METRIC_WATERMARK = "1 minute"                                    # STR6-STR8
WIN1, SLIDE1 = "1 minute", "20 seconds"
WIN2, SLIDE2 = "5 minutes", "20 seconds"
# -----------------------------------------------------------------------------


def event_time(df: DataFrame, ts: str = "ts", out: str = "event_time") -> DataFrame:
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def _wm(df: DataFrame, col: str, delay: str | None) -> DataFrame:
    return df.withWatermark(col, delay) if delay else df


def _bounds(w: str = "w") -> list[Column]:
    return [F.col(f"{w}.start").alias("start_time"), F.col(f"{w}.end").alias("end_time")]


def windowed(txns: DataFrame, key: str, measures: dict[str, Column], window: str, slide: str | None = None,
             time_col: str = "event_time", watermark: str | None = None) -> DataFrame:
    """Aggregates per sliding (or tumbling) window and key: ``measures`` maps output names to
    aggregate columns.  Partial aggregates before the shuffle, so a hot key costs one row per task and window."""
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    return (_wm(txns, time_col, watermark).groupBy(w.alias("w"), F.col(key))
            .agg(*[c.alias(n) for n, c in measures.items()]).select(*_bounds(), key, *measures))


def _metric(df: DataFrame, name: str, key: str, value: Column) -> DataFrame:
    """A windowed aggregate as rows of the metric stream."""
    return df.select("start_time", "end_time", F.lit(name).alias("metric"), F.col(key).cast("string").alias("dimension"), value.alias("value"))


def sliding_category_commission(txns: DataFrame, time_col="event_time", category="merchant_category",
                                commission="commission_amount", window=CATEGORY_WINDOW,
                                slide=CATEGORY_SLIDE, watermark: str | None = None) -> DataFrame:
    """STR1: sliding window x category: total and average commission."""
    return windowed(txns, category, {"total_commission": F.sum(commission), "avg_commission": F.avg(commission)},
                    window, slide, time_col, watermark)


def velocity_alerts(txns: DataFrame, time_col="event_time", customer="customer_id",
                    window=VELOCITY_WINDOW, min_count=VELOCITY_MIN_COUNT,
                    watermark: str | None = VELOCITY_WINDOW) -> DataFrame:
    """STR2 (+FLT4, STR9): tumbling window per customer with more than ``min_count`` rows."""
    df = _wm(txns, time_col, watermark)
    return (df.groupBy(F.window(time_col, window).alias("w"), F.col(customer))
              .agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > min_count)
              .select(F.col(customer), *_bounds(), F.col("n").cast("string").alias("detail"),
                      F.lit("velocity").alias("fraud_reason")))


def geo_window_alerts(txns: DataFrame, time_col="event_time", customer="customer_id",
                      id_col="transaction_id", lat="lat", lng="lng", window=GEO_WINDOW,
                      max_seconds=GEO_MAX_SECONDS, min_km=GEO_MIN_KM,
                      watermark: str | None = GEO_WINDOW) -> DataFrame:
    """STR3 (+UDF3): tumbling window per customer; alert when two time-consecutive
    events are <= ``max_seconds`` apart and > ``min_km`` apart.

    The list is sorted by (time, id) before the pair test (the unsorted list
    of the reference let negative gaps pass); the test itself is a native
    higher-order function, no Python UDF.  The list is bounded by one
    customer's events inside one window.
    """
    if not txns.isStreaming:
        return _geo_window_alerts_batch(txns, time_col, customer, id_col, lat, lng, window, max_seconds, min_km)
    df = _wm(txns, time_col, watermark)
    pts = F.array_sort(F.collect_list(F.struct(
        F.unix_micros(F.col(time_col)).alias("us"), F.col(id_col).alias("id"),
        F.col(lat).alias("lat"), F.col(lng).alias("lng"))))
    g = df.groupBy(F.window(time_col, window).alias("w"), F.col(customer)).agg(pts.alias("pts"))
    pair_bad = F.exists(
        F.sequence(F.lit(2), F.greatest(F.size("pts"), F.lit(2))),
        lambda i: (F.size("pts") >= 2)
        & ((F.element_at("pts", i)["us"] - F.element_at("pts", i - 1)["us"]) <= max_seconds * 1_000_000)
        & (haversine_atan2_km(F.element_at("pts", i - 1)["lat"], F.element_at("pts", i - 1)["lng"],
                              F.element_at("pts", i)["lat"], F.element_at("pts", i)["lng"]) > min_km))
    return (g.where(pair_bad)
             .select(F.col(customer), *_bounds(), F.lit(None).cast("string").alias("detail"),
                     F.lit("geographical_impossibility").alias("fraud_reason")))


def amount_alerts(txns: DataFrame, averages: DataFrame, customer="customer_id", amount="amount",
                  factor: float = 10.0) -> DataFrame:
    """STR4 (+JOI5): stream-static join with per-customer averages; no state."""
    j = txns.join(averages, customer, "inner")
    return (j.where(F.col(amount) > F.col("avg_amount") * factor)
             .select(F.col(customer), F.lit(None).cast("timestamp").alias("start_time"),
                     F.lit(None).cast("timestamp").alias("end_time"),
                     F.col(amount).cast("string").alias("detail"), F.lit("amount_anomaly").alias("fraud_reason")))


def union_alerts(*branches: DataFrame) -> DataFrame:
    """STR5 / SET1: union by name; ``detail`` is text in every branch (D3)."""
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out


def metric_commission_by_type(txns: DataFrame, time_col="event_time", ctype="commission_type",
                              commission="commission_amount", watermark: str | None = METRIC_WATERMARK) -> DataFrame:
    """STR6: metric A, sliding sum of commission per commission type."""
    x = windowed(txns, ctype, {"total": F.sum(commission)}, WIN1, SLIDE1, time_col, watermark)
    return _metric(x, "total_commission_by_type", ctype, F.col("total").cast("double"))


def metric_commission_ratio(txns: DataFrame, time_col="event_time", category="merchant_category",
                            commission="commission_amount", amount="amount",
                            watermark: str | None = METRIC_WATERMARK) -> DataFrame:
    """STR7: metric B, sum(commission) / sum(amount) per category."""
    x = windowed(txns, category, {"commission": F.sum(commission), "amount": F.sum(amount)}, WIN1, SLIDE1, time_col, watermark)
    return _metric(x, "commission_ratio_by_category", category, F.try_divide(F.col("commission").cast("double"), F.col("amount")))


def metric_top_merchant(txns: DataFrame, time_col="event_time", merchant="merchant_id",
                        commission="commission_amount", watermark: str | None = METRIC_WATERMARK) -> DataFrame:
    """STR8 / WIN13: per sliding window the merchant with the largest commission
    total (ties -> larger id), via ``max_by`` instead of a re-join of the maximum.
    Two chained aggregations; in streaming this needs append mode."""
    df = _wm(txns, time_col, watermark)
    sums = (df.groupBy(F.window(time_col, WIN2, SLIDE2).alias("w"), F.col(merchant))
              .agg(F.sum(commission).alias("tot_comm")))
    top = sums.groupBy("w").agg(
        F.max_by(F.col(merchant), F.struct("tot_comm", merchant)).alias("top_merchant"),
        F.max("tot_comm").alias("value"))
    return top.select(*_bounds(), F.lit("highest_commission_merchant").alias("metric"),
                      F.col("top_merchant").cast("string").alias("dimension"),
                      F.col("value").cast("double").alias("value"))


def _geo_window_alerts_batch(txns: DataFrame, time_col, customer, id_col, lat, lng, window, max_seconds,
                             min_km) -> DataFrame:
    """Batch form of STR3: the previous event inside the same (customer,
    tumbling window) comes from ``lag`` over a sorted, spillable partition --
    no per-window array is built, so a hot customer never needs its window's
    events in memory at once."""
    from pyspark.sql import Window as W
    x = txns.withColumn("w", F.window(time_col, window))
    w = W.partitionBy(customer, "w").orderBy(time_col, id_col)
    us = F.unix_micros(F.col(time_col))
    x = (x.withColumn("__us", us).withColumn("__pus", F.lag(us).over(w))
          .withColumn("__plat", F.lag(lat).over(w)).withColumn("__plng", F.lag(lng).over(w)))
    hit = ((F.col("__us") - F.col("__pus") <= max_seconds * 1_000_000)
           & (haversine_atan2_km("__plat", "__plng", lat, lng) > min_km))
    flagged = x.where(F.col("__pus").isNotNull() & hit).select(customer, "w").distinct()
    return flagged.select(F.col(customer), *_bounds(), F.lit(None).cast("string").alias("detail"),
                          F.lit("geographical_impossibility").alias("fraud_reason"))
