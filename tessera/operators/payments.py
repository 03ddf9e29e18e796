"""Payment reports: AGG1-AGG15, FLT5, FLT6, SRT3 over a transactions frame.

Column names are parameters with the reference's names as defaults.  All
aggregates are plain ``groupBy().agg()``: Spark runs a partial (map-side)
aggregate before the shuffle, so a hot category or customer costs one row per
task, not one task for its whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import fees
from tessera.functions.timeparts import hour_of, minute_bucket, weekday_name


def commission_by_category(df: DataFrame, category="merchant_category",
                           commission="commission_amount", total="total_amount") -> DataFrame:
    """AGG1: sum, avg, count and mean of per-row commission/total ratios."""
    return df.groupBy(category).agg(
        F.sum(commission).alias("total_commission"),
        F.avg(commission).alias("avg_commission"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg(F.try_divide(F.col(commission), F.col(total))).alias("avg_commission_ratio"),
    )


def commission_what_if(df: DataFrame, category="merchant_category", amount="amount",
                       commission="commission_amount") -> DataFrame:
    """AGG2 + SCA1: actual commission against the flat / progressive / tiered models."""
    return df.groupBy(category).agg(
        F.sum(commission).alias("actual_total_commission"),
        F.sum(fees.flat_commission(amount)).alias("sim_flat_total"),
        F.sum(fees.progressive_commission(amount)).alias("sim_progressive_total"),
        F.sum(fees.tiered_commission(amount)).alias("sim_tiered_total"),
    )


def method_statistics(df: DataFrame, method="payment_method", amount="amount") -> DataFrame:
    """AGG3: count, sum, mean and sample standard deviation per payment method."""
    return df.groupBy(method).agg(
        F.count(F.lit(1)).alias("num_transactions"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
        F.stddev_samp(amount).alias("stddev_amount"),
    )


def hourly_counts(df: DataFrame, ts="ts") -> DataFrame:
    """AGG4: transactions per hour of day."""
    return df.groupBy(hour_of(ts).alias("hour")).agg(F.count(F.lit(1)).alias("transaction_count"))


def weekday_counts(df: DataFrame, ts="ts") -> DataFrame:
    """AGG4: transactions per weekday name."""
    return df.groupBy(weekday_name(ts).alias("day_of_week")).agg(F.count(F.lit(1)).alias("transaction_count"))


def customer_segments(df: DataFrame, customer="customer_id", amount="amount") -> DataFrame:
    """AGG5 + SCA5: per-customer count/sum/avg and segment label."""
    stats = df.groupBy(customer).agg(
        F.count(F.lit(1)).alias("num_transactions"),
        F.sum(amount).alias("total_spent"),
        F.avg(amount).alias("avg_spent"),
    )
    return stats.withColumn("segment", fees.customer_segment("num_transactions", "total_spent"))


def top_n(df: DataFrame, n: int, by: str, tie: str, ascending=False) -> DataFrame:
    """SRT3: top-n with a key tie-break (Spark plans TakeOrderedAndProject: per-partition top-n, then merge)."""
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(o, F.col(tie).asc()).limit(n)


def category_comparison(df: DataFrame, category="merchant_category", amount="amount",
                        risk="risk_level") -> DataFrame:
    """AGG6."""
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("num_transactions"),
        F.avg(amount).alias("avg_amount"),
        F.sum(amount).alias("total_amount"),
        F.avg(risk).alias("avg_risk_level"),
    )


def day_part_statistics(df: DataFrame, ts="ts", amount="amount") -> DataFrame:
    """AGG7 + SCA6."""
    return (df.groupBy(fees.day_part(hour_of(ts)).alias("day_part"))
              .agg(F.count(F.lit(1)).alias("num_transactions"), F.avg(amount).alias("avg_amount")))


def daily_trend(df: DataFrame, ts="ts", amount="amount") -> DataFrame:
    """AGG8."""
    return (df.groupBy(F.to_date(ts).alias("date"))
              .agg(F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("transaction_count"),
                   F.avg(amount).alias("avg_amount")))


def merchant_daily_summary(df: DataFrame, merchant="merchant_id", ts="ts", amount="amount",
                           commission="commission_amount") -> DataFrame:
    """AGG9: merchant x day totals (the pre-aggregated table of SNK4)."""
    return (df.groupBy(merchant, F.date_format(F.to_date(ts), "yyyy-MM-dd").alias("date"))
              .agg(F.sum(commission).alias("total_commission"),
                   F.count(F.lit(1)).alias("transaction_count"),
                   F.sum(amount).alias("total_amount")))


def hourly_volume(df: DataFrame, ts="ts", id_col="transaction_id") -> DataFrame:
    """AGG10: tumbling one-hour windows; window bounds kept."""
    return (df.groupBy(F.window(ts, "1 hour").alias("w"))
              .agg(F.count(id_col).alias("transaction_count"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "transaction_count"))


def minute_volume(df: DataFrame, ts="ts") -> DataFrame:
    """AGG11."""
    return df.groupBy(minute_bucket(ts).alias("minute")).agg(F.count(F.lit(1)).alias("transaction_count"))


def count_per(df: DataFrame, key: str) -> DataFrame:
    """AGG12 / AGG24: rows per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("transaction_count"))


def category_hour_histogram(df: DataFrame, category="merchant_category", ts="ts") -> DataFrame:
    """AGG13: category x hour counts, zero-filled to 24 hour columns.

    The pivot values are given, so Spark needs no extra distinct pass and
    every hour column exists even when no row falls in it.
    """
    wide = df.withColumn("h", hour_of(ts)).groupBy(category).pivot("h", list(range(24))).count()
    wide = wide.na.fill(0)
    return wide.select(category, *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def fee_audit(df: DataFrame, amount="amount", category="merchant_category",
              customer_type="customer_type", commission="commission_amount") -> DataFrame:
    """AGG14 + SCA2/SCA3/SCA4: recommended fee type, simulated fee, gain.

    The grand-total improvement is a window over the (at most three-row)
    per-type summary, so no driver ``collect`` is needed.
    """
    rec = fees.recommend_commission(amount, category, customer_type)
    x = (df.withColumn("recommended_type", rec)
           .withColumn("sim_fee", fees.simulate_fee(amount, "recommended_type"))
           .withColumn("fee_gain", F.col("sim_fee") - F.col(commission)))
    summary = x.groupBy("recommended_type").agg(
        F.avg("fee_gain").alias("avg_gain"),
        F.sum("sim_fee").alias("total_simulated"),
        F.sum(commission).alias("total_actual"),
    )
    whole = W.partitionBy(F.lit(0))
    return summary.withColumn(
        "improvement_pct",
        F.try_divide(F.sum("total_simulated").over(whole) - F.sum("total_actual").over(whole),
                     F.sum("total_actual").over(whole)) * 100)


def customer_average(df: DataFrame, customer="customer_id", amount="amount") -> DataFrame:
    """AGG15."""
    return df.groupBy(customer).agg(F.avg(amount).alias("avg_amount"))


def amount_anomalies(txns: DataFrame, history: DataFrame, customer="customer_id", amount="amount",
                     factor: float = 10.0) -> DataFrame:
    """JOI5 + FLT5: ``amount > factor * historic average``; unknown customers never alert.

    The per-customer averages are a computed table: AQE measures it at run
    time and broadcasts it only when it is small (otherwise a shuffle join on
    ``customer``), so the size check costs no extra pass.
    """
    avg_df = customer_average(history, customer, amount)
    j = txns.join(avg_df, customer, "left")
    return j.where(F.col("avg_amount").isNotNull() & (F.col(amount) > F.col("avg_amount") * factor))


# ---- fixed opening hours per category (reference values; close < open wraps midnight)
BUSINESS_HOURS = (
    ("retail", 8, 22),
    ("food_service", 7, 1),
    ("entertainment", 10, 2),
    ("transportation", 0, 24),
    ("government", 8, 17),
)
DEFAULT_HOURS = (8, 20)


def out_of_hours(df: DataFrame, category="merchant_category", ts="ts", hours=BUSINESS_HOURS,
                 default=DEFAULT_HOURS) -> DataFrame:
    """FLT6: flag rows outside the category's opening hours.

    The hours table is a literal of a handful of rows, so it is inlined as a
    ``CASE`` (no join at all).
    """
    h = hour_of(ts)
    open_h = close_h = None
    for cat, o, c in hours:
        cond = F.col(category) == cat
        open_h = F.when(cond, o) if open_h is None else open_h.when(cond, o)
        close_h = F.when(cond, c) if close_h is None else close_h.when(cond, c)
    open_h, close_h = open_h.otherwise(default[0]), close_h.otherwise(default[1])
    in_hours = F.when(open_h < close_h, (h >= open_h) & (h < close_h)).otherwise((h >= open_h) | (h < close_h))
    return df.withColumn("hour", h).withColumn("out_of_hours", ~in_hours)
