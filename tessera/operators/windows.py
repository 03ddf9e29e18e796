"""Window operators (WIN*).

Per-key time windows are *skew-safe*: instead of ``partitionBy(key)`` (one
task for a key that may hold a third of all rows) rows are partitioned by
``(key, time bucket)``.  Each bucket also receives a *halo*: copies of the
previous bucket's rows that lie within the frame width of the bucket start.
Every frame of width ``<= bucket`` then sees exactly the rows it would see in
an unbucketed window, and a hot key is spread over as many tasks as it has
time buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.geo import haversine_atan2_km

US = 1_000_000


def epoch_us(ts) -> Column:
    """Microseconds since epoch for TIMESTAMP or TIMESTAMP_NTZ (session zone UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def with_time_halo(df: DataFrame, us_col: str, bucket_us: int, halo_us: int) -> DataFrame:
    """Add ``__b`` (bucket) and ``__halo`` (copy sent to the next bucket).

    One scan: every row is emitted for its own bucket, and rows in the last
    ``halo_us`` of a bucket are emitted a second time for the next bucket."""
    if halo_us > bucket_us:
        raise ValueError("halo wider than bucket")
    b = F.floor(F.col(us_col) / bucket_us)
    own = F.struct(b.alias("b"), F.lit(False).alias("h"))
    nxt = F.struct((b + 1).alias("b"), F.lit(True).alias("h"))
    in_tail = F.col(us_col) - b * bucket_us >= bucket_us - halo_us
    copies = F.when(in_tail, F.array(own, nxt)).otherwise(F.array(own))
    return (df.withColumn("__c", F.explode(copies))
              .withColumn("__b", F.col("__c.b")).withColumn("__halo", F.col("__c.h")).drop("__c"))


def rolling_time_count(df: DataFrame, key: str, ts: str, seconds: int = 300,
                       bucket_seconds: int = 3600, out: str = "rolling_count") -> DataFrame:
    """WIN6: per-key count of rows with time in ``[t - seconds, t]`` (closed; peers included)."""
    x = with_time_halo(df.withColumn("__us", epoch_us(ts)), "__us", bucket_seconds * US, seconds * US)
    w = W.partitionBy(key, "__b").orderBy("__us").rangeBetween(-seconds * US, 0)
    return (x.withColumn(out, F.count(F.lit(1)).over(w))
             .where(~F.col("__halo")).drop("__b", "__halo", "__us"))


def spike_flags(df: DataFrame, key="merchant_id", ts="ts", id_col="transaction_id",
                window_seconds: int = 300, factor: float = 3.0, horizon_hours: int = 1) -> DataFrame:
    """WIN7: rolling count vs an hourly baseline.

    baseline = (running count of the current hour + totals of the previous
    ``horizon_hours`` hours) / (horizon_hours + 1); spike when baseline > 0 and
    rolling > factor x baseline.  Hour counts come from a (key, hour) table,
    so no window spans more than one hour of one key.
    """
    x = rolling_time_count(df, key, ts, window_seconds)
    x = x.withColumn("__hour", F.date_trunc("hour", F.col(ts)))
    run = W.partitionBy(key, "__hour").orderBy(F.col(ts), F.col(id_col)).rowsBetween(W.unboundedPreceding, 0)
    x = x.withColumn("hour_count", F.count(F.lit(1)).over(run))
    hourly = x.groupBy(key, "__hour").agg(F.count(F.lit(1)).alias("__n"))
    # previous hours, joined by equality on (key, hour - h) for h = 1..horizon
    prev = None
    for h in range(1, horizon_hours + 1):
        shifted = hourly.select(F.col(key), (F.col("__hour") + F.expr(f"INTERVAL {h} HOURS")).alias("__hour"),
                                F.col("__n"))
        prev = shifted if prev is None else prev.unionByName(shifted)
    prev = prev.groupBy(key, "__hour").agg(F.sum("__n").alias("prev_hours_count"))
    x = x.join(prev, [key, "__hour"], "left").withColumn(
        "prev_hours_count", F.coalesce(F.col("prev_hours_count"), F.lit(0)).cast("bigint"))
    baseline = (F.col("hour_count") + F.col("prev_hours_count")) / F.lit(horizon_hours + 1)
    return (x.withColumn("baseline", baseline)
             .withColumn("is_spike", (F.col("baseline") > 0) & (F.col("rolling_count") > F.lit(factor) * F.col("baseline")))
             .drop("__hour"))


def consecutive_geo_jumps(df: DataFrame, key="customer_id", ts="ts", id_col="transaction_id",
                          lat="lat", lng="lng", max_seconds: int = 300, min_km: float = 50.0,
                          bucket_seconds: int = 3600) -> DataFrame:
    """WIN8 (batch): consecutive rows of a key (ordered by time, id) at most
    ``max_seconds`` apart and more than ``min_km`` apart in space.

    A pair more than ``max_seconds`` apart can never alert, so the previous
    row only has to be found inside a halo of that width: partitions are
    (key, time bucket), never a whole hot key.
    """
    x = with_time_halo(df.withColumn("__us", epoch_us(ts)), "__us", bucket_seconds * US, max_seconds * US)
    w = W.partitionBy(key, "__b").orderBy("__us", id_col)
    x = (x.withColumn("prev_id", F.lag(id_col).over(w))
          .withColumn("__pus", F.lag("__us").over(w))
          .withColumn("__plat", F.lag(lat).over(w))
          .withColumn("__plng", F.lag(lng).over(w))
          .where(~F.col("__halo") & F.col("prev_id").isNotNull()))
    x = (x.withColumn("seconds_apart", (F.col("__us") - F.col("__pus")) / US)
          .withColumn("distance_km", haversine_atan2_km("__plat", "__plng", lat, lng)))
    return (x.where((F.col("seconds_apart") <= max_seconds) & (F.col("distance_km") > min_km))
             .select(key, id_col, F.col("prev_id").alias("prev_" + id_col), "seconds_apart", "distance_km"))
