"""Row-position windows without one-task-per-key (WIN1, WIN10, WIN12).

``keyed_positions`` numbers rows 1..n inside each key in a total order, in
two levels: a row number inside (key, bucket) -- a bucket is a coarse slice
of the order, e.g. a month -- plus the number of rows of the key in earlier
buckets, from a small (key, bucket) count table.  A hot key is spread over
its buckets; with no key the same gives a dense global row id without a
single-partition window.

``rolling_rows`` then computes frames of ``n`` rows by letting each row
contribute to the ``n`` positions whose frame contains it and aggregating
on the unique (key, position): no window spans a whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keyed_positions(df: DataFrame, key: str | None, order: list[str], bucket: Column,
                    out: str = "pos") -> DataFrame:
    keys = [key] if key else []
    x = df.withColumn("__bk", bucket)
    local = W.partitionBy(*keys, "__bk").orderBy(*order)
    x = x.withColumn("__rn", F.row_number().over(local))
    counts = x.groupBy(*keys, "__bk").agg(F.count(F.lit(1)).alias("__n"))
    # earlier buckets of the same key; this window runs over the small count table
    cw = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy("__bk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(cw), F.lit(0))).drop("__n")
    return (x.join(offsets, [*keys, "__bk"], "inner")
             .withColumn(out, (F.col("__off") + F.col("__rn")).cast("bigint"))
             .drop("__bk", "__rn", "__off"))


def rolling_rows(df: DataFrame, key: str | None, pos: str, value: Column, lo: int, hi: int,
                 out_sum: str = "__sum", out_cnt: str = "__cnt") -> DataFrame:
    """Sum and count of ``value`` over rows ``pos+lo .. pos+hi`` of the same key
    (``lo <= hi <= 0``).  Adds ``out_sum`` (NULL when the frame is empty) and
    ``out_cnt`` (rows in the frame)."""
    keys = [key] if key else []
    shifts = F.explode(F.sequence(F.lit(-hi), F.lit(-lo)))
    contrib = (df.select(*keys, F.col(pos).alias("__src"), value.alias("__v"))
                 .select(*keys, "__src", "__v", shifts.alias("__d"))
                 .select(*keys, (F.col("__src") + F.col("__d")).alias(pos), "__v"))
    agg = contrib.groupBy(*keys, pos).agg(F.sum("__v").alias(out_sum), F.count(F.lit(1)).alias(out_cnt))
    return (df.join(agg, [*keys, pos], "left")
              .withColumn(out_cnt, F.coalesce(F.col(out_cnt), F.lit(0)).cast("bigint")))


def rolling_mean(df: DataFrame, key: str | None, order: list[str], value: str, n_rows: int,
                 bucket: Column, out: str, min_rows: int = 1, exclude_current: bool = False,
                 null_as_zero: bool = True, materialize: bool = True) -> DataFrame:
    """WIN1 / WIN12: mean of the current row and ``n_rows - 1`` previous rows
    (or the ``n_rows`` previous rows with ``exclude_current``); NULL when fewer
    than ``min_rows`` rows are in the frame.

    The numbered rows feed both the contributions and the final join; with
    ``materialize`` they are written once to the shared checkpoint folder
    instead of being recomputed by each consumer."""
    from tessera.session import cut_lineage
    x = keyed_positions(df, key, order, bucket, "__pos")
    if materialize:
        x = cut_lineage(x)
    v = F.coalesce(F.col(value), F.lit(0.0)) if null_as_zero else F.col(value)
    lo, hi = (-n_rows, -1) if exclude_current else (-(n_rows - 1), 0)
    x = rolling_rows(x, key, "__pos", v.cast("double"), lo, hi)
    mean = F.when(F.col("__cnt") >= min_rows, F.col("__sum") / F.col("__cnt"))
    return x.withColumn(out, mean).drop("__pos", "__sum", "__cnt")


def dense_row_id(df: DataFrame, order: list[str], out: str = "row_id") -> DataFrame:
    """WIN10: 1..n over a total order.

    Rows are range-partitioned and sorted by the order columns, so tasks follow
    the data size; a row's number is its place in its partition plus the rows of
    earlier partitions (a table of one row per partition).  The sorted rows are
    written once, so that the numbers cannot change when a task is run again."""
    from tessera.session import cut_lineage
    x = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("__at", F.monotonically_increasing_id()))
    x = x.withColumn("__part", F.shiftright("__at", 33))
    counts = x.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    w = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (x.join(offsets, "__part").withColumn(out, (F.col("__off") + place).cast("bigint"))
             .drop("__part", "__at", "__off"))


def row_frame(df: DataFrame, order: str, lo: int, hi: int, value: str, out: str, by: list[str] | None = None,
              full: bool = True, decimals: int | None = None) -> DataFrame:
    """WIN2 / WIN3 / WIN12: mean of ``value`` over rows ``lo .. hi`` around each row (0 is the row
    itself), in the order of ``order``; NULL where the frame is not full, or with ``full=False``
    the mean of what there is.

    For series bounded by the calendar (one row per day and ``by``); long keyed
    tables use ``rolling_mean``."""
    w = W.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(lo, hi)
    mean = F.avg(value).over(w)
    mean = F.round(mean, decimals) if decimals is not None else mean
    return df.withColumn(out, F.when(F.count(F.lit(1)).over(w) == hi - lo + 1, mean) if full else mean)


def next_mid(df: DataFrame, order: str, high: str, low: str, out: str = "target", horizon: int = 1,
             by: list[str] | None = None) -> DataFrame:
    """WIN4: mean of ``high`` and ``low`` ``horizon`` rows ahead; rows without one are dropped."""
    w = W.partitionBy(*(by or [F.lit(0)])).orderBy(order)
    x = df.withColumn(out, (F.lead(high, horizon).over(w) + F.lead(low, horizon).over(w)) / 2)
    return x.where(F.col(out).isNotNull())


def lookback_sequences(df: DataFrame, order: str, features: list[str], target: str, length: int, horizon: int = 1,
                       by: list[str] | None = None, seq: str = "seq", out: str = "target") -> DataFrame:
    """WIN5: per row the ``length`` feature structs that end ``horizon`` rows before it (oldest first)
    and the row's own ``target``; rows without a full look-back are dropped.  ``by`` (e.g. a split)
    keeps sequences inside one group."""
    w = W.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(-(length + horizon - 1), -horizon)
    x = df.withColumn(seq, F.collect_list(F.struct(*features)).over(w))
    return x.where(F.size(seq) == length).withColumn(out, F.col(target))


def range_mean(df: DataFrame, key: str, day: str, value: str, days: int, out: str) -> DataFrame:
    """WIN1 (range form): mean of ``value`` over rows of the key in the last ``days`` days, the row's own
    day included.

    Rows are first reduced to (key, day) sums; every day then adds to the ``days`` days whose frame
    holds it, so no window spans a hot key."""
    d = df.groupBy(key, F.to_date(day).alias("__d")).agg(F.sum(value).alias("__s"), F.count(value).alias("__c"))
    spread = d.select(key, F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("__i"), "__d", "__s", "__c")
    frame = (spread.groupBy(key, F.date_add("__d", F.col("__i")).alias("__d"))
             .agg((F.sum("__s") / F.sum("__c")).alias(out)))
    return df.withColumn("__d", F.to_date(day)).join(frame, [key, "__d"], "left").drop("__d")


def running_sums(df: DataFrame, key: str | None, order: list, cols: list[str], suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``cols`` inside each key along ``order``.

    Rows are range-partitioned by key and order (so a hot key, or a narrow range
    of values, is spread over as many tasks as its rows need) and written once
    with their partition's number; sums run inside a partition, plus the key's
    totals in earlier partitions (one row per key and partition)."""
    from tessera.session import cut_lineage
    keys = [key] if key else []
    x = cut_lineage(df.repartitionByRange(*keys, *order).withColumn("__bk", F.spark_partition_id()))
    local = W.partitionBy(*keys, "__bk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    for c in cols:
        x = x.withColumn(c + suffix, F.sum(c).over(local))
    tot = x.groupBy(*keys, "__bk").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    cw = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy("__bk").rowsBetween(W.unboundedPreceding, -1)
    off = tot.select(*keys, "__bk", *[F.coalesce(F.sum(f"__t_{c}").over(cw), F.lit(0)).alias(f"__o_{c}") for c in cols])
    x = x.join(off, [*keys, "__bk"], "inner")
    for c in cols:
        x = x.withColumn(c + suffix, F.col(c + suffix) + F.col(f"__o_{c}")).drop(f"__o_{c}")
    return x.drop("__bk")
