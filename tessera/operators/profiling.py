"""Table profiles (SRC12, SRC13, AGG20, AGG21, AGG23, AGG25-AGG29, AGG31,
AGG33, AGG34, AGG36, AGG37).

Each profile is one aggregate pass over the table (all columns at once),
then an ``unpivot``/``stack`` of the single result row -- never a scan per
column in a Python loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _stack(row: DataFrame, names: list[str], fields: list[str], key: str = "column") -> DataFrame:
    """One wide row with ``<col>__<field>`` columns -> one row per column."""
    cols = [F.struct(F.lit(n).alias(key), *[F.col(f"`{n}__{f}`").alias(f) for f in fields]).alias("s")
            for n in names]
    return row.select(F.explode(F.array(*cols)).alias("s")).select("s.*")


def _long(df: DataFrame, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """(keys..., column, value) rows: one per input row and column."""
    keys = keys or []
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keys, F.explode(arr).alias("__s")).select(*keys, "__s.*")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG20: count, mean, std (sample), min, 25/50/75 % (exact, linear
    interpolation as pandas), max per numeric column."""
    from tessera.operators.quantiles import exact_quantiles
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    moments = _stack(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    qs = exact_quantiles(_long(df, cols), "value", [0.25, 0.5, 0.75], ["column"])
    qs = qs.select("column", F.col("q25").alias("p25"), F.col("q50").alias("p50"), F.col("q75").alias("p75"))
    return moments.join(qs, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def group_summary(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """AGG21 / AGG22: mean, std, count, median per group and column (long form)."""
    from tessera.operators.quantiles import exact_quantiles
    long = _long(df, cols, [group])
    mom = long.groupBy(group, "column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                            F.count("value").alias("count"))
    med = exact_quantiles(long, "value", [0.5], [group, "column"]).withColumnRenamed("q50", "median")
    return mom.join(med, [group, "column"], "left").select(group, "column", "mean", "std", "count", "median")


def null_counts(df: DataFrame, top: int | None = None) -> DataFrame:
    """AGG25: NULL count per column (NaN counts as missing for floats)."""
    def miss(c, t):
        e = F.col(f"`{c}`").isNull()
        if t in ("double", "float"):
            e = e | F.isnan(F.col(f"`{c}`"))
        return F.sum(e.cast("long")).alias(f"{c}__n_null")
    row = df.agg(*[miss(c, t) for c, t in df.dtypes])
    out = _stack(row, df.columns, ["n_null"])
    if top:
        out = out.orderBy(F.desc("n_null"), "column").limit(top)
    return out


def empty_text_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG26: share of NULL or blank values per text column."""
    row = df.agg(*[F.avg((F.trim(F.coalesce(F.col(c), F.lit(""))) == "").cast("double")).alias(f"{c}__empty_rate")
                   for c in cols])
    return _stack(row, cols, ["empty_rate"])


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG27: exact distinct values per column."""
    row = df.agg(*[F.countDistinct(c).alias(f"{c}__n_distinct") for c in cols])
    return _stack(row, cols, ["n_distinct"])


def outcome_rates(df: DataFrame, col: str) -> DataFrame:
    """AGG28: share of rows per value; the total is one scalar aggregate."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("rate", F.col("n") / F.lit(df.count()))


def length_stats(df: DataFrame, text: str, by: str | None = None) -> DataFrame:
    """AGG29 / SCA25 / TXT5: mean and median of word and character lengths."""
    from tessera.operators.quantiles import exact_quantiles
    words = F.size(F.split(F.trim(F.col(text)), r"\s+"))
    words = F.when(F.trim(F.col(text)) == "", 0).otherwise(words)
    keys = [by] if by else []
    x = df.select(*keys, words.alias("n_words"), F.length(text).alias("n_chars"))
    means = x.groupBy(*keys).agg(F.avg("n_words").alias("mean_words"), F.avg("n_chars").alias("mean_chars"))
    med = exact_quantiles(_long(x, ["n_words", "n_chars"], keys), "value", [0.5], keys + ["column"])
    wide = med.groupBy(*keys).agg(F.max(F.when(F.col("column") == "n_words", F.col("q50"))).alias("median_words"),
                                  F.max(F.when(F.col("column") == "n_chars", F.col("q50"))).alias("median_chars"))
    out = means.join(wide, keys) if keys else means.select(
        "*", *[F.lit(v).alias(k) for k, v in wide.first().asDict().items()])
    return out.select(*keys, "mean_words", "median_words", "mean_chars", "median_chars")


def first_per_key(df: DataFrame, keys: list[str], order_col: str, count_col: str | None = None) -> DataFrame:
    """AGG31: keep the row with the smallest ``order_col`` per key (deterministic
    ``drop_duplicates(subset)``); a partial aggregate, so a hot key is pre-reduced
    on every task before the shuffle.  ``count_col`` adds the group size from
    the same aggregate."""
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.min_by(F.struct(*rest), F.col(order_col)).alias("__r")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    picked = df.groupBy(*keys).agg(*aggs)
    return picked.select(*keys, "__r.*", *([count_col] if count_col else []))


def min_max(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG33."""
    row = df.agg(*[F.min(c).cast("double").alias(f"{c}__min") for c in cols],
                 *[F.max(c).cast("double").alias(f"{c}__max") for c in cols])
    return _stack(row, cols, ["min", "max"])


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """AGG34: quartiles (exact), IQR whiskers (1.5 IQR clipped to data) and outlier count per group."""
    from tessera.operators.quantiles import exact_quantiles
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], [group]).select(
        group, F.col("q25").alias("q1"), F.col("q50").alias("median"), F.col("q75").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = df.select(group, value).join(q, group)
    lo_f, hi_f = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col(value) >= lo_f) & (F.col(value) <= hi_f)
    return j.groupBy(group, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col(value))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).cast("double").alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """AGG37 / AGG23 / STT1: equal-width bins between min and max; the upper edge
    belongs to the last bin; ``density`` = count / (n * width).

    Per-group bounds are a small table joined on the group; global bounds are
    one aggregate applied as literals (no join)."""
    x = df.where(F.col(value).isNotNull())
    keys = [by] if by else []
    if by:
        mm = x.groupBy(by).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.count(F.lit(1)).alias("__n"))
        j = x.join(mm, by)   # one row per group; AQE broadcasts it when it is small
    else:
        r = x.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n")).first()
        j = x.select("*", F.lit(r["lo"]).alias("__lo"), F.lit(r["hi"]).alias("__hi"), F.lit(r["n"]).alias("__n"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), 0).otherwise(
        F.least(F.floor((F.col(value) - F.col("__lo")) / width), F.lit(bins - 1))).cast("int")
    g = j.groupBy(*keys, b.alias("bin"), "__lo", "__hi", "__n").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("__hi") - F.col("__lo")) / bins
    return g.select(*keys, "bin", (F.col("__lo") + F.col("bin") * w).alias("bin_low"),
                    (F.col("__lo") + (F.col("bin") + 1) * w).alias("bin_high"), "count",
                    F.when(w > 0, F.col("count") / (F.col("__n") * w)).alias("density"))


def category_table_sizes(df: DataFrame, cols: list[str], cap: int = 50) -> DataFrame:
    """AGG36: per encoded categorical column, vocabulary size ``max+1`` and
    embedding width ``min(cap, size // 2 + 1)``."""
    row = df.agg(*[F.max(c).alias(f"{c}__max") for c in cols])
    x = _stack(row, cols, ["max"])
    return (x.withColumn("n_levels", (F.col("max") + 1).cast("bigint"))
             .withColumn("embed_dim", F.least(F.lit(cap), F.floor(F.col("n_levels") / 2) + 1).cast("bigint"))
             .drop("max"))


def profile(df: DataFrame) -> DataFrame:
    """SRC13: shape, dtypes and non-null counts in one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"{c}__non_null")
                                                      for c in df.columns])
    cols = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                     F.col(f"`{c}__non_null`").alias("non_null")).alias("s") for c, t in df.dtypes]
    return row.select(F.col("__rows").alias("n_rows"), F.explode(F.array(*cols)).alias("s")).select("n_rows", "s.*")


def list_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """SRC12: the named tables / views of the current catalog with their columns and row counts.

    Only names that the catalog lists appear.  Counts are one aggregate per table."""
    listed = {t.name for t in spark.catalog.listTables()}
    out = None
    for name in [n for n in names if n in listed]:
        cols = [F.struct(F.lit(c.name).alias("column_name"), F.lit(c.dataType).alias("data_type"),
                         F.lit(i).alias("position")) for i, c in enumerate(spark.catalog.listColumns(name))]
        one = (spark.table(name).agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table_name"), "n_rows", F.explode(F.array(*cols)).alias("c")).select("table_name", "n_rows", "c.*"))
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame(
        [], "table_name STRING, n_rows BIGINT, column_name STRING, data_type STRING, position INT")
