"""Seeded, partition-independent splits and samples (SMP1-SMP6, SET3, SET4).

Row membership comes from a hash of a key and a seed, so it is stable under
repartitioning, retries and executor loss (``randomSplit`` is not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1_000_000


def hash64(key_cols, seed: int, method: str = "md5") -> Column:
    """Non-negative 60-bit hash of (seed, key...).

    ``md5`` (default) is portable: any SQL engine reproduces it from the
    first 15 hex digits of md5('seed|key|...'), so a split can be checked or
    recomputed outside Spark.  ``xxhash64`` is faster and Spark-only."""
    cols = [F.col(c) if isinstance(c, str) else c for c in key_cols]
    if method == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 60))
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _u(key_cols, seed: int, method: str = "md5") -> Column:
    """Uniform value in [0, 1) from the key hash."""
    return F.pmod(hash64(key_cols, seed, method), F.lit(BUCKETS)) / F.lit(float(BUCKETS))


def hash_split(df: DataFrame, key_cols: list[str], fractions: dict[str, float], seed: int = 42,
               out: str = "split", method: str = "md5") -> DataFrame:
    """SMP1 / SMP3: label each row with a split by cumulative fraction of the
    hashed key.  Hashing a group key (e.g. user id) keeps a group on one side."""
    u = _u(key_cols, seed, method)
    acc, expr = 0.0, None
    items = list(fractions.items())
    for name, f in items[:-1]:
        acc += f
        expr = F.when(u < acc, name) if expr is None else expr.when(u < acc, name)
    last = items[-1][0]
    expr = F.lit(last) if expr is None else expr.otherwise(last)
    return df.withColumn(out, expr)


def stratified_folds(df: DataFrame, label: str, key_cols: list[str], k: int = 5, seed: int = 42,
                     out: str = "fold", method: str = "md5") -> DataFrame:
    """SMP2: within each label, rows ordered by hash get folds 0..k-1 round robin.

    The position inside a label is a rank over (label, hash); labels are few,
    so the rank is computed per (label, hash bucket) plus bucket offsets to
    avoid one task per label."""
    from tessera.operators.sequence import keyed_positions
    x = df.withColumn("__h", hash64(key_cols, seed, method))
    # bucket = top bits of the 60-bit hash: 1024 slices per label
    x = keyed_positions(x, label, ["__h", *key_cols], F.floor(F.col("__h") / F.lit(float(1 << 50))), "__p")
    return x.withColumn(out, F.pmod(F.col("__p") - 1, F.lit(k)).cast("int")).drop("__h", "__p")


def chrono_split(df: DataFrame, order: list[str], cuts=(0.7, 0.8),
                 names=("train", "validation", "test"), out: str = "split") -> DataFrame:
    """SMP4: rows 1..floor(n*c1) -> first split, ..floor(n*c2) -> second, rest -> third."""
    from tessera.operators.sequence import dense_row_id
    n = df.count()
    cut1 = int(n * cuts[0])
    cut2 = int(n * cuts[1])
    x = dense_row_id(df, order, "__p")
    return x.withColumn(out, F.when(F.col("__p") <= cut1, names[0])
                              .when(F.col("__p") <= cut2, names[1]).otherwise(names[2])).drop("__p")


def hash_sample(df: DataFrame, key_cols: list[str], n: int, seed: int = 42, method: str = "md5") -> DataFrame:
    """SMP5: ``n`` rows with the smallest seeded hash (a reproducible random sample).
    Spark plans this as a per-partition top-n and a merge (TakeOrderedAndProject)."""
    return (df.withColumn("__h", hash64(key_cols, seed, method))
              .orderBy("__h", *key_cols).limit(n).drop("__h"))


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """SMP6 / SRT6: first ``n`` rows by a total order."""
    return df.orderBy(*order).limit(n)


def remove_ids(pool: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """SET3: pool minus chosen rows (anti join)."""
    return pool.join(chosen.select(key).distinct(), key, "left_anti")


def common_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """SET4: keys present in both."""
    return a.select(key).intersect(b.select(key))
