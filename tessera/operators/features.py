"""Feature transforms (FEA1-FEA6, FEA8, PRJ7, PRJ8, PRJ10, PRJ11).

Fit functions return small statistic tables (one row, or one row per
category level); apply functions join or inline them.  Fits are distributed
aggregates; level tables are bounded by the number of distinct levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def fit_standard(train: DataFrame, cols: list[str]) -> dict:
    """FEA1 / FEA2: mean and **population** std per column (std 0 -> scale 1)."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols}


def apply_standard(df: DataFrame, stats: dict, suffix: str = "") -> DataFrame:
    for c, (m, s) in stats.items():
        df = df.withColumn(c + suffix, (F.col(c) - F.lit(m)) / F.lit(s))
    return df


def inverse_standard(df: DataFrame, stats: dict, cols: dict) -> DataFrame:
    """FEA2: scaled column -> original units; ``cols`` maps scaled name -> stats key."""
    for out, c in cols.items():
        m, s = stats[c]
        df = df.withColumn(out, F.col(out) * F.lit(s) + F.lit(m))
    return df


def fit_minmax(train: DataFrame, cols: list[str]) -> dict:
    """FEA3: min and max per column."""
    row = train.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def apply_minmax(df: DataFrame, stats: dict, suffix: str = "") -> DataFrame:
    for c, (lo, hi) in stats.items():
        rng = (hi - lo) if hi is not None and lo is not None and hi != lo else 1.0
        df = df.withColumn(c + suffix, (F.col(c) - F.lit(lo)) / F.lit(rng))
    return df


def inverse_minmax(df: DataFrame, stats: dict, cols: dict) -> DataFrame:
    for out, c in cols.items():
        lo, hi = stats[c]
        df = df.withColumn(out, F.col(out) * F.lit((hi - lo) if hi != lo else 1.0) + F.lit(lo))
    return df


def fit_ordinal(train: DataFrame, col: str) -> DataFrame:
    """FEA4 / FEA5: level table ``(col, code)``: levels sorted as text, codes 0..k-1.

    The table has one row per distinct level; it can be written as Parquet
    and re-read to apply the same encoding later (FEA5 persistence)."""
    from tessera.operators.sequence import dense_row_id
    levels = train.select(F.col(col).cast("string").alias(col)).where(F.col(col).isNotNull()).distinct()
    coded = dense_row_id(levels, [col], "__rid")  # range partitions, no single task sorts every level
    return coded.select(col, (F.col("__rid") - 1).cast("int").alias("code"))


def apply_ordinal(df: DataFrame, levels: DataFrame, col: str, out: str | None = None,
                  unknown: int = -1) -> DataFrame:
    """Unknown (and NULL) levels -> ``unknown``."""
    out = out or f"{col}_code"
    lv = levels.select(F.col(col).alias("__lvl"), F.col("code").alias(out))
    # the level table is computed: AQE broadcasts it at run time when it is small
    j = df.join(lv, F.col(col).cast("string") == F.col("__lvl"), "left").drop("__lvl")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(unknown)))


def fit_levels(train: DataFrame, col: str, max_levels: int = 1000) -> list:
    """FEA6 fit: the sorted levels of a column.  Each becomes a column, so more than
    ``max_levels`` raise an error; none is left out."""
    got = train.where(F.col(col).isNotNull()).select(col).distinct().limit(max_levels + 1).collect()
    if len(got) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    return sorted(r[0] for r in got)


def one_hot(df: DataFrame, col: str, levels: list, prefix: str | None = None) -> DataFrame:
    """FEA6: one 0/1 column per level fixed at fit time (``get_dummies``)."""
    prefix = prefix or f"{col}_"
    return df.select("*", *[(F.col(col) == F.lit(v)).cast("int").alias(f"{prefix}{v}") for v in levels])


def rename_with_prefix(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    """PRJ7: prefix every column except ``keep``."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def drop_if_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ8: ``drop(errors='ignore')`` -- absent names are ignored."""
    return df.drop(*cols)


def downcast_by_prefix(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """PRJ10: cast columns whose name starts with a prefix (e.g. ``num__`` -> float)."""
    out = []
    for c in df.columns:
        t = next((t for p, t in rules.items() if c.startswith(p)), None)
        out.append(F.col(c).cast(t).alias(c) if t else F.col(c))
    return df.select(out)


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def columns_of_kind(df: DataFrame, kind: str = "numeric") -> list[str]:
    """PRJ11: ``select_dtypes``; kind in numeric / string / temporal."""
    kinds = {"numeric": NUMERIC, "string": (T.StringType,),
             "temporal": (T.DateType, T.TimestampType, T.TimestampNTZType)}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
