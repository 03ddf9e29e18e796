"""Null handling (NUL1-NUL5, FLT2, FLT9).

Fill statistics (median, mean) are single scalars: they are computed by one
distributed aggregate and applied as literals -- the way ``pyspark.ml``
``Imputer`` applies its surrogates -- never by a join of the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    """NUL1 / NUL4: per-column constant fill."""
    return df.na.fill(values)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """FLT2: ``dropna(subset)`` / ``dropna()``."""
    return df.na.drop(how="any", subset=subset)


def mask_invalid(c: str, invalid) -> F.Column:
    """FLT9: value -> NULL where ``invalid`` holds (e.g. negative lag, +-inf)."""
    return F.when(~invalid, F.col(c))


def exact_median(df: DataFrame, col: str) -> float | None:
    """Median with the midpoint of the two middle values for even counts (NUL3),
    by ranges of ordered values (``operators.quantiles``)."""
    from tessera.operators.quantiles import exact_quantiles
    row = exact_quantiles(df, col, [0.5]).first()
    return None if row is None or row["q50"] is None else float(row["q50"])


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """NUL3: fill NULLs with the exact median of each column, all columns in one run."""
    from tessera.operators.profiling import _long
    from tessera.operators.quantiles import exact_quantiles
    fills = exact_quantiles(_long(df, cols), "value", [0.5], ["column"]).collect()  # one row per column
    return df.na.fill({r["column"]: r["q50"] for r in fills})


def impute_cancelled_then_median(df: DataFrame, cols: list[str], cancelled: str) -> DataFrame:
    """NUL2: NULL -> -1 where cancelled, then the remaining NULLs -> median
    (median taken after the -1 fill, as in the reference)."""
    x = df.select(*[F.when((F.col(cancelled) == 1) & F.col(c).isNull(), F.lit(-1).cast(df.schema[c].dataType))
                     .otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
    return impute_median(x, cols)


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """NUL5: fill with the column mean."""
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return df.na.fill({c: row[c] for c in cols if row[c] is not None})
