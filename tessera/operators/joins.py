"""Join helpers and JOI operators.

No side carries a broadcast hint: Spark broadcasts a side whose measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` (AQE also at run time) and
shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def role_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, prefix: str,
              how: str = "left") -> DataFrame:
    """JOI1/JOI2: join one dimension in a named role; dimension columns get ``prefix``.

    Used twice with the same dimension (origin / destination roles).  Key
    names may differ on the two sides; collisions are avoided by the prefix.
    """
    right = dim.select([F.col(c).alias(prefix + c) for c in dim.columns])
    return fact.join(right, fact[fact_key] == right[prefix + dim_key], how)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """JOI9: child rows whose non-null foreign key has no parent row (anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return (child.where(F.col(child_key).isNotNull())
                 .join(p, F.col(child_key) == F.col("__pk"), "left_anti"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """JOI9: primary-key values that occur more than once (partial aggregate before shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
