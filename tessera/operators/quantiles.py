"""Exact quantiles without holding a group's values in one task.

Spark's exact ``percentile`` / ``median`` keep a map of distinct values per
group and merge it in one task; for a hot group with many distinct values
that is one huge task.  Here the rows are counted by (group, value), so that
repeated values are added up before they are moved, and the counts are range
partitioned on (group, value): a hot group lies in as many partitions as it
needs, each of bounded size.  One small aggregate of row counts by (group,
partition) says in which partition each wanted rank lies; only those
partitions are ordered, and a running count reads the ranks off.  The number
of passes depends neither on the values nor on the number of groups.

Linear interpolation between the two neighbouring ranks gives pandas/NumPy
quantiles.  NULL and NaN values and rows with a NULL key are left out, as
pandas does.  Without ``by`` an empty input gives one row of NULLs, with
``by`` no row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def exact_quantiles(df: DataFrame, value: str, qs: list[float], by: list[str] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """One row per group with a column ``q<percent>`` (e.g. ``q50``) per quantile.

    ``partitions`` is the number of ranges (default: the session's shuffle
    partitions, coalesced by AQE)."""
    by = list(by or [])
    keys = by or ["__g"]
    x = df.select(*(by or [F.lit(0).alias("__g")]), F.col(value).cast("double").alias("__v"))
    x = x.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    for k in by:
        x = x.where(F.col(k).isNotNull())
    counted = x.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    ranged = counted.repartitionByRange(*([partitions] if partitions else []), *keys, "__v")
    # range bounds come from a sample: the partition numbers are fixed by writing them
    ranged = cut_lineage(ranged.withColumn("__p", F.spark_partition_id()))

    # at most one row per (group, range partition)
    sizes = ranged.groupBy(*keys, "__p").agg(F.sum("__c").alias("__s"))
    group = W.partitionBy(*keys)
    sizes = (sizes.withColumn("__n", F.sum("__s").over(group))
             .withColumn("__end", F.sum("__s").over(group.orderBy("__p").rowsBetween(W.unboundedPreceding, 0))))
    start = F.col("__end") - F.col("__s")
    ranks = []
    for i, q in enumerate(qs):
        pos = (F.col("__n") - 1) * F.lit(float(q))
        for side, rank in enumerate((F.floor(pos), F.ceil(pos))):
            ranks.append(F.struct(F.lit(i).alias("qi"), F.lit(side).alias("side"), (rank - start).alias("at"),
                                  (pos - F.floor(pos)).alias("frac")))
    wanted = (sizes.select(*keys, "__p", F.filter(F.array(*ranks), lambda r: (r["at"] >= 0) & (r["at"] < F.col("__s"))).alias("__r"))
              .where(F.size("__r") > 0))

    upto = F.sum("__c").over(W.partitionBy(*keys, "__p").orderBy("__v").rowsBetween(W.unboundedPreceding, 0))
    hits = ranged.join(wanted, [*keys, "__p"]).withColumn("__upto", upto)
    here = F.filter("__r", lambda r: (r["at"] < F.col("__upto")) & (r["at"] >= F.col("__upto") - F.col("__c")))
    hits = hits.select(*keys, "__v", F.explode(here).alias("__t"))

    out = []
    for i, q in enumerate(qs):
        lower, upper, frac = (F.max(F.when((F.col("__t.qi") == i) & (F.col("__t.side") == side), c))
                              for side, c in ((0, F.col("__v")), (1, F.col("__v")), (0, F.col("__t.frac"))))
        out.append(F.when(lower == upper, lower).otherwise(lower + (upper - lower) * frac).alias(f"q{_pct(q)}"))
    return hits.groupBy(*by).agg(*out)


def _pct(q: float) -> str:
    p = q * 100
    return str(int(p)) if math.isclose(p, round(p)) else str(p).replace(".", "_")
