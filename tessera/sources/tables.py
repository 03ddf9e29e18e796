"""SRC8: whole-table scans of the Parquet test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; raises (instead of returning an empty frame) when absent."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES, prefix: str = "") -> None:
    for n in names:
        load_table(spark, sf_dir, n).createOrReplaceTempView(prefix + n)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin a scan into ``partitions`` before CPU-heavy per-row work (regex
    text cleaning, JSON parsing, embeddings); None leaves it as it is.

    For inputs in a few large row groups, which Spark cannot split; the caller
    decides, the plan does not depend on the data."""
    return df.repartition(partitions) if partitions else df


def cores(spark: SparkSession, factor: int = 2) -> int:
    """Tasks that keep the cluster busy: the caller's choice for ``spread`` on the one-file test tables."""
    return spark.sparkContext.defaultParallelism * factor
