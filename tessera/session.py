"""Session construction and cluster-shared helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults aimed at large inputs; local runs override shuffle partitions.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and UTC time zone."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only on a ``local`` master (tests, laptops) is a scratch folder made when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the shared checkpoint folder: as safe as ``cut_lineage`` and,
    for wide or repetitive rows, a fraction of its disk."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
