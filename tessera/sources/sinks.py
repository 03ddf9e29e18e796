"""Batch sinks (SNK3-SNK10).

All targets are folders on shared storage (the session's checkpoint folder
in tests); writes are whole-job commits, so a lost executor only retries tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage


def append_partitioned_by_date(df: DataFrame, path: str, ts: str = "ts", date_col: str = "date") -> None:
    """SNK3: add an ISO ``date`` key and append, partitioned by it."""
    df.withColumn(date_col, F.date_format(F.to_date(ts), "yyyy-MM-dd")).write.mode("append") \
      .partitionBy(date_col).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """SNK4 / SNK5 / SNK6 (replace): overwrite the whole target."""
    df.write.mode("overwrite").parquet(path)


def append_unique(df: DataFrame, path: str, key: list[str], existing: DataFrame | None) -> None:
    """SNK6 (append): refuse to append rows whose key is duplicated in the batch
    or already present in the target (the target has a primary key).

    ``existing`` is the target as read, or None for a new one.  Check and
    append are two steps: have one writer per target."""
    dup = df.groupBy(*key).count().where("count > 1").limit(1).count()
    clash = existing.join(df.select(*key), key, "left_semi").limit(1).count() if existing is not None else 0
    if dup or clash:
        raise ValueError(f"primary key {key} violated; nothing appended")
    df.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """SNK7: CSV with header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, head_rows: int = 6, tail_rows: int = 3, full_if_at_most: int = 20) -> DataFrame:
    """SNK8: the whole result when it has at most ``full_if_at_most`` rows, else
    the first ``head_rows`` and last ``tail_rows`` rows (by the frame's order),
    with the total row count on every row.  Only the preview rows reach the driver."""
    spark = df.sparkSession
    n = df.count()
    if n <= full_if_at_most:
        rows = list(enumerate(df.collect()))
    else:
        rows = list(enumerate(df.limit(head_rows).collect()))
        rows += [(n - tail_rows + i, r) for i, r in enumerate(df.tail(tail_rows))]
    schema = T.StructType([T.StructField("position", T.LongType())] + df.schema.fields)
    out = spark.createDataFrame([(i, *tuple(r)) for i, r in rows], schema)
    return out.withColumn("total_rows", F.lit(n))


def to_chart_frame(df: DataFrame, max_rows: int = 100_000):
    """SNK9: hand a small aggregated result to a plotting library (pandas).  ``max_rows`` is the
    chart's limit: a larger result raises an error, it is never cut."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError("result too large for a chart; aggregate further")
    return df.toPandas()


def apply_retention(df: DataFrame, path: str, ts: str, cutoff: str, date_col: str = "date") -> None:
    """SNK10: keep rows with ``ts >= cutoff`` in a table partitioned by ISO date.

    Only the boundary day is rewritten (dynamic partition overwrite); day
    folders wholly before the cutoff, and a boundary day without kept rows, are
    deleted; later days are untouched.  ``df`` is the table as read from
    ``path``.  The steps are not one transaction: run again after a failure."""
    spark = df.sparkSession
    cut = F.lit(cutoff).cast(df.schema[ts].dataType)
    cut_day = spark.range(1).select(F.date_format(F.to_date(cut), "yyyy-MM-dd")).first()[0]
    # the rows are read from the folder being rewritten: stage them first in
    # the shared checkpoint folder (reliable; survives executor loss)
    staged = cut_lineage(df.where((F.col(date_col) == cut_day) & (F.col(ts) >= cut)))
    empty = not staged.limit(1).count()
    if not empty:
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{date_col}="):
            day = name.split("=", 1)[1]
            if day < cut_day or day == cut_day and empty:  # nothing of a boundary day may be left
                fs.delete(st.getPath(), True)
