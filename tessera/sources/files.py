"""File sources (SRC1, SRC5, SRC6, SRC7, SRC9, SRC10, SRC11).

Readers always take an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """SRC1: JSON lines with a fixed schema."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema, date_format: str | None = None) -> DataFrame:
    """SRC5: CSV with a header row; NaN text read as NULL."""
    r = spark.read.schema(schema).option("header", True).option("nanValue", "NaN").option("mode", "PERMISSIVE")
    if date_format:
        r = r.option("dateFormat", date_format)
    return r.csv(path)


def read_dated_csv(spark: SparkSession, path: str, schema, date_col: str, drop: list[str] = ("Unnamed: 0",),
                   date_format: str | None = None) -> DataFrame:
    """SRC6: CSV with a parsed date column, stray index column dropped, ordered by date."""
    return read_csv(spark, path, schema, date_format).drop(*drop).orderBy(date_col)


def read_nested_json(spark: SparkSession, path: str, schema, array_col: str, parent_cols: list[str],
                     multiline: bool = True) -> DataFrame:
    """SRC7: one row per element of ``array_col`` with the parent columns."""
    d = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return d.select(*parent_cols, F.explode(array_col).alias("__e")).select(*parent_cols, "__e.*")


def read_labelled_files(spark: SparkSession, root: str, label_pattern: str, glob: str = "*") -> DataFrame:
    """SRC9: binary files; label and split come from the path (``label_pattern``
    is a regex whose groups 1 and 2 are split and label)."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    return d.select("path", "length", "content", F.regexp_extract("path", label_pattern, 1).alias("split"),
                    F.regexp_extract("path", label_pattern, 2).alias("label"))


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """SRC10: rows per split of a dataset stored partitioned by split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("num_rows"))
