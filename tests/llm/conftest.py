import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with a clashing extra column."""
    def make(rows, extra=True, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        if extra:
            df = df.selectExpr("*", "'x' AS size", "1 AS key", "2 AS rate", "3 AS pos", "'y' AS ids")
        return df.repartition(partitions)
    return make


@pytest.fixture(scope="session")
def table_dir(tmp_path_factory):
    """Write frames as the tables of a new folder."""
    def make(**frames):
        d = tmp_path_factory.mktemp("tables")
        for name, df in frames.items():
            df.write.parquet(str(d / f"{name}.parquet"))
        return str(d)
    return make
