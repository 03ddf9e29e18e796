"""Helpers shared by the operators: Arrow batches in bounded slices, shared scratch folders."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir

#: Text handled at once inside a Python task; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def slices(batches: Iterator[pa.RecordBatch], text: int, limit: int = SLICE_BYTES, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that column ``text`` of a slice holds about ``limit`` bytes.  Of
    compressed texts column ``size`` tells the bytes before."""
    import pyarrow.compute as pc

    for b in batches:
        if (b.column(text).nbytes if size is None else pc.sum(b.column(size)).as_py() or 0) <= limit:
            if b.num_rows:
                yield b
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(text)) if size is None else b.column(size), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n
        yield b.slice(start)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str = "snappy") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    w = df.write.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(docs: DataFrame, *cols: str) -> DataFrame:
    """The named columns, whatever else (in any spelling) the input carries."""
    return docs.select(*[docs[c] for c in cols])


def whole_runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Batches sorted by integer column ``key`` as tables that hold every run of equal keys whole."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        cut = int(np.flatnonzero(k == k[-1])[0])
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)
