"""Operator 8: exact top-k by inner product with block-at-a-time pruning.

Vectors become integer rows and are cut into blocks of ``BLOCK`` rows of
consecutive range; a block is stored with its forward index (the rows' matrix)
and, per term (component), the largest and smallest value in it.  A query's
bound for a block is the sum over terms of the larger product of the query's
component with these two: no row of the block scores more.

Queries are taken in groups of ``GROUP``.  For each group a first pass over the
summaries finds every query's most promising block; its k-th best score there
is a floor under the query's final k-th score.  The second pass visits all
blocks: inside each task blocks are ordered by bound per query and scored
through their forward index until the bound falls below the k-th score so far
(a bound equal to it is still scored, for ties go to the smaller id).  Each task
ships k rows a query; Spark merges them.

Rows are ordered by their strongest component before they are cut into blocks, so
that blocks hold similar rows; this changes only how much is pruned.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; shorter vectors count as padded with zeros; an empty vector
scores 0 with all; repeated ids are separate candidates except that a query
never meets rows of its own id; rows with a null id take no part; scores are
exact while every product sum stays below 2**63 (else an OverflowError); extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, shared_path, stored

BLOCK = 512
GROUP = 2048
SCALE = 256


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id bigint, v array<double> of floor(SCALE * x)) of the rows that take part."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = only(vectors, id_col, vec_col).filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad)
    return v.select(F.col(id_col).cast("bigint").alias("id"), F.transform(x, lambda c: F.floor(c * SCALE).cast("double")).alias("v"))


def _matrix(rows: list, dims: int) -> np.ndarray:
    m = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        m[i, :len(r)] = r
    return m


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products (rows of ``a`` by rows of ``b``); doubles are exact below 2**53."""
    most = np.abs(a).sum(axis=1).max(initial=0) * np.abs(b).max(initial=0)
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    if np.abs(a).max(initial=0) < 2.0 ** 62 and np.abs(b).max(initial=0) < 2.0 ** 62:
        wide = np.array([[int(x) for x in r] for r in a], dtype=object) @ np.array([[int(x) for x in r] for r in b], dtype=object).T
        if wide.size == 0 or max(map(abs, wide.ravel())) < 2 ** 63:
            return wide.astype(np.int64)
    raise OverflowError("an inner product does not fit a bigint")


def blocks_of(vectors: DataFrame) -> DataFrame:
    """(ids binary, matrix binary, rows int, dims int, high, low binary) of each block."""
    strongest = F.array_position(F.transform("v", F.abs), F.array_max(F.transform("v", F.abs)))
    sign = F.coalesce(F.signum(F.get("v", strongest.cast("int") - 1)), F.lit(0.0))
    ordered = vectors.repartitionByRange(strongest, sign, "id").sortWithinPartitions(strongest, sign, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list = []

        def cut() -> pa.RecordBatch:
            dims = max(map(len, rows))
            m = _matrix(rows, dims)
            b = pa.RecordBatch.from_pydict({
                "ids": [np.array(ids, dtype=np.int64).tobytes()], "matrix": [m.tobytes()], "n": pa.array([len(ids)], pa.int32()),
                "dims": pa.array([dims], pa.int32()), "high": [m.max(axis=0).tobytes()], "low": [m.min(axis=0).tobytes()]})
            ids.clear()
            rows.clear()
            return b

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                rows.append(v)
                if len(ids) == BLOCK:
                    yield cut()
        if ids:
            yield cut()

    return ordered.mapInArrow(run, "ids binary, matrix binary, n int, dims int, high binary, low binary")


def _bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Queries x blocks: summed term maxima."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def _padded(raw: list[bytes], dims: int) -> np.ndarray:
    return _matrix([np.frombuffer(x) for x in raw], dims)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.lexsort((ids, -score))[:k]
    return ids[at], score[at]


def _search(batches: Iterator[pd.DataFrame], qid: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """Top k of the blocks of one task for every query."""
    top = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for _ in qid]
    kth = floor.copy()
    for b in batches:
        if not len(b):
            continue
        dims = max(q.shape[1], int(b["dims"].max()))
        qm = _matrix(list(q), dims)
        bound = _bounds(qm, _padded(list(b["high"]), dims), _padded(list(b["low"]), dims))
        slack = np.maximum(np.abs(bound) * 1e-9, 0.5)  # sums beyond 2**53 are rounded
        order = np.argsort(-bound, axis=1, kind="stable")
        mats = [np.frombuffer(m).reshape(n, d) for m, n, d in zip(b["matrix"], b["n"], b["dims"], strict=True)]
        ids = [np.frombuffer(x, dtype=np.int64) for x in b["ids"]]
        for step in range(len(b)):  # the step-th best block of every query
            at = order[:, step]
            live = np.flatnonzero(bound[np.arange(len(qid)), at] + slack[np.arange(len(qid)), at] >= kth)
            if not len(live):
                break
            for j in np.unique(at[live]):
                who = live[at[live] == j]
                score = _exact(qm[who], _matrix(list(mats[j]), dims))
                for row, i in enumerate(who.tolist()):
                    s = score[row]
                    ok = (s >= kth[i]) & (ids[j] != qid[i])
                    if ok.any():
                        top[i] = _best(np.concatenate([top[i][0], ids[j][ok]]), np.concatenate([top[i][1], s[ok]]), k)
                        if len(top[i][1]) == k:
                            kth[i] = max(kth[i], top[i][1][-1])
    n = [len(x) for x, _ in top]
    yield pd.DataFrame({"query_id": np.repeat(qid, n), "vec_id": np.concatenate([x for x, _ in top]),
                        "score": np.concatenate([s for _, s in top])})


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows for every row where ``is_query`` (on column ``id``)."""
    schema = "query_id bigint, vec_id bigint, score bigint"
    rows = stored(scaled(vectors, id_col, vec_col), "vectors")
    blocks = stored(blocks_of(rows), "vector-blocks")
    spark = vectors.sparkSession
    queries = rows.filter(is_query).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1)))
    groups = max(1, -(-queries.count() // GROUP))
    queries = stored(queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups))), "queries", ["part"])
    path = shared_path(spark, "top-k")
    for g in range(groups):
        # One group at a time: about GROUP rows, sent to every task; its results are written before the next.
        mine = queries.filter(F.col("part") == g).select("id", "v").toPandas().sort_values("id")
        if not len(mine):
            continue
        qid = mine["id"].to_numpy(dtype=np.int64)
        q = _matrix(list(mine["v"]), max(map(len, mine["v"])))
        shared = spark.sparkContext.broadcast((qid, q))
        floor = spark.sparkContext.broadcast(_floors(blocks, shared, k))

        def run(batches: Iterator[pd.DataFrame], shared=shared, floor=floor) -> Iterator[pd.DataFrame]:
            return _search(batches, *shared.value, floor.value, k)

        blocks.mapInPandas(run, schema).write.mode("append").parquet(path)
        shared.unpersist()
        floor.unpersist()
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    found = spark.read.schema(schema).parquet(path)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))), 1, k)
    return (found.groupBy("query_id").agg(best.alias("top")).select("query_id", F.posexplode("top"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.i").alias("vec_id"), (-F.col("col.s")).alias("score")))


def _floors(blocks: DataFrame, shared, k: int) -> np.ndarray:
    """Per query the k-th score in the block with the highest bound (-inf if that has fewer than k rows)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qid, q = shared.value
        top = np.full(len(qid), -np.inf)
        kth = np.full(len(qid), -np.inf)
        for b in batches:
            if not len(b):
                continue
            dims = max(q.shape[1], int(b["dims"].max()))
            qm = _matrix(list(q), dims)
            bound = _bounds(qm, _padded(list(b["high"]), dims), _padded(list(b["low"]), dims))
            best = bound.argmax(axis=1)
            for j in np.unique(best):
                who = np.flatnonzero((best == j) & (bound[np.arange(len(qid)), best] > top))
                if len(who):
                    r = b.iloc[int(j)]
                    m = np.frombuffer(r["matrix"]).reshape(r["n"], r["dims"])
                    score = _exact(qm[who], _matrix(list(m), dims)).astype(np.float64)
                    score[qid[who][:, None] == np.frombuffer(r["ids"], dtype=np.int64)[None, :]] = -np.inf
                    top[who] = bound[who, j]
                    if score.shape[1] >= k:
                        kth[who] = np.maximum(kth[who], -np.partition(-score, k - 1, axis=1)[:, k - 1])
        yield pd.DataFrame({"i": np.arange(len(qid)), "kth": kth})

    got = blocks.mapInPandas(run, "i bigint, kth double").groupBy("i").agg(F.max("kth").alias("kth")).toPandas()
    qid, _ = shared.value
    out = np.full(len(qid), -np.inf)
    out[got["i"].to_numpy(dtype=np.int64)] = got["kth"].to_numpy()
    return np.where(np.isfinite(out) & (np.abs(out) < 2.0 ** 53), out, -np.inf)
