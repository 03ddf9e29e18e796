"""Retrieval (RET1-RET5, JOI14, SCA28).

* Vector search is exact brute force, linear in the corpus: a block of
  queries goes to every task, which scores its rows with NumPy and keeps a
  running top-k per query; only those candidates are shuffled for the final
  top-k.  No pair table is built, and any number of queries is taken in blocks.
* Full-text search is BM25 over an index of one row per document plus document
  frequencies, scored the same way: inside document partitions, by blocks of
  queries.
* Hybrid search is reciprocal-rank fusion over a full outer join.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ensure_checkpoint_dir

RRF_K = 60          # fixed constant of reciprocal-rank fusion
BM25_K1, BM25_B = 1.2, 0.75


def topk_per_query(scores: DataFrame, query: str, item: str, score: str, k: int,
                   descending: bool = True, buckets: int = 64, out: str = "rank") -> DataFrame:
    """Top-k per query in two stages: top-k inside (query, item hash bucket),
    then top-k of those candidates -- a hot query never sorts its whole list."""
    o = F.col(score).desc() if descending else F.col(score).asc()
    b = F.pmod(F.xxhash64(F.col(item)), F.lit(buckets))
    first = (scores.withColumn("__b", b)
                   .withColumn("__r", F.row_number().over(W.partitionBy(query, "__b").orderBy(o, F.col(item))))
                   .where(F.col("__r") <= k).drop("__b", "__r"))
    return (first.withColumn(out, F.row_number().over(W.partitionBy(query).orderBy(o, F.col(item))))
                 .where(F.col(out) <= k))


#: Queries (or centroids) that one pass over the corpus carries to every task.
BLOCK = 2048
#: Corpus rows compared at once inside a task.
CHUNK = 1024


def in_blocks(df: DataFrame, id_col: str, *cols: str, block: int = BLOCK):
    """Rows of ``df`` as lists of about ``block`` rows, one after the other; however many
    there are, the driver holds one list."""
    x = cut_lineage(df.select(id_col, *cols))
    n = max(1, -(-x.count() // block))
    part = F.pmod(F.xxhash64(id_col), F.lit(n))
    for g in range(n):
        rows = (x if n == 1 else x.where(part == g)).collect()
        if rows:
            yield rows


def _all(parts: Iterator[tuple[DataFrame, Broadcast]], spark, schema) -> DataFrame:
    """The rows of all blocks.  A single block stays a plan; of several, each is written to the
    shared folder before the next is made, so that the driver holds one block at a time."""
    first = next(parts, None)
    if first is None:
        return spark.createDataFrame([], schema)
    second = next(parts, None)
    if second is None:
        return first[0]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/blocks-{uuid.uuid4().hex}"
    for df, sent in chain([first, second], parts):
        df.write.mode("append").parquet(path)
        sent.unpersist()
    return spark.read.schema(first[0].schema).parquet(path)


def _distances(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """L2 distances, rows of ``x`` by rows of ``m``."""
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (m * m).sum(1)[None, :] - 2.0 * x @ m.T, 0.0))


def _stack(col) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in col])


def vector_search(corpus: DataFrame, queries: DataFrame, id_col: str, vec_col: str, qid_col: str,
                  qvec_col: str, k: int = 5, block: int = BLOCK) -> DataFrame:
    """RET1 / JOI14: exact L2 top-k per query; ``similarity = 1 - distance``.

    One pass over the corpus per block of queries.  Every task keeps a running
    top-k per query over all its rows and ships that, so the shuffle holds
    queries x k rows per task."""
    spark = corpus.sparkSession
    id_type = corpus.schema[id_col].dataType.simpleString()
    q_type = queries.schema[qid_col].dataType.simpleString()
    schema = f"query_id {q_type}, {id_col} {id_type}, distance double"

    def search(rows):
        shared = spark.sparkContext.broadcast((np.array([r[0] for r in rows]), _stack(r[1] for r in rows)))

        def score(batches):
            ids_q, m = shared.value
            ids, dist = None, np.empty((len(ids_q), 0))
            for pdf in batches:
                for at in range(0, len(pdf), CHUNK):
                    part = pdf.iloc[at:at + CHUNK]
                    d = np.concatenate([dist, _distances(_stack(part[vec_col]), m).T], axis=1)
                    new = np.broadcast_to(part[id_col].to_numpy(), (len(ids_q), len(part)))
                    i = new if ids is None else np.concatenate([ids, new], axis=1)
                    # smallest distances, ties to the smaller id
                    best = np.stack([np.lexsort((i[q], d[q]))[:k] for q in range(len(ids_q))]) if d.shape[1] <= 4 * k else None
                    if best is None:
                        kk = np.argpartition(d, k - 1, axis=1)[:, :k]
                        cut = np.take_along_axis(d, kk, axis=1).max(axis=1)
                        best = np.stack([(c := np.flatnonzero(d[q] <= cut[q]))[np.lexsort((i[q][c], d[q][c]))[:k]] for q in range(len(ids_q))])
                    ids, dist = np.take_along_axis(i, best, axis=1), np.take_along_axis(d, best, axis=1)
            if ids is not None:
                yield pd.DataFrame({"query_id": np.repeat(ids_q, dist.shape[1]), id_col: ids.reshape(-1), "distance": dist.reshape(-1)})

        return corpus.select(id_col, vec_col).mapInPandas(score, schema), shared

    parts = (search(rows) for rows in in_blocks(queries, qid_col, qvec_col, block=block))
    top = topk_per_query(_all(parts, spark, schema), "query_id", id_col, "distance", k, descending=False)
    return top.withColumn("similarity", F.lit(1.0) - F.col("distance"))


def centroid_distances(corpus: DataFrame, centroids: DataFrame, id_col: str, vec_col: str, cid_col: str,
                       cvec_col: str, keep: list[str] | None = None, out_class: str = "cls") -> DataFrame:
    """L2 distance of every corpus vector to every centroid: N x C rows, for one-vs-rest
    scores of all classes (``nearest_centroid`` gives one row per vector)."""
    spark = corpus.sparkSession
    keep = keep or []
    schema = corpus.select(id_col, *keep).schema.add(out_class, centroids.schema[cid_col].dataType).add("dist", "double")

    def part(rows):
        shared = spark.sparkContext.broadcast((np.array([r[0] for r in rows]), _stack(r[1] for r in rows)))

        def run(batches):
            ids_c, m = shared.value
            for pdf in batches:
                for at in range(0, len(pdf), CHUNK):
                    x = pdf.iloc[at:at + CHUNK]
                    d = _distances(_stack(x[vec_col]), m)
                    out = {c: np.repeat(x[c].to_numpy(), d.shape[1]) for c in (id_col, *keep)}
                    out[out_class] = np.tile(ids_c, len(x))
                    out["dist"] = d.reshape(-1)
                    yield pd.DataFrame(out)

        return corpus.select(id_col, vec_col, *keep).mapInPandas(run, schema), shared

    return _all((part(rows) for rows in in_blocks(centroids, cid_col, cvec_col)), spark, schema)


def nearest_centroid(corpus: DataFrame, centroids: DataFrame, id_col: str, vec_col: str, cid_col: str, cvec_col: str,
                     keep: list[str] | None = None, out: str = "prediction") -> DataFrame:
    """The nearest centroid of every corpus vector (ties: smaller class), one row per vector and
    block of centroids in the shuffle."""
    spark = corpus.sparkSession
    keep = keep or []
    schema = corpus.select(id_col, *keep).schema.add(out, centroids.schema[cid_col].dataType).add("dist", "double")

    def part(rows):
        rows = sorted(rows, key=lambda r: r[0])
        shared = spark.sparkContext.broadcast((np.array([r[0] for r in rows]), _stack(r[1] for r in rows)))

        def run(batches):
            ids_c, m = shared.value
            for pdf in batches:
                for at in range(0, len(pdf), CHUNK):
                    x = pdf.iloc[at:at + CHUNK]
                    d = _distances(_stack(x[vec_col]), m)
                    best = d.argmin(axis=1)
                    yield pd.DataFrame({**{c: x[c].to_numpy() for c in (id_col, *keep)}, out: ids_c[best], "dist": d[np.arange(len(x)), best]})

        return corpus.select(id_col, vec_col, *keep).mapInPandas(run, schema), shared

    found = _all((part(rows) for rows in in_blocks(centroids, cid_col, cvec_col)), spark, schema)
    # the best of each block of centroids: one row a vector where there is one block
    return found.groupBy(id_col, *keep).agg(F.min_by(out, F.struct("dist", out)).alias(out), F.min("dist").alias("dist"))


def bm25_index(docs: DataFrame, id_col: str, tokens: str) -> tuple[DataFrame, DataFrame, dict]:
    """Index: one row per document (distinct terms with counts, length), document
    frequencies, and N and avgdl.  Each document's counts are made in its own
    row; only (term, 1) pre-aggregated per task is shuffled.  Both tables are
    written to the shared checkpoint folder: built once, then probed."""
    d = F.array_distinct(tokens)
    counted = docs.select(id_col, F.col(tokens), d.alias("__terms"), F.size(tokens).alias("doc_len"))
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        for pdf in batches:
            tf = []
            for toks, terms in zip(pdf[tokens], pdf["__terms"]):
                n: dict = {}
                for t in toks:
                    n[t] = n.get(t, 0) + 1
                tf.append([n[t] for t in terms])
            yield pd.DataFrame({id_col: pdf[id_col], "terms": pdf["__terms"], "tf": tf, "doc_len": pdf["doc_len"]})

    index = cut_lineage(counted.mapInPandas(count, f"{id_col} {kind}, terms array<string>, tf array<int>, doc_len int"))
    df_ = cut_lineage(index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    stats = index.agg(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("avgdl")).first()
    return index, df_, {"n": stats["n"], "avgdl": stats["avgdl"] or 1.0}


def bm25_search(index, queries: DataFrame, qid_col: str, qtokens: str, id_col: str, k: int = 5,
                k1: float = BM25_K1, b: float = BM25_B, block: int = BLOCK) -> DataFrame:
    """RET2: BM25 top-k per query (idf = ln(1 + (N - df + 0.5) / (df + 0.5))).

    One pass over the index per block of queries: the block's terms go to every
    task, which scores its own documents and keeps a running top-k per query;
    only queries x k rows per task are shuffled, however many documents share
    a term.  Documents that share no term with a query are no hits."""
    docs, dfreq, st = index
    spark = docs.sparkSession
    q_type = queries.schema[qid_col].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"query_id {q_type}, {id_col} {id_type}, score double"
    n, avgdl = float(st["n"]), float(st["avgdl"])

    def search(rows):
        qids = np.array([r[0] for r in rows])
        wanted = spark.createDataFrame([(t,) for t in {t for r in rows for t in r[1]}] or [("",)], "term string")
        df_of = dict(wanted.join(dfreq, "term").collect())
        who: dict[str, list[int]] = {}
        for i, r in enumerate(rows):
            for t in set(r[1]):
                if t in df_of:
                    who.setdefault(t, []).append(i)
        shared = spark.sparkContext.broadcast(
            (qids, {t: (np.array(i), math.log(1 + (n - df_of[t] + 0.5) / (df_of[t] + 0.5))) for t, i in who.items()}))

        def score(batches):
            ids_q, terms = shared.value
            best_id, best = [np.empty(0, dtype=object)] * len(ids_q), [np.empty(0)] * len(ids_q)
            for pdf in batches:
                for at in range(0, len(pdf), CHUNK):
                    x = pdf.iloc[at:at + CHUNK]
                    s = np.zeros((len(ids_q), len(x)))
                    hit = np.zeros((len(ids_q), len(x)), dtype=bool)
                    posts: dict[str, list] = {}
                    for j, (ts, tf, dl) in enumerate(zip(x["terms"], x["tf"], x["doc_len"])):
                        norm = k1 * (1.0 - b + b * dl / avgdl)
                        for t, f in zip(ts, tf):
                            if t in terms:
                                posts.setdefault(t, []).append((j, f * (k1 + 1.0) / (f + norm)))
                    for t, p in posts.items():
                        i, idf = terms[t]
                        j = np.array([c for c, _ in p])
                        s[i[:, None], j[None, :]] += idf * np.array([w for _, w in p])[None, :]
                        hit[i[:, None], j[None, :]] = True
                    s = np.round(s, 9)  # equal documents tie exactly whatever the summation order
                    ids = x[id_col].to_numpy()
                    for q in np.flatnonzero(hit.any(axis=1)).tolist():
                        c = np.flatnonzero(hit[q])
                        v, d = np.concatenate([best[q], s[q][c]]), np.concatenate([best_id[q], ids[c]])
                        o = np.lexsort((d.astype(ids.dtype), -v))[:k]
                        best[q], best_id[q] = v[o], d[o]
            size = [len(v) for v in best]
            if sum(size):
                yield pd.DataFrame({"query_id": np.repeat(ids_q, size), id_col: np.concatenate(best_id), "score": np.concatenate(best)})

        return docs.mapInPandas(score, schema), shared

    parts = (search(rows) for rows in in_blocks(queries, qid_col, qtokens, block=block))
    return topk_per_query(_all(parts, spark, schema), "query_id", id_col, "score", k)


def rrf_fuse(a: DataFrame, b: DataFrame, id_col: str, k: int = 5, c: int = RRF_K) -> DataFrame:
    """RET3: sum of 1 / (c + rank) over the two rankings (missing side adds 0)."""
    x = (a.select("query_id", id_col, F.col("rank").alias("rank_a"))
          .join(b.select("query_id", id_col, F.col("rank").alias("rank_b")), ["query_id", id_col], "full_outer"))
    contrib = (F.coalesce(F.lit(1.0) / (F.lit(c) + F.col("rank_a")), F.lit(0.0))
               + F.coalesce(F.lit(1.0) / (F.lit(c) + F.col("rank_b")), F.lit(0.0)))
    fused = x.withColumn("score", contrib)
    return topk_per_query(fused, "query_id", id_col, "score", k, out="fused_rank")


def token_overlap(q_tokens, d_tokens):
    """Default pair score: share of distinct query tokens present in the document."""
    qd = F.array_distinct(q_tokens)
    return F.when(F.size(qd) > 0, F.size(F.array_intersect(qd, F.array_distinct(d_tokens))) / F.size(qd))


def rerank(pairs: DataFrame, q_tokens: str, d_tokens: str, id_col: str, k: int = 5,
           scorer=None, q_text: str | None = None, d_text: str | None = None) -> DataFrame:
    """RET4: re-score the candidate pairs of each query and keep the new top-k.

    ``scorer`` (optional) is a user function ``(queries: Series, docs: Series)
    -> Series`` applied batch-wise through ``mapInPandas`` (e.g. a
    cross-encoder); the default is the native token-overlap score."""
    if scorer is None:
        scored = pairs.withColumn("rerank_score", token_overlap(F.col(q_tokens), F.col(d_tokens)))
    else:
        schema = pairs.schema.add("rerank_score", "double")

        def run(batches):
            for pdf in batches:
                pdf = pdf.copy()
                pdf["rerank_score"] = np.asarray(scorer(pdf[q_text], pdf[d_text]), dtype=float)
                yield pdf
        scored = pairs.mapInPandas(run, schema)
    return topk_per_query(scored, "query_id", id_col, "rerank_score", k, out="rerank_rank")


def ranking_metrics(ranked: DataFrame, relevant: DataFrame, id_col: str, k: int,
                    rank_col: str = "rank") -> DataFrame:
    """RET5: precision@k, recall@k and binary NDCG@k per query.

    ``relevant`` lists (query_id, id) pairs, or only ``id`` when relevance is
    the same for every query."""
    per_query = "query_id" in relevant.columns
    keys = ["query_id", id_col] if per_query else [id_col]
    r = relevant.select(*keys).distinct().withColumn("__rel", F.lit(1))
    top = ranked.where(F.col(rank_col) <= k).join(r, keys, "left").fillna(0, ["__rel"])
    n_rel = (r.groupBy("query_id").agg(F.count(F.lit(1)).alias("__nrel")) if per_query
             else r.agg(F.count(F.lit(1)).alias("__nrel")))
    g = top.groupBy("query_id").agg(
        F.sum("__rel").alias("__hits"),
        F.sum(F.col("__rel") / F.log2(F.col(rank_col) + 1)).alias("__dcg"))
    if per_query:
        g = g.join(n_rel, "query_id")
    else:  # one relevant-set size for all queries: a scalar, applied as a literal
        g = g.withColumn("__nrel", F.lit(n_rel.first()["__nrel"]))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("__nrel"), F.lit(k)).cast("int")), F.lit(0.0),
                        lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1))
    return g.select("query_id", (F.col("__hits") / F.lit(float(k))).alias("precision_at_k"),
                    F.when(F.col("__nrel") > 0, F.col("__hits") / F.col("__nrel")).alias("recall_at_k"),
                    F.when(F.col("__nrel") > 0, F.col("__dcg") / ideal).alias("ndcg_at_k"))
