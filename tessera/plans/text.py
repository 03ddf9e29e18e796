"""Text and retrieval queries over documents, benchmark, conversations, embeddings, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import inverted_index
from tessera.operators import retrieval as rt
from tessera.operators import text as tops
from tessera.plans.registry import query
from tessera.session import cut_lineage
from tessera.sources.tables import cores, load_table, spread


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def simple_tokens(c):
    """Retrieval tokenizer: punctuation removed, lower-cased, whitespace split, stop words dropped."""
    return tx.remove_stop_words(tx.tokenize(tx.remove_punctuation(c)))


_SW_SQL = "[" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + "]"
_PUNCT_SQL = tx.PUNCT_CLASS.replace("'", "''")


def _tok_sql(col: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower(regexp_replace({col}, '{_PUNCT_SQL}', '', 'g')), '\\s+'), "
            f"lambda t: t <> '' AND NOT list_contains({_SW_SQL}, t))")


@query("txt1_clean_tokens", covers="TXT1 TXT2 SCA26 FLT7 UDF5")
def txt1(spark, sf):
    d = spread(load_table(spark, sf, "documents"), cores(spark))
    x = tops.clean_tokens(d, "text")
    return x.select("doc_id", "lang", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("clean_text"),
                    F.col("text").rlike("[كي]").alias("has_arabic_forms"))


@query("txt1_token_counts_by_lang", covers="TXT1 SCA25", sql=f"""
SELECT lang, count(*) AS n_docs, CAST(sum(len({_tok_sql('text')})) AS BIGINT) AS n_tokens FROM documents GROUP BY 1""")
def txt1c(spark, sf):
    d = spread(load_table(spark, sf, "documents"), cores(spark)).withColumn("tokens", simple_tokens("text"))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("tokens")).alias("n_tokens"))


@query("txt3_word_frequency_top20_skip3", covers="TXT3 AGG24 SRT3", sql=f"""
WITH t AS (SELECT unnest({_tok_sql('text')}) AS token FROM documents),
c AS (SELECT token, count(*) AS count FROM t GROUP BY 1 ORDER BY count DESC, token LIMIT 20),
r AS (SELECT token, count, row_number() OVER (ORDER BY count DESC, token) AS rank FROM c)
SELECT token, count, CAST(rank AS INTEGER) AS rank FROM r WHERE rank > 3""")
def txt3(spark, sf):
    d = spread(load_table(spark, sf, "documents"), cores(spark)).withColumn("tokens", simple_tokens("text"))
    return tops.word_frequency(d, "tokens", 20, 3)


@query("txt4_ngram_top", covers="TXT4", sql=f"""
WITH d AS (SELECT doc_id, {_tok_sql('text')} AS tk FROM documents),
g AS (""" + "\nUNION ALL ".join(f"""
  SELECT {n} AS n, array_to_string(tk[i:i + {n - 1}], ' ') AS ngram
  FROM (SELECT tk, unnest(range(1, len(tk) - {n - 1} + 1)) AS i FROM d WHERE len(tk) >= {n})""" for n in (1, 2, 3)) + """),
c AS (SELECT n, ngram, count(*) AS count FROM g GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY count DESC, ngram) AS rk FROM c)
SELECT ngram, count, CAST(n AS INTEGER) AS n FROM r WHERE rk <= CASE n WHEN 3 THEN 15 ELSE 20 END""")
def txt4(spark, sf):
    d = spread(load_table(spark, sf, "documents"), cores(spark)).withColumn("tokens", simple_tokens("text"))
    out = tops.ngram_frequencies(d, "tokens", {1: 20, 2: 20, 3: 15})
    return out.select("ngram", "count", F.col("n").cast("int").alias("n"))


def _centroids(spark, sf):
    e = load_table(spark, sf, "embeddings")
    ex = e.select("label", F.posexplode("embedding").alias("i", "v"))
    c = ex.groupBy("label", "i").agg(F.avg("v").alias("v"))
    return (c.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("s"))
             .select(F.col("label").alias("query_id"), F.transform("s", lambda s: s["v"]).alias("qvec")))


_CENTROID_SQL = """
c AS (SELECT label AS query_id, list(v ORDER BY i) AS qvec FROM (
        SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v
        FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1)"""


# lemma table: each word of the documents that ends in "ing" or "tion" maps to what is left of it
@query("txt1_lemma_step", covers="TXT1", sql=f"""
SELECT doc_id, len(tk) AS n_tokens, md5(array_to_string(list_transform(tk, lambda t:
         CASE WHEN len(t) > 5 THEN regexp_replace(t, '(ing|tion)$', '') ELSE t END), ' ')) AS tokens_md5
FROM (SELECT doc_id, {_tok_sql('text')} AS tk FROM documents)""")
def txt1l(spark, sf):
    d = spread(load_table(spark, sf, "documents"), cores(spark)).select("doc_id", simple_tokens("text").alias("tokens"))
    words = d.select(F.explode("tokens").alias("word")).distinct().where((F.length("word") > 5) & F.col("word").rlike("(ing|tion)$"))
    lemmas = words.withColumn("lemma", F.regexp_replace("word", "(ing|tion)$", ""))
    out = tops.map_tokens_by_table(d, "doc_id", "tokens", lemmas)
    return out.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.md5(F.array_join("tokens", " ").cast("binary")).alias("tokens_md5"))


@query("ret1_vector_top5_centroids", covers="RET1 JOI14 SCA28", sql=f"""
WITH {_CENTROID_SQL.strip()},
d AS (SELECT c.query_id, e.vec_id,
             sqrt(list_sum(list_transform(range(1, 65), lambda i: pow(CAST(e.embedding[i] AS DOUBLE) - c.qvec[i], 2)))) AS distance
      FROM embeddings e, c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(distance, 5) AS distance,
       round(1 - distance, 5) AS similarity FROM r WHERE rank <= 5""")
def ret1(spark, sf):
    e = load_table(spark, sf, "embeddings")
    top = rt.vector_search(e, _centroids(spark, sf), "vec_id", "embedding", "query_id", "qvec", k=5)
    return top.select("query_id", "vec_id", "rank", _r("distance", 5), _r("similarity", 5))


_INDEXES: dict = {}


def _index(spark, sf):
    """The index of the documents, built once per session and state of the table's files."""
    files = load_table(spark, sf, "documents").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    state = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, sf, *state)
    if key not in _INDEXES:
        d = spread(load_table(spark, sf, "documents"), cores(spark)).select("doc_id", simple_tokens("text").alias("tokens"))
        _INDEXES[key] = inverted_index.build(d, "doc_id", "tokens")
    return _INDEXES[key]


def _text_queries(spark, sf):
    return load_table(spark, sf, "benchmark").select("item_id", simple_tokens("text").alias("qtokens"))


def _bm25(spark, sf, k=5):
    return inverted_index.search(_index(spark, sf), _text_queries(spark, sf), "item_id", "qtokens", k=k)


_BM25_SQL = f"""
dt AS (SELECT doc_id, {_tok_sql('text')} AS tk FROM documents),
st AS (SELECT count(*) AS n, avg(len(tk)) AS avgdl FROM dt),
tf AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM (
         SELECT doc_id, unnest(tk) AS term, len(tk) AS dl FROM dt) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
qt AS (SELECT DISTINCT item_id AS query_id, unnest({_tok_sql('text')}) AS term FROM benchmark),
s AS (SELECT qt.query_id, tf.doc_id,
             round(sum(ln(1 + (st.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
                 / (tf.tf + 1.2 * (0.25 + 0.75 * tf.dl / st.avgdl))), 9) AS score
      FROM qt JOIN df USING (term) JOIN tf USING (term), st GROUP BY 1, 2),
bm AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)"""


@query("ret2_bm25_top5", covers="RET2", sql=f"""
WITH {_BM25_SQL.strip()}
SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM bm WHERE rank <= 5""")
def ret2(spark, sf):
    return _bm25(spark, sf).select("query_id", "doc_id", "rank", _r("score", 5))


@query("ret2_postings_read", covers="RET2", sql=f"""
WITH {_BM25_SQL.strip()}
SELECT qt.query_id, CAST(sum(df.df) AS BIGINT) AS n_postings, TRUE AS read_at_most
FROM qt JOIN df USING (term) GROUP BY qt.query_id""")
def ret2_postings(spark, sf):
    """Postings of each query's terms, and that a search never scores more of them."""
    r = inverted_index.postings_read(_index(spark, sf), _text_queries(spark, sf), "item_id", "qtokens")
    return r.select("query_id", "n_postings", (F.col("n_read") <= F.col("n_postings")).alias("read_at_most"))


#: Candidate pairs that are sent to the documents; more of them meet the documents in a shuffle.
BROADCAST_PAIRS = 100_000


def _overlap_ranking(spark, sf, pairs):
    # only the candidate documents are tokenised: join to the raw text first
    d = load_table(spark, sf, "documents").select("doc_id", "text")
    q = load_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), simple_tokens("text").alias("qtokens"))
    # the candidates are queries x k rows, whatever the corpus: the documents stay where they are
    wanted = cut_lineage(pairs.join(q, "query_id"))
    if wanted.count() <= BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)
    p = d.join(wanted, "doc_id").withColumn("tokens", simple_tokens("text")).drop("text")
    return rt.rerank(p, "qtokens", "tokens", "doc_id", k=10)


@query("ret4_rerank_top10_overlap", covers="RET4", sql=f"""
WITH {_BM25_SQL.strip()},
c AS (SELECT bm.query_id, bm.doc_id, dt.tk, qq.qk FROM bm JOIN dt USING (doc_id)
      JOIN (SELECT item_id AS query_id, {_tok_sql('text')} AS qk FROM benchmark) qq USING (query_id) WHERE bm.rank <= 10),
o AS (SELECT query_id, doc_id,
             CASE WHEN len(list_distinct(qk)) > 0 THEN len(list_intersect(list_distinct(qk), list_distinct(tk))) / len(list_distinct(qk)) END
               AS rerank_score FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, doc_id) AS rerank_rank FROM o)
SELECT query_id, doc_id, CAST(rerank_rank AS INTEGER) AS rerank_rank, round(rerank_score, 6) AS rerank_score
FROM r WHERE rerank_rank <= 5""")
def ret4(spark, sf):
    cand = _bm25(spark, sf, k=10).select("query_id", "doc_id")
    rr = _overlap_ranking(spark, sf, cand)
    return rr.where("rerank_rank <= 5").select("query_id", "doc_id", "rerank_rank", _r("rerank_score"))


@query("ret3_hybrid_rrf", covers="RET3", sql=f"""
WITH {_BM25_SQL.strip()},
c AS (SELECT bm.query_id, bm.doc_id, dt.tk, qq.qk FROM bm JOIN dt USING (doc_id)
      JOIN (SELECT item_id AS query_id, {_tok_sql('text')} AS qk FROM benchmark) qq USING (query_id) WHERE bm.rank <= 10),
o AS (SELECT query_id, doc_id,
             CASE WHEN len(list_distinct(qk)) > 0 THEN len(list_intersect(list_distinct(qk), list_distinct(tk))) / len(list_distinct(qk)) END
               AS sc FROM c),
ov AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY sc DESC, doc_id) AS rank FROM o),
a AS (SELECT query_id, doc_id, rank FROM bm WHERE rank <= 10),
f AS (SELECT coalesce(a.query_id, ov.query_id) AS query_id, coalesce(a.doc_id, ov.doc_id) AS doc_id,
             coalesce(1.0 / (60 + a.rank), 0) + coalesce(1.0 / (60 + ov.rank), 0) AS score
      FROM a FULL OUTER JOIN ov ON a.query_id = ov.query_id AND a.doc_id = ov.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS fused_rank FROM f)
SELECT query_id, doc_id, CAST(fused_rank AS INTEGER) AS fused_rank, round(score, 8) AS score FROM r WHERE fused_rank <= 5""")
def ret3(spark, sf):
    bm = _bm25(spark, sf, k=10)
    ov = _overlap_ranking(spark, sf, bm.select("query_id", "doc_id")).select(
        "query_id", "doc_id", F.col("rerank_rank").alias("rank"))
    fused = rt.rrf_fuse(bm.select("query_id", "doc_id", "rank"), ov, "doc_id", k=5)
    return fused.select("query_id", "doc_id", "fused_rank", _r("score", 8))


@query("ret5_ranking_metrics", covers="RET5", sql=f"""
WITH {_BM25_SQL.strip()},
rel AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
nrel AS (SELECT count(*) AS nr FROM rel),
t AS (SELECT bm.query_id, bm.rank, CASE WHEN rel.doc_id IS NULL THEN 0 ELSE 1 END AS r
      FROM bm LEFT JOIN rel USING (doc_id) WHERE bm.rank <= 5)
SELECT query_id, round(sum(r) / 5.0, 6) AS precision_at_k, round(sum(r) / any_value(nr), 6) AS recall_at_k,
       round(sum(r / log2(rank + 1)) / list_sum(list_transform(range(1, least(any_value(nr), 5) + 1), lambda i: 1.0 / log2(i + 1))), 6)
         AS ndcg_at_k
FROM t, nrel GROUP BY query_id""")
def ret5(spark, sf):
    rel = load_table(spark, sf, "labels").where("quality = 1").select("doc_id")
    m = rt.ranking_metrics(_bm25(spark, sf, k=5), rel, "doc_id", 5)
    return m.select("query_id", _r("precision_at_k"), _r("recall_at_k"), _r("ndcg_at_k"))


@query("agg32_turns_per_conversation", covers="AGG32 AGG30", sql="""
SELECT conv_id, count(*) AS n_turns, arg_min(role, turn) AS first_role,
       string_agg(role, ',' ORDER BY turn) AS role_sequence
FROM conversations GROUP BY conv_id""")
def agg32(spark, sf):
    c = load_table(spark, sf, "conversations")
    return c.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.min_by("role", "turn").alias("first_role"),
        # one conversation's own turns, ordered: the list is bounded by that conversation
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]), ",")
         .alias("role_sequence"))


@query("udf6_embedding_hybrid_search", covers="UDF6 RET1 RET3")
def udf6(spark, sf):
    from tessera.functions.embedding import embed
    docs = spread(load_table(spark, sf, "documents"), cores(spark)).select("doc_id", embed("text").alias("vec"))
    qs = load_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), embed("text").alias("qvec"))
    vec = rt.vector_search(docs, qs, "doc_id", "vec", "query_id", "qvec", k=10)
    fused = rt.rrf_fuse(_bm25(spark, sf, k=10).select("query_id", "doc_id", "rank"),
                        vec.select("query_id", "doc_id", "rank"), "doc_id", k=5)
    return fused.select("query_id", "doc_id", "fused_rank", "score")
