"""The operators bound to the test tables, and their DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import balance, hmm_lm, language_mix, line_runs, linear_packing, page_text, paragraph_sketch, periodic_runs, piece_bpe, simhash_pivots, suffix_shards, token_spans, topk_blocks
from tessera.llm.common import only, read

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_mix.identify(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "mixture")


def op2_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_texts(read(spark, sf_dir, "documents"))


def op3_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = paragraph_sketch.version_differences(read(spark, sf_dir, "documents"), with_digests=False)
    return d.select(F.col("doc").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    F.col("whole_e").alias("near_edited"), F.col("whole_n").alias("near_next"),
                    F.col("like_e").alias("lines_edited"), F.col("like_n").alias("lines_next"))


def op4_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash_pivots.near_duplicates(read(spark, sf_dir, "documents"), words=3, max_bits=3)
    return near.select("doc_id", simhash_pivots.hex_fingerprint(near["fp"]).alias("fingerprint"), "component_id")


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(read(spark, sf_dir, "pages"))


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup_lines(only(read(spark, sf_dir, "documents"), "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
holders AS (SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (
  SELECT keyed.doc_id, pos, line, coalesce(first_id <> keyed.doc_id, FALSE) AS gone
  FROM keyed LEFT JOIN holders USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(piece_bpe.encode_documents(read(spark, sf_dir, "documents"), PIECE_MODEL))


def op8_topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_blocks.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


OP8_SQL = r"""
WITH parts AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""


def op9_suffix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_shards.drop_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["begin"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), F.length("kept").cast("bigint").alias("n_kept"),
                      (F.size("spans") > 0).alias("has_repeats"))


def op10_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = balance.mix(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_spans.alignment_table(read(spark, sf_dir, "documents"), BYTE_BPE, PIECE_MODEL)


def op12_linear_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_packing.pack(linear_packing.pieces(read(spark, sf_dir, "documents"), BYTE_BPE))


def _made_periodic(docs: DataFrame) -> DataFrame:
    """In texts whose id's hash is a multiple of ten, the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    made = F.expr("array_join(transform(sequence(0, n - 1), i -> words[int(IF(i < a, i, a + (i - a) % p))]), ' ')")
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(_made_periodic(read(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_mix": op1_language_mix,
    "op2_hmm_score": op2_hmm_score,
    "op3_paragraph_sketch": op3_paragraph_sketch,
    "op4_simhash_pivots": op4_simhash_pivots,
    "op5_page_text": op5_page_text,
    "op6_line_runs": op6_line_runs,
    "op7_piece_encoding": op7_piece_encoding,
    "op8_topk_blocks": op8_topk_blocks,
    "op9_suffix_shards": op9_suffix_shards,
    "op10_entropy_balance": op10_entropy_balance,
    "op11_token_spans": op11_token_spans,
    "op12_linear_packing": op12_linear_packing,
    "op13_word_runs": op13_word_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op6_line_runs": OP6_SQL,
    "op8_topk_blocks": OP8_SQL,
}
