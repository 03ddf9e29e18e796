"""Corpus pipeline over ``documents``; each stage applies one operator of ``tessera.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written
as Parquet and read back as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.

Defined cases are those of the operators.  A text that loses all its lines
stays as an empty text until the near-duplicate stage, where all empty texts
are one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import balance, language_mix, line_runs, piece_bpe, simhash_pivots
from tessera.llm import queries as q
from tessera.llm.common import only, read, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    return language_mix.identified(docs, COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are cut out of the texts."""
    kept = line_runs.dedup_lines(only(docs, *COLUMNS))
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_pivots.one_per_group(only(docs, *COLUMNS), words=3, max_bits=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return balance.repeated_rows(only(docs, *COLUMNS))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each row."""
    return piece_bpe.digests(piece_bpe.encode_documents(docs, q.PIECE_MODEL))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", piece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned models, components and iterative rates have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None
