"""Operator 6: line dedup over levelled sorted runs of line hashes (DataFrame functions only).

Documents are taken in batches of ascending ``doc_id``.  The lines of a batch
are reduced to their keys' 16-byte digests with the smallest id holding each;
a merge anti-join against the stored runs finds the digests not seen before,
which are written as the batch's own run, sorted by digest.  ``fanout`` runs of
a level are compacted into one sorted run of the next level, so the number of
runs read per batch grows with the logarithm of the number of batches.

A line goes if its key has at least ``min_chars`` code points and a document
with a smaller id (an earlier batch, or an earlier document of this batch)
holds the key.

Defined cases: null and empty texts are one empty line (a null text stays
null); rows without ``doc_id`` together count as one document after all
others; rows that repeat a ``doc_id`` count as one document, so each keeps or
loses its lines like the other; columns of the input named ``n_lines`` or
``n_dropped`` are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    k = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(k) == F.length(k), F.lower(k)).otherwise(F.translate(k, UPPER, LOWER))


def id_bounds(docs: DataFrame, id_col: str, n: int) -> list:
    """Up to ``n - 1`` ids that cut the table into batches of about equal rows."""
    at = docs.agg(F.percentile_approx(id_col, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else None
    return sorted(set(at or []))


def batch_of(id_col: str, bounds: list) -> Column:
    """Number of bounds below the id; rows without id go to the last batch."""
    return F.when(F.col(id_col).isNull(), F.lit(len(bounds))).otherwise(
        reduce(lambda a, b: a + b, [(F.col(id_col) > b).cast("int") for b in bounds], F.lit(0)))


def _sorted_run(hashes: DataFrame, name: str) -> DataFrame:
    return stored(hashes.repartitionByRange("digest").sortWithinPartitions("digest"), name)


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int,
                  batches: int, fanout: int) -> DataFrame:
    """(``id_col``, ``row_digest``, ``pos``) of every line that goes."""
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    bounds = id_bounds(docs, id_col, batches)
    lines = (docs.select(F.col(id_col), F.xxhash64(text_col).alias("row_digest"), batch_of(id_col, bounds).alias("batch"),
                         F.posexplode(split).alias("pos", "line"))
             .select(id_col, "row_digest", "batch", "pos", line_key(F.col("line")).alias("k"))
             .filter(F.length("k") >= min_chars)
             .select(id_col, "row_digest", "pos", F.unhex(F.md5(F.col("k").cast("binary"))).alias("digest"), "batch"))
    lines = stored(lines, "lines", partition_by=["batch"])
    levels: list[list[DataFrame]] = [[]]
    gone: list[DataFrame] = []
    for b in range(len(bounds) + 1):
        mine = lines.filter(F.col("batch") == b).drop("batch")
        holders = mine.groupBy("digest").agg(F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"))).alias("first"))
        for run in (r for level in levels for r in level):
            holders = holders.join(run.hint("merge"), "digest", "left_anti")
        fresh = _sorted_run(holders.select("digest", F.col("first.id").alias("first_id")), "run")
        here = mine.join(fresh.withColumn("fresh", F.lit(True)).hint("merge"), "digest", "left")
        gone.append(here.filter(F.col("fresh").isNull() | ~F.col("first_id").eqNullSafe(F.col(id_col)))
                    .select(id_col, "row_digest", "pos"))
        levels[0].append(fresh.select("digest"))
        for i, level in enumerate(levels):
            if len(level) == fanout:
                merged = _sorted_run(reduce(DataFrame.unionByName, level), f"run-level{i + 1}")
                levels[i] = []
                if i + 1 == len(levels):
                    levels.append([])
                levels[i + 1].append(merged)
    return reduce(DataFrame.unionByName, gone)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with the kept lines as text, and ``n_lines`` (before), ``n_dropped`` bigint."""
    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    gone = dropped_lines(docs, id_col, text_col, min_chars, batches, fanout)
    gone = (gone.groupBy(F.col(id_col).alias("__id"), F.col("row_digest").alias("__gone_digest"))
            .agg(F.collect_set("pos").alias("__gone")))
    # The split lines are made below the join, so that no later expression repeats the split.
    rows = docs.select(*[c for c in cols if c != text_col], F.col(text_col).isNull().alias("__null"),
                       F.xxhash64(text_col).alias("__digest"),
                       F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("__lines"))
    out = rows.join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__gone_digest")), "left")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone")),
                       lambda i: F.get(F.col("__lines"), i))
    text = (F.when(F.col("__null"), F.lit(None).cast("string")).when(F.col("__gone").isNull(), F.array_join("__lines", "\n"))
            .otherwise(F.array_join(kept, "\n")))
    return out.select(*[text.alias(c) if c == text_col else F.col(c) for c in cols],
                      F.size("__lines").cast("bigint").alias("n_lines"),
                      F.coalesce(F.array_size("__gone"), F.lit(0)).cast("bigint").alias("n_dropped"))
