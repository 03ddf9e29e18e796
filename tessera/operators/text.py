"""Text operators (TXT1-TXT5, UDF5): cleaning pipeline, dictionary maps,
word and n-gram frequencies."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.session import cut_lineage, stored


def clean_tokens(df: DataFrame, text: str, out: str = "tokens", stop_words=tx.STOP_WORDS,
                 slang: dict | None = tx.SLANG) -> DataFrame:
    """TXT1: punctuation -> normalise -> emoji -> tokenise -> stop words -> slang map."""
    toks = tx.tokenize(tx.clean_text(text))
    if stop_words:
        toks = tx.remove_stop_words(toks, stop_words)
    if slang:
        toks = tx.replace_tokens(toks, slang)
    return df.withColumn(out, toks)


def map_tokens_by_table(df: DataFrame, id_col: str, tokens: str, dictionary: DataFrame,
                        key: str = "word", value: str = "lemma", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """TXT1 lemma step: replace each token through a (word -> lemma) table.

    The dictionary is written once and measured.  Up to ``broadcast_bytes`` it
    is broadcast: the documents are partitioned by id, and tokens are exploded,
    looked up and regrouped inside these partitions, so no token is shuffled.
    A larger one is joined with the distinct words of each document, and only
    words that it holds go back to their document.

    Ids identify documents and are not null.  A word that stands in the
    dictionary more than once takes its least value; NULL words and values
    replace nothing; NULL tokens give an empty list."""
    d = dictionary.select(F.col(key).alias("__w"), F.col(value).alias("__l")).where(F.col("__w").isNotNull() & F.col("__l").isNotNull())
    d = cut_lineage(d.groupBy("__w").agg(F.min("__l").alias("__l")))
    size = d.agg(F.sum(F.octet_length("__w") + F.octet_length("__l") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        df = df.repartition(id_col)
        ex = df.select(id_col, F.posexplode(tokens).alias("__p", "__w")).join(F.broadcast(d), "__w", "left")
        back = (ex.groupBy(id_col)
                .agg(F.array_sort(F.collect_list(F.struct("__p", F.coalesce("__l", "__w").alias("t")))).alias("__s"))
                .select(id_col, F.transform("__s", lambda s: s["t"]).alias("__mapped")))
    else:
        words = df.select(id_col, F.explode(F.array_distinct(tokens)).alias("__w"))
        back = (words.join(d, "__w").groupBy(id_col)
                .agg(F.map_from_entries(F.collect_set(F.struct("__w", "__l"))).alias("__m")))
        back = df.select(id_col, tokens).join(back, id_col, "left").select(
            id_col, F.transform(tokens, lambda t: F.coalesce(F.try_element_at("__m", t), t)).alias("__mapped"))
    return (df.join(back, id_col, "left")
              .withColumn(tokens, F.coalesce(F.col("__mapped"), F.array().cast("array<string>"))).drop("__mapped"))


def word_frequency(df: DataFrame, tokens: str, top_k: int = 20, skip: int = 3) -> DataFrame:
    """TXT3: token counts, ranks ``skip+1 .. top_k`` (ties by token).  The
    ranking is a per-partition top-k merge, not a sort of the vocabulary."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), "token").limit(top_k)
    ranked = top.withColumn("rank", F.row_number().over(W.orderBy(F.desc("count"), "token")))
    return ranked.where(F.col("rank") > skip)


#: Words that n-grams are first counted from, and the most that are sent to the documents when those do not settle it.
HEAVY, HEAVY_MOST = 256, 50_000


def _ngram_counts(tokens_df: DataFrame, tokens: str, sizes: list[int], words: list[str] | None) -> DataFrame:
    """(n, ngram, count) of all n-grams, or of those made only of ``words``."""
    if words is not None:
        # written, so that a token is looked up once and not for every n-gram that holds it
        tokens_df = stored(tokens_df.select(F.transform(tokens, lambda t: F.when(t.isin(words), t)).alias(tokens)))
    grams = []
    for n in sizes:
        starts = F.filter(F.sequence(F.lit(0), F.size(tokens) - n),
                          lambda i: reduce(and_, [F.get(tokens, i + j).isNotNull() for j in range(n)]))
        ng = F.transform(starts, lambda i: F.struct(F.lit(n).alias("n"), F.array_join(F.slice(tokens, i + 1, n), " ").alias("ngram")))
        grams.append(F.when(F.size(tokens) >= n, ng).otherwise(F.array()))
    ex = tokens_df.select(F.explode(F.concat(*grams)).alias("g")).select("g.*")
    return ex.groupBy("n", "ngram").agg(F.count(F.lit(1)).alias("count"))


def ngram_frequencies(df: DataFrame, tokens: str, top: dict[int, int], heavy: int = HEAVY, heavy_most: int = HEAVY_MOST) -> DataFrame:
    """TXT4 for several n (inside the document only): the ``top[n]`` n-grams per n, ties by text.

    An n-gram is no more frequent than any of its words.  Words are counted first; n-grams of the
    ``heavy`` most frequent words give each n a floor, its k-th count.  If a word outside reaches a
    floor, n-grams are counted again from all words that do (from all words at all, where these are more
    than ``heavy_most`` or there is no floor).  The result is exact; rare n-grams, nearly all, are never
    shuffled.  NULL tokens are part of no n-gram."""
    d = stored(df.select(tokens))
    words = stored(d.select(F.explode(tokens).alias("ngram")).where(F.col("ngram").isNotNull()).groupBy("ngram").agg(F.count(F.lit(1)).alias("count")))
    order = [F.desc("count"), F.col("ngram")]
    first = words.orderBy(*order).limit(heavy + 1).collect()
    outside = first[heavy]["count"] if len(first) > heavy else 0
    sizes = [n for n in sorted(top) if n > 1]
    counts = stored(_ngram_counts(d, tokens, sizes, [r["ngram"] for r in first[:heavy]])) if sizes else None
    best = {n: counts.where(F.col("n") == n).orderBy(*order).limit(top[n]).collect() for n in sizes}
    floors = {n: rows[-1]["count"] if len(rows) == top[n] and rows else 0 for n, rows in best.items()}
    again = [n for n in sizes if outside and outside >= floors[n]]
    if again:
        least = min(floors[n] for n in again)
        wider = words.where(F.col("count") >= least)
        some = least > 0 and wider.count() <= heavy_most
        more = stored(_ngram_counts(d, tokens, again, [r["ngram"] for r in wider.collect()] if some else None))
        counts = counts.where(~F.col("n").isin(again)).unionByName(more)
    # per n a global top-k: per-partition top-k, then a merge (TakeOrderedAndProject)
    out = None
    for n, k in top.items():
        found = words.select(F.lit(1).alias("n"), "ngram", "count") if n == 1 else counts.where(F.col("n") == n)
        part = found.orderBy(*order).limit(k)
        out = part if out is None else out.unionByName(part)
    return out.select("ngram", "count", "n")
