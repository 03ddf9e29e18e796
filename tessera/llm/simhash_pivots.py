"""Operator 4: SimHash near-duplicates with pivot distance tables.

1. Each text becomes a 64-bit SimHash of its word shingles (XXH64, seed 42).
2. Equal fingerprints are one class.  Two fingerprints that differ in at most
   ``max_bits`` of 64 bits, cut into ``max_bits + 2`` blocks, agree in at least
   two blocks, so classes meet in one bucket per pair of blocks: a superset of
   all links, without comparing everything with everything.
3. Inside a bucket, the Hamming distances of each class to ``PIVOTS`` fixed
   reference fingerprints are tabulated.  By the triangle inequality a pair whose
   tables differ by more than ``max_bits`` in any coordinate cannot link and is
   discarded; survivors are verified by XOR and population count.
4. A bucket reports only links that join two of its so far separate parts (at
   most members - 1), so a large group of near copies yields no all-pairs rows.
   Buckets above ``CHUNK`` members are dealt out as pairs of chunks, which
   still compares every pair once.
5. Components of the links give each document the smallest reachable ``doc_id``.

Defined cases: null, empty and word-less texts have fingerprint zero, linked
like any other; fewer words than the shingle length make one shingle; repeated
rows and equal texts share a component; rows with a null ``doc_id`` take the
smallest non-null id of their component (null if there is none); extra columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, slices, stored
from tessera.llm.components import components

PIVOTS = 16
CHUNK = 2048


def references(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: multiples of the 64-bit golden ratio, mixed once."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    return x * np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, words: int, seed: int) -> list[int]:
    import xxhash

    h = xxhash.xxh64_intdigest
    w = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z, \x20 and \x09-\x0D only
    if len(w) <= words:
        return [h(b" ".join(w), seed)] if w else []
    return [h(b" ".join(w[i:i + words]), seed) for i in range(len(w) - words + 1)]


def simhash(hashes: list[int]) -> int:
    """Bit i is set if it is set in more than half of the hashes."""
    if not hashes:
        return 0
    a = np.array(hashes, dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(a), 1 << 16):
        part = a[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(a), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 3, seed: int = 42) -> DataFrame:
    """``id_col`` and ``fp`` bigint (the fingerprint's 64 bits, signed) of every row."""
    kept = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            fp = np.array([simhash(shingle_hashes(t or "", words, seed)) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], [id_col, "fp"])

    return kept.mapInArrow(run, f"`{id_col}` {kept.schema[id_col].dataType.simpleString()}, fp bigint")


def block_masks(max_bits: int) -> list[int]:
    """One mask per pair of ``max_bits + 2`` nearly equal blocks of the 64 bits, signed."""
    n = max_bits + 2
    edge = [round(64 * i / n) for i in range(n + 1)]
    block = [sum(1 << b for b in range(edge[i], edge[i + 1])) for i in range(n)]
    return [m - (1 << 64) if m >> 63 else m for m in (block[i] | block[j] for i, j in combinations(range(n), 2))]


def link_runs(bucket: np.ndarray, fp: np.ndarray, max_bits: int, side: np.ndarray | None = None) -> np.ndarray:
    """Links (rows of two fingerprints) that connect what is connected inside each
    run of equal ``bucket`` values.  With ``side``, pairs on one side are skipped
    unless the run has a single side."""
    n = len(fp)
    if n < 2:
        return np.empty((0, 2), dtype=np.int64)
    u = fp.view(np.uint64)
    table = np.bitwise_count(u[:, None] ^ references()[None, :]).astype(np.int8)
    new = np.ones(n, dtype=bool)
    new[1:] = bucket[1:] != bucket[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    left = np.repeat(ends, ends - starts) - np.arange(n) - 1  # rows of the run after each row
    label = np.arange(n)
    found: list[tuple[int, int]] = []
    rows = np.arange(n)

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for step in range(1, int(left.max(initial=0)) + 1):
        rows = rows[left[rows] >= step]
        i, j = rows, rows + step
        ok = label[i] != label[j]
        if side is not None:
            ok &= side[i] != side[j]
        i, j = i[ok], j[ok]
        ok = np.abs(table[i] - table[j]).max(axis=1, initial=0) <= max_bits
        i, j = i[ok], j[ok]
        ok = np.bitwise_count(u[i] ^ u[j]) <= max_bits
        if ok.any():
            for a, b in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                ra, rb = root(a), root(b)
                if ra != rb:
                    label[max(ra, rb)] = min(ra, rb)
                    found.append((a, b))
            while (nxt := label[label]).tolist() != label.tolist():
                label[:] = nxt
    if not found:
        return np.empty((0, 2), dtype=np.int64)
    return fp[np.array(found)]


def links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links between distinct fingerprints (``fp``) that connect all that are within ``max_bits``."""
    masks = block_masks(max_bits)
    keys = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).cast("smallint").alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.part", "k.bits")
    busy = (keys.groupBy("part", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select("part", "bits", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    met = keys.join(busy, ["part", "bits"])
    own: Column = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = (met.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
           .select("fp", F.xxhash64("part", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
                   F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
                   .cast("smallint").alias("side")))
    # A hashed bucket name can at worst join two buckets: more pairs are tried, each is verified.
    met = met.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def done(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            fp, bucket, side = cols
            paired = side > 0
            out = [link_runs(bucket[~paired], fp[~paired], max_bits), link_runs(bucket[paired], fp[paired], max_bits, side[paired])]
            e = np.concatenate(out)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            if held[0][1][0] == held[-1][1][-1] and len(held) > 1:
                continue  # still one bucket
            fp, bucket, side = (np.concatenate([h[i] for h in held]) for i in range(3))
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            held = [(fp[cut:], bucket[cut:], side[cut:])]
            if cut:
                yield done((fp[:cut], bucket[:cut], side[:cut]))
        if held:
            yield done(tuple(np.concatenate([h[i] for h in held]) for i in range(3)))

    return met.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """``id_col``, ``fp`` bigint and ``component_id`` (smallest reachable id) of every row."""
    fps = stored(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min(id_col).alias("low")), "classes")
    hooked = components(links(classes, max_bits)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = classes.join(hooked, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(id_col, "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_group(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of ``docs`` per component: the smallest ``doc_id`` (nulls last), then the
    smallest text digest; of rows equal in both, any one (the least by all its columns)."""
    cols = docs.columns
    named = docs.withColumn("__doc", F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                                              F.xxhash64("text").alias("digest")))
    near = near_duplicates(named, "__doc", "text", words, max_bits)
    first = (near.filter(F.col("__doc").eqNullSafe(F.col("component_id"))).groupBy("__doc")
             .agg(F.count(F.lit(1)).alias("n")).select(F.col("__doc").alias("__keep"), "n"))
    same = F.col("__doc").eqNullSafe(F.col("__keep"))
    once = named.join(first.filter("n = 1"), same, "left_semi").select(*cols)
    again = (named.join(first.filter("n > 1"), same, "left_semi").groupBy("__doc")
             .agg(F.min_by(F.struct(*cols), F.xxhash64(*cols)).alias("__row")).select("__row.*"))
    return once.unionByName(again)
