"""Operator 13: runs of words that repeat with a period, by internal pattern matching.

A run is a stretch of words with a period q (words q apart are equal) that is at
least ``min_exponent`` periods and ``min_words`` words long and that no
neighbouring word extends.  Each run is found through blocks whose length m is a
power of two and whose place is a multiple of m:

1. The texts of a slice stand one after another, with a separator of its own
   between any two, so nothing matches across texts.  Suffixes are sorted by
   doubling their sorted length; on the way the range of suffixes that share each
   block is kept.
2. A wavelet tree over the suffix array answers, for all blocks of a length at
   once, where the block occurs next: the last occurrence in the window of m
   words before it and the first in the window of its own m words.  The
   occurrences of a block in such a window form one arithmetic progression, so the
   nearest one gives its difference, the candidate period.  A run of four or
   more periods q holds a block with q <= m < 2q and an occurrence q words away.
3. Candidates of one period that overlap by a period are joined, both ends are
   extended word by word (less than two blocks), and the smallest period of
   each stretch is kept.

Bit vectors are packed, so the tree takes about three bytes a word.  A slice holds
about ``SLICE`` bytes of text; one longer text is a slice of its own, and its
work stays n log n whatever it repeats.

Defined cases: null, empty and blank texts have no words and no runs (their
collapsed text is empty); repeated rows give repeated rows; rows with a null id
are treated like others; equal words are equal bytes; extra columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, slices

SLICE = 1 << 20
MIN_WORDS, MIN_EXPONENT = 6, 4
_STEP = 32


def suffix_order(w: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Positions in suffix order; and for m = 1, 2, 4, ... per block of m words (at 0, m, 2m, ...)
    the place of the first suffix that begins with it and the number of such suffixes.

    The last word must be unlike all others."""
    n = len(w)
    sa = np.argsort(w, kind="stable")
    rank, count = np.empty(n, dtype=np.int64), np.ones(n, dtype=np.int64)
    slot, key, h, levels = np.arange(n), w[sa], 1, []
    i = sa
    while True:
        new = np.ones(len(slot), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(slot)))
        rank[i], count[i] = np.repeat(slot[first], size), np.repeat(size, size)
        levels.append((rank[::h].copy(), count[::h].copy()))
        slot = slot[np.repeat(size > 1, size)]
        if not len(slot):
            return sa, levels
        i = sa[slot]
        key = rank[i] * n + rank[i + h]  # a suffix that ends within h words is alone by now
        order = np.argsort(key, kind="stable")
        i, key = i[order], key[order]
        sa[slot] = i
        h *= 2


class WaveletTree:
    """Numbers below 2**bits in a given order, one packed bit vector a level, highest bit first."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, n = bits, len(values)
        self.words, self.before, self.zeros = [], [], []
        for level in range(bits):
            one = (values >> (bits - 1 - level)) & 1 == 1
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(n // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.cumsum(ones) - ones)
            self.zeros.append(n - int(one.sum()))
            values = np.concatenate([values[~one], values[one]])

    def ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """How many of the first ``i`` numbers of a level have a one there."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def cell(self, lo: np.ndarray, hi: np.ndarray, cell: np.ndarray, low_bits: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges cut down to the numbers whose bits above ``low_bits`` are ``cell``; those that
        hold at least ``least`` of them: (which, lo, hi)."""
        which = np.arange(len(lo))
        for level in range(self.bits - low_bits):
            a, b = self.ones(level, lo), self.ones(level, hi)
            one = (cell >> (self.bits - low_bits - 1 - level)) & 1 == 1
            z = self.zeros[level]
            lo, hi = np.where(one, z + a, lo - a), np.where(one, z + b, hi - b)
            live = hi - lo >= least
            which, lo, hi, cell = which[live], lo[live], hi[live], cell[live]
        return which, lo, hi

    def select(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray, cell: np.ndarray, low_bits: int) -> np.ndarray:
        """The k-th smallest (from 0) number of each cell's range."""
        value = cell
        for level in range(self.bits - low_bits, self.bits):
            a, b = self.ones(level, lo), self.ones(level, hi)
            zeros = hi - lo - (b - a)
            one = k >= zeros
            z = self.zeros[level]
            k = np.where(one, k - zeros, k)
            lo, hi = np.where(one, z + a, lo - a), np.where(one, z + b, hi - b)
            value = value * 2 + one
        return value


def candidates(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of stretches with a period, found from blocks that occur again nearby."""
    sa, levels = suffix_order(w)
    bits = max(1, (len(w) - 1).bit_length())
    tree = WaveletTree(sa, bits)
    found = [(np.empty(0, dtype=np.int64),) * 3]
    for k, (rank, count) in enumerate(levels):
        m = 1 << k
        block = np.flatnonzero(count > 1)
        lo, hi = rank[block], rank[block] + count[block]
        sides = []
        if k:  # the block itself is the first of its own window, so the second is the next one
            which, a, b = tree.cell(lo, hi, block, k, 2)
            at = block[which]
            sides.append((at * m, tree.select(a, b, np.ones(len(at), dtype=np.int64), at, k)))
        which, a, b = tree.cell(lo, hi, np.maximum(block - 1, 0), k, 1)  # word 0 is a separator: block 0 is alone
        at = block[which]
        sides.append((tree.select(a, b, b - a - 1, at - 1, k), at * m))
        for x, y in sides:
            keep = 2 * (y - x) > m  # shorter periods are found with shorter blocks
            found.append((x[keep], y[keep] + m, (y - x)[keep]))
    x, end, q = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((x, q))
    x, end, q = x[order], end[order], q[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (x[1:] > end[:-1] - q[1:])
    first = np.flatnonzero(new)
    return x[first], end[np.append(first[1:], len(x))[:len(first)] - 1], q[first]


def _matches(w: np.ndarray, at: np.ndarray, other: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (forwards or backwards) equal those from ``other`` on."""
    out = np.zeros(len(at), dtype=np.int64)
    live, last = np.arange(len(at)), len(w) - 1
    offset = np.arange(_STEP) * step
    while len(live):
        i, j = (p[live, None] + out[live, None] * step + offset for p in (at, other))
        same = w[np.clip(i, 0, last)] == w[np.clip(j, 0, last)]
        run = np.where(same.all(axis=1), _STEP, np.argmin(same, axis=1))
        out[live] += run
        live = live[run == _STEP]
    return out


def word_runs(w: np.ndarray, min_words: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of ``w``, by start, then period.

    The first and the last word, and a word between any two texts, must be unlike all others."""
    x, end, q = candidates(w)
    x = x - _matches(w, x - 1, x - 1 + q, -1)
    end = end + _matches(w, end, end - q, 1)
    long = end - x >= np.maximum(min_words, min_exponent * q)
    x, end, q = x[long], end[long], q[long]
    order = np.lexsort((q, end, x))
    x, end, q = x[order], end[order], q[order]
    first = np.ones(len(x), dtype=bool)
    first[1:] = (x[1:] != x[:-1]) | (end[1:] != end[:-1])  # other periods of a stretch are multiples
    x, end, q = x[first], end[first], q[first]
    order = np.lexsort((q, x))
    return x[order], (end - x)[order], q[order]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batch(texts: list[str | None], min_words: int, min_exponent: int) -> list[pa.Array]:
    """n_words, runs and collapsed text of each text."""
    words = [(t or "").encode().split() for t in texts]  # bytes split at the six ASCII white-space characters
    size = np.array([len(x) for x in words], dtype=np.int64)
    begin = np.cumsum(size + 1) - size  # place of a text's first word; a separator stands before it
    total = int(size.sum())
    flat = pa.array([x for t in words for x in t], pa.binary()).dictionary_encode()
    w = np.empty(total + len(texts) + 1, dtype=np.int64)
    separator = np.append(begin - 1, len(w) - 1)
    word = np.ones(len(w), dtype=bool)
    word[separator] = False
    w[word] = flat.indices.to_numpy()
    w[separator] = len(flat.dictionary) + np.arange(len(separator))
    x, length, q = word_runs(w, min_words, min_exponent)
    text = np.searchsorted(begin, x, side="right") - 1
    change = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(change, x + q, 1)
    np.add.at(change, x + length, -1)
    gone = np.cumsum(change) > 0
    collapsed = []
    has_run = np.zeros(len(texts), dtype=bool)
    has_run[text] = True
    for t, (ws, cut) in enumerate(zip(words, has_run.tolist(), strict=True)):
        if cut:
            drop = gone[begin[t]:begin[t] + size[t]].tolist()
            ws = [x for x, d in zip(ws, drop, strict=True) if not d]
        collapsed.append(b" ".join(ws))
    runs = pa.StructArray.from_arrays([pa.array(x - begin[text]), pa.array(length), pa.array(q)], fields=list(_RUN))
    offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    return [pa.array(size), pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(collapsed, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_words bigint, ``runs`` array<struct<start, length, period>> (by start,
    then period) and ``collapsed`` string: the words outside the repeated part (all but the first
    period) of every run, joined by one space."""
    if min_exponent < 4:
        raise ValueError("runs are found from blocks of up to two periods: min_exponent must be 4 or more")
    kept = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1, SLICE):
            yield pa.RecordBatch.from_arrays([b.column(0), *_batch(b.column(1).to_pylist(), min_words, min_exponent)],
                                             [id_col, "n_words", "runs", "collapsed"])

    kind = kept.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the longest run and SHA-256 digests of ``periodic_runs``' results."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(id_col, F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        id_col, "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
