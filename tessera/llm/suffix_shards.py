"""Operator 9: removal of byte strings that occur twice, by sharded suffix arrays.

A window is ``window`` bytes of one text; the bytes of every window that starts
at two places go.

1. Anchors.  In every window the ``GRAM``-byte string of least hash (leftmost of
   equals) is its anchor, so equal windows have equal anchors.  The windows of a
   text fall into runs with one anchor; a run's context is the bytes its windows
   cover.  Every window start lies in exactly one context.
2. Contexts that occur twice are repeated as a whole.  Of the others only those
   whose anchor occurs in different contexts can hold a repeated window; one copy
   of each such context goes to the shard of its anchor.
3. Per piece of a shard (whole anchors) a suffix array to depth ``window`` is built
   by Larsson-Sadakane refinement in numpy (groups of equal prefixes, doubled in
   length, sorted ones left alone), each place only as far as the order of window
   starts needs it; Kasai's scan over the texts of the contexts gives common
   prefixes of neighbours; ``window`` bytes or more in common mark both starts.
4. Contexts of one anchor above ``SHARD`` bytes are dealt over several shards.
   These report their windows' digests, one per distinct window; sorted lists
   are merged by binary search to find windows that lie in several shards.
5. Marked windows go back to all texts that hold the context; each text drops
   the union of its marked windows.

Defined cases: null and empty texts have 0 bytes and lose nothing, as do texts
shorter than the window; repeated rows are different texts with equal content;
rows with a null id are matched like others; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, stored, whole_runs

WINDOW = 400
GRAM = 32
SHARD = 2 << 20
#: Bytes of contexts sorted at once, whole anchors; a shard is sorted piece by piece.
PIECE = 512 << 10
#: Bytes of text (before compression) handled at once; one longer text is handled alone.
SLICE = 2 << 20
_M = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Mixed polynomial hash of the GRAM (a power of two) bytes from each position."""
    h = (buf.astype(np.uint64) + np.uint64(1)) * _M
    m, n = int(_M), 1
    while n < GRAM:
        h = h[:-n] * np.uint64(m) + h[n:]
        m, n = m * m % (1 << 64), 2 * n
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def anchors(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first start, last start, gram hash) of every run of windows with one anchor."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    none = np.empty(0, dtype=np.int64)
    if not (size >= window).any():
        return none, none, none, none.astype(np.uint64)
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begin = np.cumsum(size) - size
    h = gram_hashes(buf)
    low = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)  # hash, then place
    span = window - GRAM + 1  # grams of a window
    n = 1
    while 2 * n <= span:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    if n < span:
        low = np.minimum(low[:len(low) - (span - n)], low[span - n:])
    per = np.maximum(size - window + 1, 0)
    text = np.repeat(np.arange(len(texts)), per)
    start = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    at = start + begin[text]
    place = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return text[first], start[first], start[last], h[place[first]]


def _prefix_keys(buf: np.ndarray) -> np.ndarray:
    """The next 8 bytes from each position as a big-endian number (zeros past the end)."""
    pad = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(buf),), dtype=">u8", buffer=pad, strides=(1,)).astype(np.uint64)


def _sorted_groups(group: np.ndarray, second: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, second), and where a new pair begins in it; groups ascend, second is below ``bound``."""
    number = np.cumsum(np.append(False, group[1:] != group[:-1])[:len(group)])
    key = number.astype(np.uint64) << np.uint64(bound.bit_length()) | second.astype(np.uint64)
    bits = len(group).bit_length()
    if len(group) and int(number[-1]).bit_length() + bound.bit_length() + bits <= 64:  # one sort of numbers that end in their place
        key = np.sort(key << np.uint64(bits) | np.arange(len(group), dtype=np.uint64))
        o = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
        key >>= np.uint64(bits)
    else:
        o = np.argsort(key)
        key = key[o]
    return o, np.append(True, key[1:] != key[:-1])[:len(key)]


def suffix_order(buf: np.ndarray, depth: int, reach: np.ndarray) -> np.ndarray:
    """Positions that matter, window starts sorted by their next ``depth`` bytes (Larsson-Sadakane groups).

    ``reach``: the bytes from a position to the end of the last window over it, at most ``depth``, so
    ``depth`` at window starts.  A longer prefix never decides between windows and is left unsorted."""
    sa = np.flatnonzero(reach >= 8)
    key = _prefix_keys(buf)[sa]
    o = np.argsort(key)
    sa, key = sa[o], key[o]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    del key, o
    size = np.diff(np.append(first, len(sa)))
    rank = np.zeros(len(buf), dtype=np.int32)
    rank[sa] = np.repeat(first, size)
    slot = np.flatnonzero(np.repeat(size > 1, size))  # places in groups that are not sorted yet
    h = 8
    while h < depth and len(slot):
        step = min(h, depth - h)
        slot = slot[reach[sa[slot]] >= h + step]
        i = sa[slot]
        o, head = _sorted_groups(rank[i], rank[i + step], len(buf))
        i = i[o]
        sa[slot] = i
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(slot)))
        rank[i] = np.repeat(slot[first], size)
        slot = slot[np.repeat(size > 1, size)]
        h += step
    return sa


def common_prefixes(buf: np.ndarray, before: np.ndarray, begin: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Kasai's scan, all contexts side by side: per position the bytes (at most ``depth``) in
    common with position ``before`` (-1: none); contexts begin at ``begin`` with ``starts`` positions."""
    key = _prefix_keys(np.concatenate([buf, np.zeros(2 * depth + 8, dtype=np.uint8)]))
    out = np.zeros(len(buf), dtype=np.int32)
    order = np.argsort(-starts, kind="stable")
    begin, starts = begin[order], starts[order]
    h = np.zeros(len(begin), dtype=np.int64)
    prior = np.full(len(begin), -2)
    offsets = np.append(np.arange(0, depth - 8, 8), depth - 8)
    edges = np.uint64(1) << np.arange(56, 0, -8, dtype=np.uint64)
    later = np.arange(0, depth, 8)
    down = -starts
    for t in range(int(starts[0]) if len(starts) else 0):
        live = int(np.searchsorted(down, -t, side="left"))  # contexts with more than t starts
        i = begin[:live] + t
        p = before[i]
        # The last match, moved on by one, bounds this one from below if it is a window start too.
        keep = (prior[:live] >= 0) & (before[np.maximum(prior[:live] + 1, 0).clip(max=len(before) - 1)] > -2)
        h = h[:live]
        full = np.flatnonzero(keep & (h == depth) & (p >= 0))
        h = np.where(keep & (h < depth), np.maximum(h - 1, 0), 0)
        if len(full):  # order beyond the depth is unknown: no bound follows, but a whole match is likely
            whole = (key[i[full, None] + offsets] == key[p[full, None] + offsets]).all(axis=1)
            h[full[whole]] = depth
        go = np.flatnonzero((p >= 0) & (h < depth))
        for last in (False, True):
            if last and len(go):  # few have 8 bytes more than their bound: all further words at once, up to the first that differs
                differ = key[(i[go] + h[go])[:, None] + later] != key[(p[go] + h[go])[:, None] + later]
                h[go] += np.where(differ.any(axis=1), 8 * differ.argmax(axis=1), depth)
                h[go] = np.minimum(h[go], depth)
                go = go[h[go] < depth]
            if len(go):
                x = key[i[go] + h[go]] ^ key[p[go] + h[go]]
                same = (x[:, None] < edges[None, :]).sum(axis=1) + (x == 0)
                h[go] = np.minimum(h[go] + same, depth)
                go = go[(same == 8) & (h[go] < depth)]
        h = np.where(p >= 0, h, 0)
        prior = p
        out[i] = h
    return out


def repeated_starts(contexts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over the concatenated contexts: their begins, whether each position is a window start
    that equals another, window starts in suffix order, and where runs of equals begin in it."""
    size = np.array([len(c) for c in contexts], dtype=np.int64)
    begin = np.cumsum(size) - size
    buf = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    starts = size - window + 1
    reach = np.minimum(np.repeat(begin + size, size) - np.arange(len(buf)), window).astype(np.int32)
    sa = suffix_order(buf, window, reach)
    sa = sa[reach[sa] >= window]
    before = np.full(len(buf), -3, dtype=np.int64)  # -3: no window start
    before[sa] = np.concatenate([[-1], sa[:-1]])
    lcp = common_prefixes(buf, before, begin, starts, window)
    same = lcp[sa] >= window
    marked = np.zeros(len(buf), dtype=bool)
    marked[sa] = same | np.append(same[1:], False)
    return begin, marked, sa, ~same


def _ranges(flags: np.ndarray) -> list[dict]:
    """First and last place of every run of set flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"a": int(a), "b": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1, strict=True)]


_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_KEY = ("doc", "digest")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("digest"), F.col(text_col).cast("binary").alias("data"))


def _packed(keyed: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle of a join (a task unpacks them again)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches, 2):
            texts = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([pack(t) if t else t for t in texts], pa.binary()),
                                              pa.array([len(t or b"") for t in texts], pa.int64())], ["doc", "digest", "data", "n_bytes"])

    return keyed.mapInArrow(run, f"doc {keyed.schema['doc'].dataType.simpleString()}, digest bigint, data binary, n_bytes bigint")


def _unpacked(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(t) if t else b"" for t in column.to_pylist()]


def _same_key(a: DataFrame, b: DataFrame):
    return a["doc"].eqNullSafe(b["d"]) & (a["digest"] == b["x"])


def occurrences(keyed: DataFrame, window: int) -> DataFrame:
    """(doc, digest, start, size, gram, context) of every context of every text."""
    kind = keyed.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2, SLICE):
            texts = [t or b"" for t in b.column(2).to_pylist()]
            text, first, last, gram = anchors(texts, window)
            size = last - first + window
            h = xxhash.xxh64_intdigest
            context = np.array([h(texts[t][a:a + n]) for t, a, n in zip(text.tolist(), first.tolist(), size.tolist(), strict=True)], dtype=np.uint64)
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32)),
                 pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))], ["doc", "digest", "start", "size", "gram", "context"])

    return keyed.mapInArrow(run, f"doc {kind}, digest bigint, start int, size int, gram bigint, context bigint")


def _shipped(keyed: DataFrame, mixed: DataFrame) -> DataFrame:
    """One copy of the bytes of every context in ``mixed``."""
    wanted = (mixed.select("holder.doc", "holder.digest", F.struct("holder.start", "size", "gram", "context", "shard", "parts").alias("c"))
              .groupBy(F.col("doc").alias("d"), F.col("digest").alias("x")).agg(F.collect_list("c").alias("wanted")))
    texts = _packed(keyed)
    pairs = texts.join(wanted, _same_key(texts, wanted)).select("data", "wanted", "n_bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 0, SLICE, size=2):
            rows = [(w["shard"], w["gram"], w["context"], w["parts"], t[w["start"]:w["start"] + w["size"]])
                    for t, ws in zip(_unpacked(b.column(0)), b.column(1).to_pylist(), strict=True) for w in ws]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["shard", "gram", "context", "parts", "data"])

    return pairs.mapInArrow(run, "shard bigint, gram bigint, context bigint, parts bigint, data binary")


def _pieces(part: pa.Table, limit: int) -> Iterator[pa.Table]:
    """The contexts of a shard by anchor, about ``limit`` bytes at once; an anchor stays whole."""
    gram = part.column("gram").to_numpy()
    order = np.argsort(gram, kind="stable")
    gram, part = gram[order], part.take(pa.array(order))
    size = pc.binary_length(part.column("data")).to_numpy().astype(np.int64)
    first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])[:len(gram)])
    start = held = 0
    for i, n in zip(first.tolist(), np.add.reduceat(size, first).tolist(), strict=True):
        if held and held + n > limit:
            yield part.slice(start, i - start)
            start, held = i, 0
        held += n
    yield part.slice(start)


def _sharded(shipped: DataFrame, window: int) -> DataFrame:
    """Per context: ranges of marked starts; for contexts of dealt-out anchors also the digests
    (``one``, ``two``) and places of one window per distinct string."""
    windows = pa.list_(pa.struct([("one", pa.int64()), ("two", pa.int64()), ("place", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, 0):
            shard = table.column(0).to_numpy()
            for part in (p for s in np.unique(shard) for p in _pieces(table.filter(pa.array(shard == s)), PIECE)):
                data = part.column(4).to_pylist()
                begin, marked, sa, new = repeated_starts(data, window)
                hot = part.column(3).to_numpy() > 1
                found: list[list[dict]] = [[] for _ in data]
                if hot.any():
                    buf = b"".join(data)
                    heads = sa[new]
                    owner = np.searchsorted(begin, heads, side="right") - 1
                    for p, k in zip(heads[hot[owner]].tolist(), owner[hot[owner]].tolist(), strict=True):
                        w = buf[p:p + window]
                        found[k].append({"one": xxhash.xxh64_intdigest(w) - (1 << 63), "two": xxhash.xxh3_64_intdigest(w) - (1 << 63), "place": p - int(begin[k])})
                ranges = [_ranges(marked[b:b + len(d)]) for b, d in zip(begin.tolist(), data, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(1).combine_chunks(), part.column(2).combine_chunks(), pa.array(ranges, _RANGES), pa.array(found, windows)],
                                                 ["gram", "context", "ranges", "windows"])

    return (shipped.repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(run, "gram bigint, context bigint, ranges array<struct<a:int,b:int>>, "
                             "windows array<struct<one:bigint,two:bigint,place:int>>"))


def _merged(sharded: DataFrame) -> DataFrame:
    """Windows of dealt-out anchors that lie in several shards: (gram, context, ranges)."""
    # A run of equal windows is reported by one context; heads in contexts that are not dealt out need no merge.
    listed = (sharded.filter(F.size("windows") > 0).select("gram", "context", F.explode("windows").alias("w"))
              .select(F.col("w.one").alias("one"), F.col("w.two").alias("two"), "gram", "context", F.col("w.place").alias("place")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, 0):
            one, two = table.column(0).to_numpy(), table.column(1).to_numpy()
            lo, hi = np.searchsorted(one, one, side="left"), np.searchsorted(one, one, side="right")
            twice = np.zeros(len(one), dtype=bool)
            for at in np.flatnonzero(hi - lo > 1).tolist():
                twice[at] = (two[lo[at]:hi[at]] == two[at]).sum() > 1
            t = table.filter(pa.array(twice))
            place = t.column(4).to_pylist()
            yield pa.RecordBatch.from_arrays([t.column(2).combine_chunks(), t.column(3).combine_chunks(),
                                              pa.array([[{"a": p, "b": p}] for p in place], _RANGES)], ["gram", "context", "ranges"])

    return (listed.repartition("one").sortWithinPartitions("one")
            .mapInArrow(run, "gram bigint, context bigint, ranges array<struct<a:int,b:int>>"))


def repeated_ranges(keyed: DataFrame, window: int) -> DataFrame:
    """(d, x, spans): per text the ranges [a, b] of starts of repeated windows, unordered."""
    occ = stored(occurrences(keyed, window), "contexts")
    holder = F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "digest", "start")).alias("holder")
    each = stored(occ.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("times"), F.max("size").alias("size"), holder), "distinct-contexts")
    shared = each.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.sum("size").alias("bytes")).filter("kinds > 1")
    shared = stored(shared.select("gram", F.ceil(F.col("bytes") / SHARD).alias("parts"), "bytes"), "shared-anchors")
    total = shared.agg(F.sum("bytes")).first()[0] or 0
    shards = int(total // SHARD) + 1
    mixed = each.join(shared.select("gram", "parts"), "gram").withColumn(
        "shard", F.pmod(F.xxhash64("gram", F.pmod("context", "parts")), F.lit(shards)))
    sharded = stored(_sharded(_shipped(keyed, mixed), window), "shards")
    whole = (each.filter("times > 1").select("gram", "context", F.array(F.struct(F.lit(0).alias("a"), (F.col("size") - window).alias("b"))).alias("ranges")))
    ranges = (whole.unionByName(sharded.filter(F.size("ranges") > 0).select("gram", "context", "ranges"))
              .unionByName(_merged(sharded)).groupBy("gram", "context").agg(F.flatten(F.collect_list("ranges")).alias("ranges")))
    ranges = stored(ranges, "ranges")  # read back, so that Spark may split a context that very many texts hold
    return (occ.select("doc", "digest", "start", "gram", "context").join(ranges, ["gram", "context"])
            .select("doc", "digest", F.transform("ranges", lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b"))).alias("s"))
            .groupBy(F.col("doc").alias("d"), F.col("digest").alias("x")).agg(F.flatten(F.collect_list("s")).alias("spans")))


def cut_ranges(texts: list[bytes], ranges: pa.ListArray, window: int) -> tuple[pa.ListArray, list[bytes]]:
    """Per text the maximal runs [begin, end) under its windows that start in ``ranges``, and the other bytes."""
    count = pc.fill_null(pc.list_value_length(ranges), 0).to_numpy().astype(np.int64)
    found = ranges.flatten()
    base = np.repeat(np.arange(len(texts)), count) << 32  # places of all texts in one order
    begin = found.field("a").to_numpy() + base
    order = np.argsort(begin)
    begin = begin[order]
    end = np.maximum.accumulate((found.field("b").to_numpy() + base + window)[order])
    first = np.flatnonzero(np.append(True, begin[1:] > end[:-1])[:len(begin)])
    begin, end = begin[first], end[np.append(first[1:], len(end))[:len(first)] - 1]
    offsets = np.searchsorted(begin >> 32, np.arange(len(texts) + 1))
    begin, end = begin & 0xFFFFFFFF, end & 0xFFFFFFFF
    kept = []
    for t, lo, hi in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        kept.append(b"".join(t[x:y] for x, y in zip([0, *end[lo:hi].tolist()], [*begin[lo:hi].tolist(), len(t)], strict=True)) if lo < hi else t)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], ["begin", "end"])), kept


def drop_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes bigint, ``spans`` array<struct<begin, end>> (removed, end exclusive,
    maximal, in order) and ``kept`` binary of every row."""
    keyed = _keyed(docs, id_col, text_col)
    spans = repeated_ranges(keyed, window)
    texts = _packed(keyed)
    pairs = texts.join(spans, _same_key(texts, spans), "left").select("doc", "data", "spans", "n_bytes")
    kind = pairs.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1, SLICE, size=3):
            texts = _unpacked(b.column(1))
            spans, kept = cut_ranges(texts, b.column(2), window)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), spans, pa.array(kept, pa.binary())],
                                             [id_col, "n_bytes", "spans", "kept"])

    return pairs.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")
