import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard

from tessera.llm import queries as q
from tessera.llm import suffix_shards as ss
from tessera.llm.common import slices


def brute(rows, window=400):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for (i, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, dtype=np.int8)
        for k in range(len(d) - window + 1):
            if seen[d[k:k + window]] > 1:
                gone[k:k + window] = 1
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest(),
                    len(d) - int(gone.sum()), spans > 0))
    return sorted(out, key=str)


def make(rnd, n):
    return "".join(rnd.choice("abcdeé ñ") for _ in range(n))


def rows_of(seed):
    rnd = random.Random(seed)
    passage, other = make(rnd, 700), make(rnd, 330)
    rows = [(i, make(rnd, rnd.randrange(900)) + (passage if i % 3 else passage[:450]) + make(rnd, rnd.randrange(900))) for i in range(25)]
    base = make(rnd, 3000)
    for i in range(100, 115):  # near copies
        k = rnd.randrange(3000)
        rows.append((i, base[:k] + rnd.choice("xyz") + base[k + 1:]))
    rows += [(200, base), (201, base), (202, base[500:899]), (203, base[500:901]), (300, None), (301, ""), (302, "a" * 2500), (303, "ab" * 900),
             (304, make(rnd, 399)), (305, other + other), (306, other + other), (None, passage), (None, None), (200, base), (200, "same id, other text"),
             (307, ("0123456789" * 30 + "\n") * 4), (308, passage[100:420] + make(rnd, 300))]
    return rows


def run(spark, table_dir, docs):
    return sorted(map(tuple, q.op9_suffix_shards(spark, table_dir(documents=docs)).collect()), key=str)


def test_traps(spark, docs_of, table_dir):
    assert run(spark, table_dir, docs_of(rows_of(1))) == brute(rows_of(1))


def test_dealt_out_anchors_are_merged(spark, docs_of, table_dir, monkeypatch):
    monkeypatch.setattr(ss, "SHARD", 3000)  # every anchor with a few contexts is spread over shards
    assert run(spark, table_dir, docs_of(rows_of(2))) == brute(rows_of(2))


def test_empty(spark, docs_of, table_dir):
    assert run(spark, table_dir, docs_of([])) == []


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, q.op9_suffix_shards(spark, sf).collect()), key=str) == brute(rows)


def test_suffix_order_and_common_prefixes():
    rnd = np.random.default_rng(4)
    for depth in (9, 16, 37):
        contexts = [bytes(rnd.integers(97, 99, size=int(n)).astype(np.uint8)) for n in rnd.integers(depth, 120, size=30)]
        contexts += [contexts[0], contexts[1][:depth], b"a" * 90]
        begin, marked, sa, new = ss.repeated_starts(contexts, depth)
        buf = b"".join(contexts)
        own = [int(b) + i for b, c in zip(begin, contexts) for i in range(len(c) - depth + 1)]
        assert sorted(sa.tolist()) == own
        words = [buf[p:p + depth] for p in sa]
        assert words == sorted(words)
        count = Counter(words)
        assert [bool(marked[p]) for p in sa] == [count[w] > 1 for w in words]
        assert new.tolist() == [i == 0 or words[i] != words[i - 1] for i in range(len(words))]


def test_anchors_cover_every_window_once():
    rnd = random.Random(3)
    texts = [make(rnd, n).encode() for n in (0, 399, 400, 401, 2000, 5000)] + [b"a" * 1000]
    text, first, last, gram = ss.anchors(texts, 400)
    starts = sorted((int(t), s) for t, a, b in zip(text, first, last) for s in range(a, b + 1))
    assert starts == [(t, s) for t, x in enumerate(texts) for s in range(len(x) - 399)]
    by_window = {}
    for t, a, b, g in zip(text, first, last, gram):
        for s in range(a, b + 1):
            assert by_window.setdefault(texts[t][s:s + 400], int(g)) == int(g)


def test_small_pieces(spark, docs_of, table_dir, monkeypatch):
    monkeypatch.setattr(ss, "PIECE", 1500)  # every anchor with a few contexts is a piece of its own
    assert run(spark, table_dir, docs_of(rows_of(4))) == brute(rows_of(4))


def test_pieces_hold_whole_anchors():
    rnd = random.Random(5)
    rows = [(g, bytes(rnd.randrange(400, 900))) for g in (7, -3, 12, 5) for _ in range(9)] + [(99, bytes(8000))]
    rnd.shuffle(rows)
    part = pa.table({"gram": [g for g, _ in rows], "data": pa.array([d for _, d in rows], pa.binary())})
    pieces = [p.to_pylist() for p in ss._pieces(part, 7000)]
    grams = [g for p in pieces for g in {r["gram"] for r in p}]
    assert len(grams) == len(set(grams)) == 5 and len(pieces) > 2
    assert all(sum(len(r["data"]) for r in p) <= 7000 or len({r["gram"] for r in p}) == 1 for p in pieces)
    assert sorted((r["gram"], r["data"]) for p in pieces for r in p) == sorted(rows)


def test_a_shard_is_sorted_in_little_memory():
    rnd = np.random.default_rng(6)
    rows = []
    for g in range(250):  # near copies of 250 anchors' contexts, 2 MB
        base = rnd.integers(97, 123, size=800).astype(np.uint8)
        for k in range(10):
            copy = base.copy()
            copy[40 * k] = 35
            rows.append((g, copy.tobytes()))
    part = pa.table({"gram": [g for g, _ in rows], "data": pa.array([d for _, d in rows], pa.binary())})
    tracemalloc.start()
    found = {}
    for piece in ss._pieces(part, ss.PIECE):
        data = piece.column("data").to_pylist()
        begin, marked, _, _ = ss.repeated_starts(data, 400)
        found |= {d: marked[b:b + 401] for b, d in zip(begin.tolist(), data)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # the shard at once took 150 MB and more
    count = Counter(d[i:i + 400] for _, d in rows for i in range(401))
    assert all((found[d] == [count[d[i:i + 400]] > 1 for i in range(401)]).all() for _, d in rows)


def test_compressed_texts_are_cut_by_their_bytes():
    texts = [b"a" * (1 << 20)] * 8 + [b"", None, b"b" * 10]
    packed = pa.array([zstandard.compress(t) if t else t for t in texts], pa.binary())
    batch = pa.RecordBatch.from_arrays([packed, pa.array([len(t or b"") for t in texts], pa.int64())], ["data", "n_bytes"])
    cut = list(slices([batch], 0, 2 << 20, size=1))
    assert sum(b.num_rows for b in cut) == 11 and all(sum(b.column(1).to_pylist()) <= 2 << 20 for b in cut)


def test_cut_ranges():
    rnd = random.Random(7)
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    texts = [make(rnd, n).encode() for n in (0, 50, 300, 301, 302, 900, 5)]
    ranges = [None, [], *([{"a": a, "b": a + rnd.randrange(3)} for a in (rnd.randrange(len(t) - 12) for _ in range(14))] for t in texts[2:6]), None]
    for lo, hi in ((0, 7), (3, 6), (0, 1)):  # slices too
        spans, kept = ss.cut_ranges(texts[lo:hi], pa.array(ranges, kind).slice(lo, hi - lo), 10)
        for t, r, s, k in zip(texts[lo:hi], ranges[lo:hi], spans.to_pylist(), kept, strict=True):
            gone = np.zeros(len(t) + 1, dtype=np.int8)
            for x in r or []:
                gone[x["a"]:x["b"] + 10] = 1
            edge = np.diff(np.concatenate([[0], gone]))
            assert s == [{"begin": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
            assert k == bytes(c for c, g in zip(t, gone) if not g)


def test_very_many_ranges_are_cut_in_little_memory():
    n = 400_000  # a text that repeats one byte has a range for every byte
    place = pa.array(np.arange(n, dtype=np.int32)[::-1])
    ranges = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.StructArray.from_arrays([place, place], ["a", "b"]))
    tracemalloc.start()
    spans, kept = ss.cut_ranges([b"a" * (n + 400)], ranges, 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert spans.to_pylist() == [[{"begin": 0, "end": n + 399}]] and kept == [b"a"]
    assert peak < 48 << 20  # a dictionary for each took over 90 MB
