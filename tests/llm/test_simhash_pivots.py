import random
import re

import numpy as np
import xxhash

from tessera.llm import queries as q
from tessera.llm import simhash_pivots as sp


def brute(rows, words=3, max_bits=3):
    """{(id, text): (fingerprint, smallest id reachable)} by comparing everything."""
    fp = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")))
        sh = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fp.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    lab = list(range(len(rows)))

    def root(i):
        while lab[i] != i:
            i = lab[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= max_bits:
                lab[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return sorted([(d, f"{fp[i]:016x}", low.get(root(i))) for i, (d, _) in enumerate(rows)], key=str)


def found(spark, table_dir, docs):
    return sorted(map(tuple, q.op4_simhash_pivots(spark, table_dir(documents=docs)).collect()), key=str)


def test_traps(spark, docs_of, table_dir):
    base = " ".join(f"w{i % 37}" for i in range(400))
    rows = [(9, base), (4, base), (7, base + " tail"), (2, None), (5, ""), (6, " \t\n"), (8, "one"), (1, "One two"), (3, "one\x0btwo"),
            (12, "one two"), (11, "É é"), (13, "é é"), (None, base), (20, "Straße " * 5000), (4, base), (30, "x\x85y z"), (31, "x\x85y Z")]
    assert found(spark, table_dir, docs_of(rows)) == brute(rows)


def test_empty(spark, docs_of, table_dir):
    assert found(spark, table_dir, docs_of([])) == []


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, q.op4_simhash_pivots(spark, sf).collect()), key=str) == brute(rows)


def test_links_lose_no_connection_in_chunked_buckets(spark, monkeypatch):
    """Dense ball of fingerprints, buckets far above the chunk size."""
    monkeypatch.setattr(sp, "CHUNK", 8)
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(4)]
    fps = {b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(9))) for b in base for _ in range(60)}
    fps = [f & (1 << 64) - 1 for f in fps]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = sp.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), 3).collect()
    lab = {f: f for f in fps}

    def root(m, x):
        while m[x] != x:
            x = m[x]
        return x

    other = dict(lab)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                lab[root(lab, a)] = root(lab, b)
    for u, v in got:
        a, b = u & (1 << 64) - 1, v & (1 << 64) - 1
        assert (a ^ b).bit_count() <= 3
        other[root(other, a)] = root(other, b)
    groups = lambda m: sorted(sorted(x for x in fps if root(m, x) == r) for r in {root(m, x) for x in fps})
    assert groups(lab) == groups(other)


def test_masks_cover_every_pair_within_the_distance():
    masks = [m & (1 << 64) - 1 for m in sp.block_masks(3)]
    rnd = np.random.default_rng(1)
    for _ in range(2000):
        bits = rnd.choice(64, 3, replace=False)
        d = sum(1 << int(b) for b in bits)
        assert any(d & m == 0 for m in masks)


def test_one_per_group(spark, docs_of):
    base = " ".join(f"w{i % 37}" for i in range(400))
    rows = [(4, base), (2, base + " tail"), (2, base + " tail"), (5, "quite another text here"), (5, base), (None, base), (None, None)]
    got = sp.one_per_group(docs_of(rows))
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(
        [(2, base + " tail"), (5, "quite another text here"), (None, None)], key=str)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
