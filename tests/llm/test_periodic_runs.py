import hashlib
import random
import zlib

import numpy as np
import pytest

from tessera.llm import periodic_runs as pr
from tessera.llm import queries as q


def brute_runs(words, min_words=6, min_exponent=4):
    """All runs by trying every period."""
    ids = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], dtype=np.int64)
    n, best = len(w), {}
    for p in range(1, n // min_exponent + 1):
        same = np.concatenate([[False], w[p:] == w[:-p], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            s, e = a, b + p
            if e - s >= max(min_words, min_exponent * p):
                best.setdefault((s, e), p)  # periods ascend: the first is the smallest
    return sorted((s, e - s, p) for (s, e), p in best.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [x for i, x in enumerate(words) if i not in gone]


def split(text):
    return [x.decode() for x in (text or "").encode().split()]


def expected(rows, made=lambda i, w: w):
    out = []
    for i, text in rows:
        words = made(i, split(text))
        runs = brute_runs(words)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
        out.append((i, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
                    hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
                    hashlib.sha256(" ".join(brute_collapsed(words, runs)).encode()).hexdigest()))
    return sorted(out, key=str)


def periodic(i, words):
    if i is None or not words:
        return words
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (k - a) % p] for k in range(a, n)]


def _random_texts():
    rnd = random.Random(5)
    for _ in range(300):
        yield " ".join(rnd.choice("ab"[:rnd.randint(1, 2)]) for _ in range(rnd.randint(0, 60)))
    for _ in range(300):
        parts = []
        while len(parts) < rnd.randint(1, 120):
            base = [rnd.choice("abcd") for _ in range(rnd.randint(1, 12))]
            parts += base * rnd.randint(1, 6)
            parts = parts[:rnd.randint(len(parts) // 2, len(parts))]
        yield " ".join(parts)


def test_batches_of_random_texts_match_brute_force():
    texts = list(_random_texts())
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        n, runs, collapsed = (c.to_pylist() for c in pr._batch(part, 6, 4))
        for t, k, r, c in zip(part, n, runs, collapsed):
            words = split(t)
            want = brute_runs(words)
            assert k == len(words) and [(x["start"], x["length"], x["period"]) for x in r] == want, t
            assert c == " ".join(brute_collapsed(words, want))


def test_wavelet_tree_selects_like_sorting():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 500):
        v = rnd.permutation(n)
        bits = max(1, (n - 1).bit_length())
        tree = pr.WaveletTree(v, bits)
        lo = rnd.integers(0, n, 40)
        hi = np.array([rnd.integers(a + 1, n + 1) for a in lo])
        k = np.array([rnd.integers(0, b - a) for a, b in zip(lo, hi)])
        got = tree.select(lo, hi, k, np.zeros(40, dtype=np.int64), bits)
        assert got.tolist() == [sorted(v[a:b].tolist())[j] for a, b, j in zip(lo, hi, k)]


CASES = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "x\ta\nb a\x0bb a\x0cb a\r b y"), (7, "a b a b a b a b"),
         (7, "a b a b a b a b"), (None, "a a a a a a a"), (8, "ä ß ä ß ä ß ä ß"), (9, "a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a"),
         (10, "b b b b b b b b a a a a a a"), (11, "one " * 40), (12, "word")]


def test_defined_cases(docs_of):
    got = pr.digests(pr.periodic_runs(docs_of(CASES))).collect()
    assert sorted(map(tuple, got), key=str) == expected(CASES)


def test_empty_table(docs_of):
    assert pr.digests(pr.periodic_runs(docs_of([]))).count() == 0


def test_very_long_texts(docs_of):
    rnd = random.Random(1)
    once = [str(rnd.random()) for _ in range(30_000)]
    texts = [(1, "same " * 300_000), (2, " ".join(once * 5)), (3, " ".join(once[:7] * 20_000))]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in pr.periodic_runs(docs_of(texts)).select("doc_id", "runs").collect()}
    assert got == {1: [(0, 300_000, 1)], 2: [(0, 150_000, 30_000)], 3: [(0, 140_000, 7)]}


def test_small_exponents_are_refused(docs_of):
    with pytest.raises(ValueError):
        pr.periodic_runs(docs_of([(1, "a")]), min_exponent=3)


def test_whole_table_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = q.op13_word_runs(spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, periodic)
