import math
import re
import zlib
from collections import Counter

import numpy as np

from tessera.llm import hmm_lm as h
from tessera.llm import queries as q


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))) + [""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base(rows):
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return c, n, [(i, held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                   sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t))) for i, t in rows]


def check(rows, got):
    _, _, want = base(rows)
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 5))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5])), (a, b)
        assert math.isfinite(a[6]) and a[6] < 0


def test_traps(spark, docs_of, table_dir, monkeypatch):
    rows = [(i, " ".join(f"{'AB'[i % 2]}w{(i * k) % 23}" for k in range(i % 30))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (None, "Null id words"), (5, rows[5][1]), (103, "x" * 300 + " É é\x85 y"), (104, "x" * 300),
             (105, "long text " * 20_000), (9, "never-seen unknown")]
    d = table_dir(documents=docs_of(rows))
    check(rows, q.op2_hmm_score(spark, d).collect())


def test_small_lookup_joins_the_rest(spark, docs_of, monkeypatch):
    """Few looked-up tokens and symbols: counts and likelihoods still cover every token."""
    real = h.lookup_of

    def small(vocab):
        lk = real(vocab)
        keep = 5
        return h.Lookup({w: i for w, i in lk.index.items() if i < keep}, lk.count[:keep], lk.symbol[:keep], lk.class_total, lk.total, lk.distinct)

    rows = [(i, " ".join(f"w{(i * k) % 23}" for k in range(i % 30))) for i in range(60)] + [(61, "w1 w1 w2"), (61, "w1 w1 w2")]
    full = {(r.doc_id, r.n_tokens): r for r in h.score_texts(docs_of(rows), rounds=1).collect()}
    monkeypatch.setattr(h, "lookup_of", small)
    few = h.score_texts(docs_of(rows), rounds=1).collect()
    assert len(few) == len(rows)
    for r in few:
        want = full[r.doc_id, r.n_tokens]
        assert r.n_known == want.n_known and abs(r.base_score - want.base_score) < 1e-6


def test_empty_and_untrained(spark, docs_of, table_dir):
    assert q.op2_hmm_score(spark, table_dir(documents=docs_of([]))).collect() == []
    i = next(i for i in range(100) if held(i))
    r = q.op2_hmm_score(spark, table_dir(documents=docs_of([(i, "a b")]))).collect()
    assert [(x.n_tokens, x.n_known, x.train_tokens) for x in r] == [(3, 0, 0)] and r[0].base_score == 0


def test_forward_and_expected_counts_against_enumeration():
    rnd = np.random.default_rng(2)
    k, v = 3, 5
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    m = h.Hmm(norm(rnd.random(k), 0), norm(rnd.random((k, k)), 1), norm(rnd.random((v, k)), 0))
    seqs = [rnd.integers(0, v, size=n) for n in (4, 1, 6, 3)]
    p = h._Packed(seqs)
    emit, alpha, scale = p.forward(m)
    ll = p.loglik(scale)
    moves, share = p.expected(m, emit, alpha, scale)
    counts = np.zeros((v, k))
    np.add.at(counts, p.symbols, share)
    want_moves, want_counts = np.zeros((k, k)), np.zeros((v, k))
    from itertools import product
    for s, got in zip(seqs, ll, strict=True):
        paths = {z: m.start[z[0]] * np.prod([m.move[a, b] for a, b in zip(z, z[1:])]) * np.prod([m.emit[o, a] for o, a in zip(s, z)])
                 for z in product(range(k), repeat=len(s))}
        total = sum(paths.values())
        assert abs(math.log(total) - got) < 1e-5
        for z, w in paths.items():
            for a, b in zip(z, z[1:]):
                want_moves[a, b] += w / total
            for o, a in zip(s, z):
                want_counts[o, a] += w / total
    assert np.allclose(moves, want_moves, atol=1e-4) and np.allclose(counts, want_counts, atol=1e-4)


def test_probabilities_sum_to_one():
    """Over all known tokens and one unknown per class, given a symbol."""
    c = Counter({b"aaa": 3, b"baaa": 2, b"zz": 1})
    total = Counter()
    for w, n in c.items():
        total[h.class_of(w)] += n + 1
    for k, t in total.items():
        assert abs(sum((n + 1) / (t + 1) for w, n in c.items() if h.class_of(w) == k) + 1 / (t + 1) - 1) < 1e-12


def test_training_climbs_and_beats_the_base_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = q.op2_hmm_score(spark, sf).collect()
    check(rows, got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.97 * sum(r.base_score for r in out) and sum(r.score for r in out) > sum(r.base_score for r in out)
