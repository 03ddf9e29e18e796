"""FEA10: word vectors in parts (F1)."""

import heapq
import itertools

import numpy as np

from tessera.operators import modeling as md
from tessera.operators import word_vectors as wv


def plain_lengths(counts):
    """Code lengths of a Huffman tree made node by node: their sum over the words of a text is least."""
    heap = [(c, i, (i,)) for i, c in enumerate(counts)]
    length = [0] * len(counts)
    tie = itertools.count(len(counts))
    heapq.heapify(heap)
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        for i in x + y:
            length[i] += 1
        heapq.heappush(heap, (a + b, next(tie), x + y))
    return length


def test_huffman_of_runs_is_a_shortest_code():
    rng = np.random.default_rng(1)
    for counts in ([5], [2, 2], [3, 2, 2], [9, 2, 2, 2, 2, 2], [1] * 7, *(rng.zipf(1.6, n).clip(1, 500).tolist() for n in (10, 57, 300))):
        counts = sorted(counts, reverse=True)
        runs = [(c, len(list(g))) for c, g in itertools.groupby(counts)]
        begin, nodes, bits = wv.paths(np.arange(len(counts)), wv.huffman(runs), len(counts))
        got = [list(zip(nodes[a:b].tolist(), bits[a:b].tolist())) for a, b in zip(begin[:-1], begin[1:])]
        assert sum(c * len(g) for c, g in zip(counts, got)) == sum(c * n for c, n in zip(counts, plain_lengths(counts)))
        assert sum(0.5 ** len(g) for g in got) == 1                     # a full tree
        codes = {tuple(g[::-1]) for g in got}                           # from the root down
        assert len(codes) == len(counts) and all(c[:k] not in codes for c in codes for k in range(1, len(c)))
        assert len({n for g in got for n, _ in g}) == len(counts) - 1   # inner nodes


def test_training_steps_are_skip_gram_with_hierarchical_softmax():
    """One pair at a time in float64, on sentences without repeated words so that no update is stale."""
    rng = np.random.default_rng(3)
    counts = [9, 7, 5, 4, 3, 2, 2, 2]
    tree = wv.huffman([(c, len(list(g))) for c, g in itertools.groupby(counts)])
    begin, nodes, bits = wv.paths(np.arange(8), tree, 8)
    sentences = [rng.permutation(8)[:n] for n in (8, 5, 1, 6)]
    got = wv.start_vectors(np.arange(8), 6, 42) * 50
    x, y = got.astype(np.float64), np.zeros((7, 6))
    moved = wv.train_part(sentences, got, begin, nodes, bits, 1, 1, 1000, np.random.default_rng(0))
    seen = 0
    for s in sentences:
        rate = 0.025 * (1 - seen / 1001)
        seen += len(s)
        for p, w in enumerate(s):
            path, bit = nodes[begin[w]:begin[w + 1]], bits[begin[w]:begin[w + 1]]
            context = [s[q] for q in (p - 1, p + 1) if 0 <= q < len(s)]
            step = [(1 - bit - 1 / (1 + np.exp(-y[path] @ x[c]))) * rate for c in context]
            dy = sum((np.outer(g, x[c]) for g, c in zip(step, context)), np.zeros((len(path), 6)))
            for g, c in zip(step, context):
                x[c] += g @ y[path]
            y[path] += dy
    assert np.allclose(got, x, atol=1e-6) and not np.allclose(got, wv.start_vectors(np.arange(8), 6, 42) * 50, atol=1e-5)
    assert moved[np.concatenate([s for s in sentences if len(s) > 1])].all()


def _skip_gram_tree(rng, n_words):
    counts = sorted((rng.zipf(1.4, n_words).clip(2, 900)).tolist(), reverse=True)
    return wv.paths(np.arange(n_words), wv.huffman([(c, len(list(g))) for c, g in itertools.groupby(counts)]), n_words)


def test_positions_together_add_up_their_steps():
    """The same pairs as one position at a time, in float64: a block's steps start from what was there before it."""
    rng = np.random.default_rng(9)
    begin, nodes, bits = _skip_gram_tree(rng, 200)
    sentences = [rng.permutation(200)[:n] for n in (61, 1, 2, 0, 130, 7)]  # no word repeats within a sentence
    for together, window in ((3, 2), (4, 5), (64, 5), (100, 1)):
        got = wv.start_vectors(np.arange(200), 6, 42) * 50
        x, y = got.astype(np.float64), np.zeros((199, 6))
        wv.train_part(sentences, got, begin, nodes, bits, window, 1, 1000, np.random.default_rng(0), together)
        draws, seen = np.random.default_rng(0), 0
        for s in sentences:
            n, rate = len(s), 0.025 * (1 - seen / 1001)
            seen += n
            reach = window - draws.integers(0, window, n)
            for b in range(0, n, together):
                dx, dy = np.zeros_like(x), np.zeros_like(y)
                for p in range(b, min(n, b + together)):
                    path, bit = nodes[begin[s[p]]:begin[s[p] + 1]], bits[begin[s[p]]:begin[s[p] + 1]]
                    for q in range(max(0, p - reach[p]), min(n, p + reach[p] + 1)):
                        if q != p:
                            step = (1 - bit - 1 / (1 + np.exp(-y[path] @ x[s[q]]))) * rate
                            dx[s[q]] += step @ y[path]
                            dy[path] += np.outer(step, x[s[q]])
                x, y = x + dx, y + dy
        assert np.allclose(got, x, atol=2e-6), (together, window, np.abs(got - x).max())


def test_positions_together_learn_as_well(monkeypatch):
    """a word costs less time in blocks; the words around a word are told apart as well as without."""
    rng = np.random.default_rng(2)
    begin, nodes, bits = _skip_gram_tree(rng, 300)
    topic = rng.integers(0, 6, 300)
    members = [np.flatnonzero(topic == t) for t in range(6)]
    sentences = [rng.choice(members[i % 6], 120) for i in range(240)]
    calls = []
    take = wv.np.tanh
    monkeypatch.setattr(wv.np, "tanh", lambda *a, **k: calls.append(1) or take(*a, **k))
    apart, steps = [], []
    for together in (1, wv.TOGETHER):
        calls.clear()
        v = wv.start_vectors(np.arange(300), 32, 42)
        wv.train_part(sentences, v, begin, nodes, bits, 5, 1, sum(map(len, sentences)), np.random.default_rng(0), together)
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        like = unit @ unit.T
        same = topic[:, None] == topic
        apart.append(like[same].mean() - like[~same].mean())
        steps.append(len(calls))
    assert apart[0] > 0.2 and apart[1] > 0.95 * apart[0], apart
    assert wv.TOGETHER > 1 and steps[1] * wv.TOGETHER == steps[0], steps


def test_words_of_like_contexts_meet_and_reruns_agree(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        kind = "ab"[i % 2]
        rows.append((i, [f"{kind}{k}" for k in rng.integers(0, 8, 40)]))
    df = spark.createDataFrame(rows, "id long, t array<string>").repartition(2)
    one = {r[0]: np.array(r[1]) for r in md.sentence_vectors_w2v(df, "id", "t", size=20, partitions=2).collect()}
    two = {r[0]: np.array(r[1]) for r in md.sentence_vectors_w2v(df.repartition(3), "id", "t", size=20, partitions=2).collect()}
    assert all((one[i] == two[i]).all() for i in one) and len(one) == 600
    unit = {i: v / np.linalg.norm(v) for i, v in one.items()}
    same = np.mean([unit[i] @ unit[i + 2] for i in range(0, 598)])
    other = np.mean([unit[i] @ unit[i + 1] for i in range(0, 599)])
    assert same > other + 0.3


def test_means_zeros_and_parts(spark, monkeypatch):
    """More parts than asked for where they would be large; null, empty and unknown texts; every row comes back."""
    monkeypatch.setattr(wv, "PART_WORDS", 50)
    monkeypatch.setattr(wv, "BUCKET_ROWS", 7)
    rows = [(i, [f"w{i % 5}", f"w{i % 7}", "all"] * 3) for i in range(40)] + [(40, None), (41, []), (42, ["once"]), (None, ["all"]), (None, ["all"])]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    got = md.sentence_vectors_w2v(df, "id", "t", size=8, partitions=2).collect()
    assert len(got) == len(rows)
    by = {r["id"]: np.array(r["sentence_vector"]) for r in got}
    for i in (40, 41, 42):
        assert (by[i] == np.zeros(8)).all()
    assert by[None].any() and np.allclose(by[0], by[35])  # equal words, other parts: one vector a word
    # no word is known: MLlib's Word2Vec raises
    none = md.sentence_vectors_w2v(spark.createDataFrame([(1, ["x"]), (2, ["y", "z"])], "id long, t array<string>"), "id", "t", size=4)
    assert sorted((r[0], r[1]) for r in none.collect()) == [(1, [0.0] * 4), (2, [0.0] * 4)]
