"""Skip-gram word vectors (FEA10) whose tables lie in parts over the executors.

MLlib's Word2Vec holds the vocabulary and both tables on the driver and sends them
whole to every task.  Its method needs neither: each part of the texts starts from the
same vectors, learns from its own sentences, and a word's vectors are averaged over
the parts that moved it.  So

1. texts are dealt to parts of about ``PART_WORDS`` words; words are counted by part
   and numbered by falling count;
2. the Huffman tree of the hierarchical softmax is built from the histogram of counts
   (``huffman``): words of one count merge as runs, so the driver holds as many rows as
   there are different counts, not words;
3. a part meets its own words, starts them at vectors hashed from their numbers and
   inner nodes at zero, and trains (``train_part``);
4. a word's vectors meet by its number, their mean goes back to the parts that hold it,
   and each part averages its texts.

A task holds the words of one part and the tree's nodes above them.
"""

from __future__ import annotations

import json
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import stored

#: Words of text in a part, about (a text is not cut).
PART_WORDS = 1 << 22
#: Vectors averaged at once.
BUCKET_ROWS = 1 << 16
#: Rows of an Arrow batch of vectors.
BATCH = 8192
# ---- fixed values of MLlib's Word2Vec -------------------------------------------
RATE, SENTENCE = 0.025, 1000
# -----------------------------------------------------------------------------
#: Positions trained on one copy of their vectors; a word's changes at several of them add up.
BLOCK = 64
#: Positions whose steps start from the same vectors and add up.
TOGETHER = 4
#: Positions whose paths are laid out at once, about.
GROUP = 2048
SCALE = np.float32(0.5 ** 0.5)


def huffman(runs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree over leaves numbered by falling count, given as runs (count, how many) in that order.

    Inner nodes are numbered on from the leaves in the order they are made; the last is the root.
    Returned: first node, first parent and first bit of stretches of nodes; node ``first + i`` has the
    parent ``parent + (i + bit) // 2`` and the code bit ``(i + bit) % 2``."""
    total = sum(n for _, n in runs)
    leaves, inner, at = deque(), deque(), total
    for count, n in reversed(runs):  # rising counts
        at -= n
        leaves.append((count, at, n))
    stretches = []
    made = total

    def smallest():
        if not leaves or inner and inner[0][0] < leaves[0][0]:
            return inner.popleft() if inner else None
        return leaves.popleft()

    while (run := smallest()) is not None:
        weight, first, n = run
        if n > 1:
            pairs = n // 2
            stretches.append((first, made, 0))
            inner.append((2 * weight, made, pairs))
            made, first, n = made + pairs, first + 2 * pairs, n % 2
        if n:
            # What was just made is not lighter than anything left, so it waits its turn.
            other = smallest()
            if other is None:
                break
            stretches += [(first, made, 0), (other[1], made, 1)]
            inner.append((weight + other[0], made, 1))
            made += 1
            if other[2] > 1:
                (leaves if other[1] < total else inner).appendleft((other[0], other[1] + 1, other[2] - 1))
    stretches.sort()
    return tuple(np.array([s[i] for s in stretches], dtype=np.int64) for i in range(3))


def paths(index: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray], total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, nodes, bits): word ``i`` has the inner nodes ``nodes[begin[i]:begin[i + 1]]`` above it."""
    first, parent, bit = tree
    word, node = np.arange(len(index)), index.astype(np.int64)
    owners, ups, bits = [], [], []
    while len(first) and len(word):
        s = np.searchsorted(first, node, side="right") - 1
        off = node - first[s] + bit[s]
        node = parent[s] + off // 2
        owners.append(word)
        ups.append(node - total)
        bits.append((off % 2).astype(np.float32))
        below = node < 2 * total - 2
        word, node = word[below], node[below]
    if not owners:
        return np.zeros(len(index) + 1, dtype=np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(index)))])
    return begin, np.concatenate(ups)[order], np.concatenate(bits)[order]


def start_vectors(index: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Uniform in +-0.5 / size, from a hash of (seed, word number, place): equal in all parts."""
    out = np.empty((len(index), size), dtype=np.float32)
    key = np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for a in range(0, len(index), BATCH):
        h = index[a:a + BATCH].astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64) + key
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(factor)
        h ^= h >> np.uint64(31)
        out[a:a + BATCH] = ((h >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(size)
    return out


def _group_steps(words: np.ndarray, lengths: np.ndarray, begin: np.ndarray, at: np.ndarray, half: np.ndarray, wide: int, together: int,
                 window: int, reach: np.ndarray, rate: np.ndarray):
    """What the positions of some sentences (``words``, ``lengths`` each) want of the nodes above them, by blocks
    of ``together`` positions of one sentence: (cut, node, want, half_count).

    Block ``k`` has the distinct nodes ``node[cut[k]:cut[k + 1]]``.  ``want[k, r, c]`` is the sum of rate * (half - bit)
    over its positions that have the block's row ``r`` (from ``window`` before its first position on) around them and node ``c`` above
    them, ``half_count[k, r, c]`` that of rate / 2."""
    counts = -(-lengths // together)
    blocks = int(counts.sum())
    at_sentence = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    block, slot = np.repeat(np.cumsum(counts) - counts, lengths) + at_sentence // together, at_sentence % together
    far = np.abs(np.arange(together + 2 * window)[:, None] - window - np.arange(together))
    far[far == 0] = window + 1  # the word itself is not in its context
    reaches = np.zeros((blocks, together), dtype=np.int64)
    reaches[block, slot] = reach
    near = (far <= reaches[:, None, :]) * np.repeat(rate, counts).astype(np.float32)[:, None, None]
    steps = (begin[1:] - begin[:-1])[words]
    total = int(steps.sum())
    of = np.repeat(np.arange(len(words)), steps)
    path = np.arange(total) + np.repeat(begin[words] - (np.cumsum(steps) - steps), steps)
    bits = total.bit_length()
    order = np.sort(((block[of] * wide + at[path]) << bits) | np.arange(total))
    key = order >> bits
    order &= (1 << bits) - 1
    new = np.ones(total, dtype=bool)
    new[1:] = key[1:] != key[:-1]
    column, key = np.cumsum(new) - 1, key[new]
    cut = np.searchsorted(key // wide, np.arange(blocks + 1))
    sums = np.zeros((2, blocks, together, int((cut[1:] - cut[:-1]).max())), dtype=np.float32)
    k, place = block[of[order]], slot[of[order]]
    column -= cut[k]
    sums[0, k, place, column] = half[path[order]]
    sums[1, k, place, column] = 0.5
    want, half_count = np.matmul(near, sums)
    return cut.tolist(), key % wide, want, half_count


def train_part(sentences: list[np.ndarray], vectors: np.ndarray, begin: np.ndarray, nodes: np.ndarray, bits: np.ndarray,
               window: int, parts: int, total_words: int, rng: np.random.Generator, together: int = 1) -> np.ndarray:
    """Trains ``vectors`` in place on sentences of row numbers; returns which rows moved.

    For each position the vectors of the words around it learn to predict its path; the
    rate falls with the share of words seen, as in MLlib.  The steps of ``together`` positions
    that follow each other start from the same vectors and add up: with 1, each position
    sees what those before it changed."""
    moved = np.zeros(len(vectors), dtype=bool)
    distinct, at = np.unique(nodes, return_inverse=True)
    if not len(distinct):
        return moved
    inner = np.zeros((len(distinct), vectors.shape[1]), dtype=np.float32)
    half = np.float32(0.5) - bits
    block = max(1, BLOCK // together) * together
    vectors *= SCALE  # so is inner: a product of the two is half the true one, and steps need no factor
    seen = first = 0
    while first < len(sentences):
        last, size = first + 1, len(sentences[first])
        while last < len(sentences) and size + len(sentences[last]) <= GROUP:
            size += len(sentences[last])
            last += 1
        group, first = sentences[first:last], last
        if not size:
            continue
        lengths = np.array([len(s) for s in group])
        before = seen + np.cumsum(lengths) - lengths
        seen += size
        rate = np.maximum(RATE * (1 - parts * before / (total_words + 1)), RATE * 1e-4)
        reach = window - np.concatenate([rng.integers(0, window, n) for n in lengths.tolist()])
        cut, node, want, half_count = _group_steps(np.concatenate(group), lengths, begin, at, half, len(distinct), together, window, reach, rate)
        k = 0
        for sentence in group:
            n = len(sentence)
            for b in range(0, n, block):
                lo, end = max(0, b - window), min(n, b + block)
                rows = sentence[lo:end + window]
                was = vectors.take(rows, axis=0)
                now = was.copy()
                for p in range(b, end, together):
                    i, j = max(0, p - window), min(n, p + together + window)
                    c = cut[k + 1] - cut[k]
                    path = node[cut[k]:cut[k + 1]]
                    x, y = now[i - lo:j - lo], inner.take(path, axis=0)
                    g = x @ y.T
                    np.tanh(g, g)
                    i, j = i - p + window, j - p + window
                    np.multiply(half_count[k, i:j, :c], g, g)
                    np.subtract(want[k, i:j, :c], g, g)  # rate * (1 - bit - sigmoid(x . y)), added up
                    dx = g @ y
                    y += g.T @ x
                    inner[path] = y
                    x += dx
                    k += 1
                now -= was
                np.add.at(vectors, rows, now)
            if n > 1:
                moved[sentence] = True
    vectors /= SCALE
    return moved


def _binary(vectors: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * vectors.shape[1]), len(vectors), [None, pa.py_buffer(np.ascontiguousarray(vectors))]).cast(pa.binary())


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    out = np.zeros((len(column), size), dtype=np.float32)
    for i, v in enumerate(column):
        out[i] = np.frombuffer(v.as_buffer(), dtype=np.float32)
    return out


def _batched(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(table.to_batches(max_chunksize=BATCH), table.schema)


def sentence_vectors(tokens_df: DataFrame, id_col: str, tokens: str, size: int = 100, window: int = 5, min_count: int = 2,
                     seed: int = 42, partitions: int | None = None) -> DataFrame:
    """FEA10: (``id_col``, sentence_vector array<double>): the mean of a text's *known* words' vectors, zeros
    where it has none; words seen less than ``min_count`` times are unknown.  One row per input row."""
    spark = tokens_df.sparkSession
    # As JSON a text's words take a third of the room that an array of strings takes in a shuffle.
    texts = stored(tokens_df.select(id_col, F.to_json(tokens).alias("__json"), F.size(tokens).alias("__size")))
    words_of_all = texts.agg(F.sum(F.greatest("__size", F.lit(0)))).first()[0] or 0
    parts = max(partitions or tokens_df.rdd.getNumPartitions(), -(-words_of_all // PART_WORDS))
    # A part's rows lie in one file, so that words are counted by part before they move; equal texts of
    # equal id aside, their hash orders a part's texts alike in every run.
    texts = texts.drop("__size").withColumn("__hash", F.xxhash64(id_col, "__json"))
    texts = stored(texts.withColumn("__part", F.pmod("__hash", F.lit(parts)).cast("int")).repartition(parts, "__part"))
    by_part = stored(texts.select("__part", F.explode(F.from_json("__json", "array<string>")).alias("__word")).where("__word IS NOT NULL")
                     .groupBy("__part", "__word").agg(F.count(F.lit(1)).alias("__n")))
    words = by_part.groupBy("__word").agg(F.sum("__n").alias("__n")).where(F.col("__n") >= min_count)
    words = stored(words.repartitionByRange(parts, F.desc("__n"), "__word").sortWithinPartitions(F.desc("__n"), "__word")
                   .withColumn("__row", F.monotonically_increasing_id()))
    # Of each partition of the order and each count in it one row comes to the driver, of the words none.
    task = F.shiftright("__row", 33).cast("int")
    histogram = [tuple(r) for r in words.groupBy(task.alias("t"), "__n").agg(F.count(F.lit(1)).alias("n")).orderBy("t", F.desc("__n")).collect()]
    first, runs, total = {}, [], 0
    for t, count, n in histogram:
        first.setdefault(t, total)
        total += n
        if runs and runs[-1][0] == count:
            runs[-1] = (count, runs[-1][1] + n)
        else:
            runs.append((count, n))
    train_words = sum(c * n for c, n in runs)
    tree = huffman(runs)
    begins = spark.createDataFrame(sorted(first.items()), "__task int, __first bigint")
    numbered = words.withColumn("__task", task).join(F.broadcast(begins), "__task").select(
        "__word", (F.col("__first") + F.col("__row").bitwiseAND((1 << 33) - 1)).alias("__index"))
    held = by_part.select("__part", "__word").join(numbered, "__word")

    def known(texts_column: pa.ChunkedArray, row_of: dict[str, int]) -> list[np.ndarray]:
        return [np.array([r for r in map(row_of.get, t) if r is not None], dtype=np.int64)
                for chunk in texts_column.chunks for t in map(json.loads, pc.fill_null(chunk, "[]").to_pylist())]

    # No type hints on these three: Spark would read them.
    def train(key, left, right):
        index = left.column("__index").to_numpy()
        row_of = {w: r for r, w in enumerate(left.column("__word").to_pylist())}
        rows = known(right.column("__json"), row_of)
        rows = [rows[i] for i in np.argsort(right.column("__hash").to_numpy(), kind="stable").tolist()]
        sentences = [s[a:a + SENTENCE] for s in rows for a in range(0, len(s), SENTENCE)]
        vectors = start_vectors(index, size, seed)
        part = key[0].as_py() if len(key) else 0
        moved = train_part(sentences, vectors, *paths(index, tree, total), window, parts, train_words, np.random.default_rng([seed, part]), TOGETHER)
        return _batched(pa.table({"__part": pa.array(np.full(len(index), part, dtype=np.int32)), "__word": left.column("__word").cast(pa.string()),
                                  "__index": left.column("__index"), "__moved": pa.array(moved), "__vector": _binary(vectors)}))

    def mean(key, table):
        index, moved = table.column("__index").to_numpy(), table.column("__moved").to_numpy()
        vectors = _matrix(table.column("__vector"), size).astype(np.float64)
        _, group, n = np.unique(index, return_inverse=True, return_counts=True)
        moves = np.bincount(group, weights=moved)
        # A word that no part moved has its start everywhere.
        weight = np.where(moves[group] > 0, moved / np.maximum(moves, 1)[group], 1 / n[group])
        order = np.lexsort((table.column("__part").to_numpy(), group))
        sums = np.add.reduceat((vectors * weight[:, None])[order], np.cumsum(n) - n)
        return _batched(table.select(["__part", "__word"]).append_column("__vector", _binary(sums[group].astype(np.float32))))

    def average(key, left, right):
        vectors = _matrix(left.column("__vector"), size)
        row_of = {w: r for r, w in enumerate(left.column("__word").to_pylist())}
        out = np.zeros((right.num_rows, size))
        for i, rows in enumerate(known(right.column("__json"), row_of)):
            if len(rows):
                out[i] = vectors[rows].mean(axis=0, dtype=np.float64)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, size, dtype=np.int32)), pa.array(out.ravel()))
        return _batched(pa.table({id_col: right.column(id_col), "sentence_vector": flat}))

    kind = tokens_df.schema[id_col].dataType.simpleString()
    dealt = texts.repartition(parts, "__part")
    trained = held.repartition(parts, "__part").groupBy("__part").cogroup(dealt.select("__part", "__hash", "__json").groupBy("__part")).applyInArrow(
        train, "__part int, __word string, __index bigint, __moved boolean, __vector binary")
    buckets = max(1, -(-by_part.count() // BUCKET_ROWS))
    means = trained.withColumn("__bucket", F.pmod("__index", F.lit(buckets))).groupBy("__bucket").applyInArrow(mean, "__part int, __word string, __vector binary")
    return means.repartition(parts, "__part").groupBy("__part").cogroup(dealt.groupBy("__part")).applyInArrow(
        average, f"`{id_col}` {kind}, sentence_vector array<double>")
