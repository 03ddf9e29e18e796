"""Regression trees, forests and boosted trees over rows that are binned once (MOD1).

MLlib's trees keep an object per row and walk it in the JVM once for each level of each tree;
beyond the executors' memory these objects are written to disk and read back each time.  Here
a row is one byte per feature and its label, in blocks of ``BLOCK`` rows:

1. thresholds are found as in MLlib, from all rows or a sample of ``SAMPLE``; each row
   is binned by them (``bin_rows``), once for all models;
2. for each level of the trees, tasks add up counts and label sums by (tree, node, feature,
   bin) over their blocks; the driver sums these tables, whose size depends on
   trees, nodes and bins only, and takes each node's best split;
3. boosting carries the residuals along in the blocks, which are stored anew after each tree; the
   blocks before are deleted.

Splits, gains and boosting steps are MLlib's with its defaults (variance, 32 bins, at least one
row a side, squared error); over at most ``SAMPLE`` rows trees and boosting
predict what MLlib's do.  A forest draws its own random numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: Rows of a block, and of a file of blocks about: a task holds a file's bytes a few times over.
BLOCK, PART = 1 << 14, 1 << 19
SCHEMA = "block bigint, codes binary, label binary"
#: Tables of more tasks than this are summed by tasks before they come to the driver.
DIRECT = 32
# ---- fixed values of MLlib's trees ------------------------------------------
BINS, SAMPLE, RATE = 32, 10_000, 0.1
# -----------------------------------------------------------------------------
#: Poisson(1) by 16 random bits.
_POISSON = np.searchsorted(np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)])), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float64)


def find_thresholds(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds between equal shares of the values: halfway between neighbours, as MLlib's."""
    seen, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    if len(seen) <= bins:
        return (seen[:-1] + seen[1:]) / 2
    out, stride = [], counts.sum() / bins
    target, so_far = stride, np.cumsum(counts)
    for i in range(1, len(seen)):
        if abs(so_far[i - 1] - target) < abs(so_far[i] - target):
            out.append((seen[i - 1] + seen[i]) / 2)
            target += stride
    return np.array(out)


class Blocks:
    """Stored rows (block, codes, label)."""

    def __init__(self, df: DataFrame):
        self.path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/blocks-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = df.sparkSession.read.schema(SCHEMA).parquet(self.path)

    def drop(self) -> None:
        sc = self.df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@dataclass
class BinnedRows:
    """Blocks of binned rows and what binned them."""

    blocks: Blocks
    thresholds: list[np.ndarray]
    rows: int


def bin_rows(df: DataFrame, features: str = "features", label: str = "label", seed: int = 42) -> BinnedRows:
    x = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    rows = x.count()
    some = (x if rows <= SAMPLE else x.sample(SAMPLE / rows, seed)).select("x").toArrow().column("x").combine_chunks()
    values = some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)
    thresholds = [find_thresholds(c, min(BINS, rows)) for c in values.T]

    def pack(x: np.ndarray, y: np.ndarray, number: int) -> pa.RecordBatch:
        codes = np.stack([np.searchsorted(t, c) for t, c in zip(thresholds, x.T, strict=True)]).astype(np.uint8)
        block = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "codes": pa.array([codes.tobytes()], pa.binary()),
                                           "label": pa.array([y.tobytes()], pa.binary())})

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for b in (b.slice(i, BLOCK) for b in batches for i in range(0, b.num_rows, BLOCK)):
            y = b.column(1).to_numpy(zero_copy_only=False)
            held.append((b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1), y))
            size += len(y)
            if size >= BLOCK:
                yield pack(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), number)
                held, size, number = [], 0, number + 1
        if size:
            yield pack(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), number)

    parts = max(-(-rows // PART), min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // 4096)), 1)
    return BinnedRows(Blocks(x.mapInArrow(blocks, SCHEMA).repartition(parts, "block")), thresholds, rows)


@dataclass
class Tree:
    """A full tree of bins: at level l node q sends a row whose ``feature[l][q]`` has a code above ``cut[l][q]`` to the
    right, node 2q + 1 of the next level; ``value`` is of the last level's nodes.  Below a leaf all rows go left."""

    feature: list[np.ndarray]
    cut: list[np.ndarray]
    value: np.ndarray

    def walk(self, codes: np.ndarray) -> np.ndarray:
        """The node of each row, codes are (feature, row)."""
        n = codes.shape[1]
        flat, at, q = codes.reshape(-1), np.arange(n), np.zeros(n, dtype=np.int64)
        for feature, cut in zip(self.feature, self.cut, strict=True):
            code = flat.take(at + (feature * n)[q])
            q = 2 * q + (code > cut[q])
        return q

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.walk(codes)]


def _bag(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is drawn for a tree; the same in each pass."""
    return _POISSON[np.random.default_rng([seed, tree, block]).integers(0, 1 << 16, n, dtype=np.uint16)]


def _level_sums(blocks: DataFrame, trees: list[Tree], subsets: list[np.ndarray], bag_seed: int | None) -> np.ndarray:
    """[tree, node, place of the feature in the node's subset, bin, (count, label sum)] of the trees' last level."""
    nodes, places = subsets[0].shape
    shape = (len(trees), 2, places, nodes * BINS)
    features = [s.astype(np.int64) for s in subsets]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape)
        for b in batches:
            for block, codes, label in zip(*(b.column(i) for i in range(3)), strict=True):
                y = np.frombuffer(label.as_buffer(), dtype=np.float64)
                n = len(y)
                codes = np.frombuffer(codes.as_buffer(), dtype=np.uint8).reshape(-1, n)
                flat, at = codes.reshape(-1), np.arange(n)
                for t, tree in enumerate(trees):
                    q = tree.walk(codes)
                    w = None if bag_seed is None else _bag(bag_seed, t, block.as_py(), n)
                    wy = y if w is None else w * y
                    first = q * BINS
                    for j in range(places):
                        # one feature for all nodes needs no lookup
                        one = int(features[t][0, j])
                        code = codes[one] if (features[t][:, j] == one).all() else flat.take(at + (features[t][:, j] * n)[q])
                        cell = first + code
                        sums[t, 0, j] += np.bincount(cell, w, shape[3])
                        sums[t, 1, j] += np.bincount(cell, wy, shape[3])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tobytes()], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape)
        for b in batches:
            for x in b.column(0):
                sums += np.frombuffer(x.as_buffer()).reshape(shape)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tobytes()], pa.binary())})

    tables, tasks = blocks.select("block", "codes", "label").mapInArrow(add, "sums binary"), blocks.rdd.getNumPartitions()
    while tasks > DIRECT:
        tasks = -(-tasks // DIRECT)
        tables = tables.repartition(tasks).mapInArrow(merge, "sums binary")
    out = np.zeros(shape)
    for r in tables.collect():
        out += np.frombuffer(r[0]).reshape(shape)
    return out.reshape(len(trees), 2, places, nodes, BINS).transpose(0, 3, 2, 4, 1)


def _best_splits(sums: np.ndarray, subset: np.ndarray, n_splits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(whether the node is split, feature, cut, values of left and right) by node: the first of the greatest gains."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    total = sums[:, 0].sum(axis=1)  # (node, 2)
    right = total[:, None, None] - left
    ok = (left[..., 0] >= 1) & (right[..., 0] >= 1) & (np.arange(BINS - 1) < n_splits[subset][:, :, None])
    n = np.maximum(total[:, 0], 1)
    mean = total[:, 1] / n
    # squared sums around the node's mean: what is taken off is small, so little is lost to rounding
    dl, dr = (np.where(ok, s[..., 1] - s[..., 0] * mean[:, None, None], 0) ** 2 / np.maximum(s[..., 0], 1) for s in (left, right))
    gain = np.where(ok, (dl + dr) / n[:, None, None], -1.0).reshape(len(total), -1)
    best = gain.argmax(axis=1)
    node, (place, cut) = np.arange(len(total)), np.divmod(best, BINS - 1)
    split = gain[node, best] > 1e-20 * mean * mean  # less is rounding
    sides = np.stack([s[node, place, cut] for s in (left, right)], axis=1)  # (node, side, 2)
    values = np.where(split[:, None], sides[:, :, 1] / np.maximum(sides[:, :, 0], 1), mean[:, None])
    return split, subset[node, place], cut, values


def _grow(blocks: DataFrame, n_splits: np.ndarray, trees: int, depth: int, per_node: int | None, bag_seed: int | None, rng: np.random.Generator) -> list[Tree]:
    grown = [Tree([], [], np.zeros(1)) for _ in range(trees)]
    alive = np.ones((trees, 1), dtype=bool)
    for level in range(depth):
        nodes = 1 << level
        all_features = np.arange(len(n_splits))
        subsets = [np.stack([rng.permutation(all_features)[:per_node] if per_node else all_features for _ in range(nodes)]) for _ in range(trees)]
        sums = _level_sums(blocks, grown, subsets, bag_seed)
        children = np.zeros((trees, 2 * nodes), dtype=bool)
        for t, tree in enumerate(grown):
            split, feature, cut, values = _best_splits(sums[t], subsets[t], n_splits)
            if not level:
                tree.value = np.full(1, sums[t, 0, 0, :, 1].sum() / max(sums[t, 0, 0, :, 0].sum(), 1))
            split &= alive[t]
            tree.feature.append(np.where(split, feature, 0))
            tree.cut.append(np.where(split, cut, BINS))
            tree.value = np.where(split[:, None], values, tree.value[:, None]).reshape(-1)
            children[t] = np.repeat(split, 2)
        alive = children
        if not alive.any():
            break
    return grown


def _less(blocks: DataFrame, tree: Tree, factor: float, scale: float) -> DataFrame:
    """Blocks whose labels are ``scale * label - factor * prediction``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for codes, label in zip(b.column(1), b.column(2), strict=True):
                y = np.frombuffer(label.as_buffer(), dtype=np.float64)
                out.append((scale * y - factor * tree.predict(np.frombuffer(codes.as_buffer(), dtype=np.uint8).reshape(-1, len(y)))).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["block", "codes", "label"])

    return blocks.select("block", "codes", "label").mapInArrow(step, SCHEMA)


class BinnedTrees:
    """A tree (``trees`` = 1), a forest of bagged trees, or ``boosted`` trees."""

    def __init__(self, depth: int, trees: int = 1, bagged: bool = False, boosted: bool = False, seed: int = 42):
        self.depth, self.trees, self.bagged, self.boosted, self.seed = depth, trees, bagged, boosted, seed
        self.label, self.features = "label", "features"

    def setLabelCol(self, name: str) -> BinnedTrees:
        self.label = name
        return self

    def setFeaturesCol(self, name: str) -> BinnedTrees:
        self.features = name
        return self

    def fit(self, train: DataFrame) -> BinnedTreesModel:
        rows = bin_rows(train, self.features, self.label, self.seed)
        try:
            return self.fit_binned(rows)
        finally:
            rows.blocks.drop()

    def fit_binned(self, rows: BinnedRows) -> BinnedTreesModel:
        rng = np.random.default_rng(self.seed)
        n_splits = np.array([len(t) for t in rows.thresholds])
        if not self.boosted:
            # MLlib's "auto": a third of the features for each node of a forest
            per_node = -(-len(n_splits) // 3) if self.bagged and self.trees > 1 else None
            trees = _grow(rows.blocks.df, n_splits, self.trees, self.depth, per_node, self.seed if self.bagged else None, rng)
            return BinnedTreesModel(rows.thresholds, trees, [1 / len(trees)] * len(trees), self.features)
        trees, blocks = [], rows.blocks
        for m in range(self.trees):
            trees += _grow(blocks.df, n_splits, 1, self.depth, None, None, rng)
            if m + 1 < self.trees:
                # the first tree is of the labels, later ones of twice what is left of them
                before, blocks = blocks, Blocks(_less(blocks.df, trees[-1], 2.0 * (RATE if m else 1.0), 1.0 if m else 2.0))
                if m:
                    before.drop()
        if blocks is not rows.blocks:
            blocks.drop()
        return BinnedTreesModel(rows.thresholds, trees, [RATE if m else 1.0 for m in range(self.trees)], self.features)


class BinnedTreesModel:
    def __init__(self, thresholds: list[np.ndarray], trees: list[Tree], weights: list[float], features: str):
        self.thresholds, self.trees, self.weights = thresholds, trees, weights
        self.features, self.prediction = features, "prediction"

    def setPredictionCol(self, name: str) -> BinnedTreesModel:
        self.prediction = name
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        codes = np.stack([np.searchsorted(t, c) for t, c in zip(self.thresholds, x.T, strict=True)]).astype(np.uint8)
        out = np.zeros(len(x))
        for tree, weight in zip(self.trees, self.weights, strict=True):
            out += weight * tree.predict(codes)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        predict = self.predict

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            return pa.array(predict(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)) if len(x) else np.zeros(0))

        return df.withColumn(self.prediction, score(vector_to_array(self.features)))
