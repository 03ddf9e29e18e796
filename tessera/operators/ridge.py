"""Linear regression and its cross-validation from shared sums (MOD1, MOD3).

One pass adds up, per fold, the products of all pairs of (1, features, label).
The sums of a training set are the total less its held-out fold, and a held-out
error is a quadratic form in the held-out sums, so every fold and every penalty
is answered from these matrices; the rows are read once, whatever the grid.
The driver sees folds x (features + 2)^2 numbers.

The fit minimises ``mean((y - b0 - x b)^2) + penalty * sum((sd_j b_j)^2)`` with
population deviations of the training rows.  Rows where the label, the fold or
a feature is null or not finite take no part.  A feature that is constant in
training gets coefficient 0; at penalty 0 dependent features share the weight
(least norm).  A fold without training or held-out rows has null errors.  The
sums are of raw products in doubles: scale features whose mean is more than
about 10^6 deviations from 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "penalty DOUBLE, fold BIGINT, n_train BIGINT, n_test BIGINT, rmse DOUBLE, mean_rmse DOUBLE, is_best BOOLEAN"


def fold_sums(df: DataFrame, features: list[str], label: str, fold: str) -> dict[int, np.ndarray]:
    """Matrix of product sums of (1, features, label) of each fold."""
    width = len(features) + 2
    cols = [F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate([*features, label])]
    rows = df.select(F.col(f"`{fold}`").cast("bigint").alias("fold"), *cols).where("fold IS NOT NULL")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            z = b.iloc[:, 1:].to_numpy(dtype=float)
            ok = np.isfinite(z).all(axis=1)
            z, f = np.hstack([np.ones((int(ok.sum()), 1)), z[ok]]), b["fold"].to_numpy()[ok]
            for k in np.unique(f):
                part = z[f == k]
                sums[int(k)] = sums.get(int(k), 0) + part.T @ part
        for k, m in sums.items():
            yield pd.DataFrame({"fold": k, "cell": np.arange(m.size), "value": m.ravel()})

    cells = rows.mapInPandas(partial, "fold BIGINT, cell BIGINT, value DOUBLE").groupBy("fold", "cell").agg(F.sum("value").alias("value"))
    out: dict[int, np.ndarray] = {}
    for r in cells.collect():
        out.setdefault(r["fold"], np.zeros(width * width))[r["cell"]] = r["value"]
    return {k: m.reshape(width, width) for k, m in sorted(out.items())}


def solve(sums: np.ndarray, penalty: float) -> np.ndarray | None:
    """Intercept and coefficients; None without rows."""
    n = sums[0, 0]
    if n < 1:
        return None
    mean = sums[0, 1:] / n
    cov = sums[1:, 1:] / n - np.outer(mean, mean)
    var = np.diag(cov)[:-1]
    # what rounding leaves of a constant is no variance
    used = np.flatnonzero(var > 1e-12 * (np.diag(sums)[1:-1] / n))
    b = np.zeros(len(var))
    sd = np.sqrt(var[used])
    corr = cov[np.ix_(used, used)] / np.outer(sd, sd)
    b[used] = np.linalg.pinv(corr + penalty * np.eye(len(used)), hermitian=True) @ (cov[used, -1] / sd) / sd
    return np.concatenate([[mean[-1] - mean[:-1] @ b], b])


def ridge_fit(df: DataFrame, features: list[str], label: str, penalty: float = 0.0) -> np.ndarray | None:
    """Intercept and coefficients over all rows."""
    sums = fold_sums(df.withColumn("__fold", F.lit(0)), features, label, "__fold")
    return solve(sums[0], penalty) if sums else None


def ridge_cv(df: DataFrame, features: list[str], label: str, fold: str, penalties: list[float]) -> DataFrame:
    """MOD3: held-out error of every penalty and fold, the penalty's mean over its folds, and
    whether that mean is the least (ties: the greater penalty)."""
    sums = fold_sums(df, features, label, fold)
    total = sum(sums.values(), np.zeros((len(features) + 2,) * 2))
    rows, means = [], {}
    for p in penalties:
        errors = []
        for k, held in sums.items():
            b = solve(total - held, p)
            error = None
            if b is not None and held[0, 0] > 0:
                w = np.concatenate([-b, [1.0]])
                error = float(np.sqrt(max(0.0, w @ held @ w) / held[0, 0]))
                errors.append(error)
            rows.append([float(p), k, int(total[0, 0] - held[0, 0]), int(held[0, 0]), error])
        means[float(p)] = float(np.mean(errors)) if errors else None
    known = [(m, -p) for p, m in means.items() if m is not None]
    best = -min(known)[1] if known else None
    return df.sparkSession.createDataFrame([(*r, means[r[0]], r[0] == best) for r in rows], RESULT)


def vector_sums(df: DataFrame, features: str = "features", label: str = "label") -> np.ndarray:
    """Matrix of product sums of (1, features, label), for a vector column: one pass, a matrix a task."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for b in batches:
            n = b.num_rows
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))
            z = np.column_stack([np.ones(n), x, b.column(1).to_numpy(zero_copy_only=False)])
            z = z[np.isfinite(z).all(axis=1)]
            if n:
                sums = z.T @ z if sums is None else sums + z.T @ z
        if sums is not None:
            yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(sums.size)), "value": pa.array(sums.ravel())})

    x = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    cells = x.mapInArrow(partial, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value")).orderBy("cell").collect()
    out = np.array([r["value"] for r in cells])
    width = int(round(len(out) ** 0.5))
    return out.reshape(width, width)


class SumsRegression:
    """Linear regression with MLlib's penalties (``regParam`` and ``elasticNetParam`` of its LinearRegression, features and label
    standardised), solved from one pass of sums that any number of them can share."""

    def __init__(self, penalty: float = 0.0, l1_share: float = 0.0):
        self.penalty, self.l1_share = penalty, l1_share
        self.label, self.features = "label", "features"

    def setLabelCol(self, name: str) -> SumsRegression:
        self.label = name
        return self

    def setFeaturesCol(self, name: str) -> SumsRegression:
        self.features = name
        return self

    def fit(self, train: DataFrame) -> SumsRegressionModel:
        return self.fit_sums(vector_sums(train, self.features, self.label))

    def fit_sums(self, sums: np.ndarray) -> SumsRegressionModel:
        if not sums.size or sums[0, 0] < 1:
            raise ValueError("no row has a label and features that are all finite")
        n = sums[0, 0]
        deviation = np.sqrt(max(0.0, sums[-1, -1] / n - (sums[0, -1] / n) ** 2))
        scaled = self.penalty / deviation if deviation else 0.0
        b = solve(sums, scaled * (1 - self.l1_share))
        if scaled * self.l1_share:
            b = _shrunk(sums, scaled * self.l1_share, scaled * (1 - self.l1_share))
        return SumsRegressionModel(float(b[0]), b[1:], self.features)


def _shrunk(sums: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Intercept and coefficients under both penalties: one coefficient after the other until none moves."""
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    cov = sums[1:, 1:] / n - np.outer(mean, mean)
    used = np.flatnonzero(np.diag(cov)[:-1] > 1e-12 * (np.diag(sums)[1:-1] / n))
    sd, label_sd = np.sqrt(np.diag(cov)[used]), np.sqrt(cov[-1, -1])
    corr, wanted = cov[np.ix_(used, used)] / np.outer(sd, sd), cov[used, -1] / sd / label_sd
    w = np.zeros(len(used))
    for _ in range(100_000):
        before = w.copy()
        for j in range(len(w)):
            rest = wanted[j] - corr[j] @ w + corr[j, j] * w[j]
            w[j] = np.sign(rest) * max(0.0, abs(rest) - l1) / (corr[j, j] + l2)
        if np.abs(w - before).max(initial=0) <= 1e-13:
            break
    b = np.zeros(len(mean) - 1)
    b[used] = w * label_sd / sd
    return np.concatenate([[mean[-1] - mean[:-1] @ b], b])


class SumsRegressionModel:
    def __init__(self, intercept: float, coefficients: np.ndarray, features: str):
        self.intercept, self.coefficients, self.features, self.prediction = intercept, coefficients, features, "prediction"

    def setPredictionCol(self, name: str) -> SumsRegressionModel:
        self.prediction = name
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        intercept, b = self.intercept, self.coefficients

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            return pa.array(intercept + x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(b)) @ b)

        return df.withColumn(self.prediction, score(vector_to_array(self.features)))
