"""MOD1: trees over binned rows (F2)."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tessera.operators import binned_trees as bt
from tessera.operators import modeling as md


def table(spark, n, seed=1):
    """Features with few, many, repeated, constant and mostly zero values; labels with steps and noise."""
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 5, n), rng.normal(size=n).round(3), rng.zipf(1.5, n).clip(1, 400), np.full(n, 7.0),
                  np.where(rng.random(n) < 0.8, 0.0, rng.random(n).round(2))], axis=1).astype(float)
    y = (np.where(x[:, 1] > 0.3, 20, 3) * x[:, 0] + np.sqrt(x[:, 2]) - 9 * (x[:, 4] > 0.5) + rng.normal(size=n)).round(2)
    df = spark.createDataFrame([(i, r, v) for i, (r, v) in enumerate(zip(x.tolist(), y.tolist()))], "id int, x array<double>, label double")
    return df.select("id", array_to_vector("x").alias("features"), "label").repartition(3, "id")


def predictions(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()])


def test_thresholds_are_mllibs(spark):
    df = table(spark, 3000)
    theirs = DecisionTreeRegressor(maxDepth=9, seed=42).fit(df).toDebugString
    ours = bt.bin_rows(df).thresholds
    assert [len(t) for t in ours][3] == 0 and max(len(t) for t in ours) <= 31
    for line in theirs.splitlines():
        if "If (feature" in line and "<=" in line:
            f, cut = int(line.split("feature ")[1].split()[0]), float(line.split("<= ")[1].rstrip(")"))
            assert np.isclose(ours[f], cut).any(), line


def test_tree_and_boosting_predict_what_mllibs_do(spark):
    df, other = table(spark, 3000), table(spark, 500, seed=2)
    for theirs, ours in ((DecisionTreeRegressor(maxDepth=6, seed=42), bt.BinnedTrees(6)),
                         (DecisionTreeRegressor(maxDepth=1, seed=42), bt.BinnedTrees(1)),
                         (GBTRegressor(maxIter=20, maxDepth=4, seed=42), bt.BinnedTrees(4, trees=20, boosted=True))):
        a, b = theirs.fit(df), ours.fit(df)
        assert np.allclose(predictions(a, df), predictions(b, df), atol=1e-8)
        assert np.allclose(predictions(a, other), predictions(b, other), atol=1e-8)


def test_blocks_parts_and_summing_tasks_change_nothing(spark, monkeypatch):
    df = table(spark, 3000)
    whole = predictions(bt.BinnedTrees(5).fit(df), df)
    for name, value in (("BLOCK", 100), ("PART", 150), ("DIRECT", 2)):
        monkeypatch.setattr(bt, name, value)
    assert bt.bin_rows(df).blocks.df.select('block').distinct().count() >= 28
    assert np.allclose(predictions(bt.BinnedTrees(5).fit(df), df), whole, atol=1e-9)


def test_forest_is_as_good_as_mllibs_and_reruns_agree(spark):
    df, other = table(spark, 3000), table(spark, 1000, seed=2)
    y = np.array([r[0] for r in other.orderBy("id").select("label").collect()])
    rmse = lambda m: np.sqrt(np.mean((predictions(m, other) - y) ** 2))
    ours = bt.BinnedTrees(6, trees=20, bagged=True)
    a, b = ours.fit(df), ours.fit(df)
    assert (predictions(a, other) == predictions(b, other)).all()
    assert len({t.feature[0][0] for t in a.trees}) > 1 and len({t.value[0] for t in a.trees}) > 1
    assert rmse(a) < 1.1 * rmse(RandomForestRegressor(numTrees=20, maxDepth=6, seed=42).fit(df))


def test_draws_of_a_bag():
    w = bt._bag(42, 3, 9, 200_000)
    assert (w == bt._bag(42, 3, 9, 200_000)).all() and (w != bt._bag(42, 4, 9, 200_000)).any()
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005


@pytest.mark.parametrize("n", [1, 2, 40])
def test_small_equal_and_missing_values(spark, n):
    rows = [(i, [float("nan") if i % 3 == 2 else float(i % 2), 1.0], 5.0) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, x array<double>, label double").select("id", array_to_vector("x").alias("features"), "label")
    for est in (bt.BinnedTrees(3), bt.BinnedTrees(3, trees=4, boosted=True)):
        assert np.allclose(predictions(est.fit(df), df), 5.0)
    large = df.withColumn("label", F.lit(1e9) + F.col("id") % 2 * 1e-3)
    assert np.allclose(predictions(bt.BinnedTrees(3).fit(large), large), 1e9)


def test_comparison_reads_the_test_rows_once(spark):
    """F2: one pass scores all models, and each has the errors it has alone."""
    train, test = table(spark, 1500), table(spark, 400, seed=3)
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda v: (seen.add(1), v)[1], "double").asNondeterministic()
    got = {r["model"]: r for r in md.compare_regressors(spark, train, test.withColumn("label", count("label"))).collect()}
    assert seen.value == 400 and list(got) == ["linear", "ridge", "lasso", "tree", "forest", "boosting"]
    for name, est in md.regressors().items():
        e = est.fit(train).transform(test).select((F.col("prediction") - F.col("label")).alias("e")).agg(F.sqrt(F.avg(F.expr("e * e"))), F.avg(F.abs("e"))).first()
        assert np.allclose([got[name]["rmse"], got[name]["mae"]], e, rtol=1e-6), name
