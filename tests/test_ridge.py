import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from tessera.operators.ridge import ridge_cv, ridge_fit


def _rows(n=200):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2)) * [5, 0.1] + [100, 3]
    y = 2 * x[:, 0] - 30 * x[:, 1] + rng.normal(size=n)
    return x, y, np.arange(n) % 4


def _by_rows(x, y, fold, penalty):
    out = {}
    for k in np.unique(fold):
        a, t = x[fold != k], x[fold == k]
        mu, sd = a.mean(0), a.std(0)
        z, m = (a - mu) / sd, len(a)
        b = np.linalg.solve(z.T @ z / m + penalty * np.eye(2), z.T @ (y[fold != k] - y[fold != k].mean()) / m)
        out[k] = np.sqrt(np.mean((y[fold == k] - y[fold != k].mean() - (t - mu) / sd @ b) ** 2))
    return out


def test_every_fold_and_penalty_equals_a_fit_over_its_rows(spark):
    x, y, fold = _rows()
    df = spark.createDataFrame([(float(a), float(b), float(c), int(f)) for (a, b), c, f in zip(x, y, fold)], "a DOUBLE, b DOUBLE, y DOUBLE, fold INT")
    res = ridge_cv(df.repartition(3), ["a", "b"], "y", "fold", [0.0, 0.1, 2.0]).collect()
    assert len(res) == 12 and {r.penalty for r in res if r.is_best} == {0.0}
    for p in (0.0, 0.1, 2.0):
        want = _by_rows(x, y, fold, p)
        got = {r.fold: r for r in res if r.penalty == p}
        assert all(abs(got[k].rmse - want[k]) < 1e-8 for k in want)
        assert all(abs(r.mean_rmse - np.mean(list(want.values()))) < 1e-8 and (r.n_train, r.n_test) == (150, 50) for r in got.values())


def test_fit_equals_the_library(spark):
    x, y, _ = _rows()
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a DOUBLE, b DOUBLE, label DOUBLE")
    m = LinearRegression().fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    assert np.allclose(ridge_fit(df, ["a", "b"], "label"), [m.intercept, *m.coefficients], rtol=1e-6)


def test_nulls_constants_repeats_and_empty_tables(spark):
    schema = "`x.1` DOUBLE, c DOUBLE, d DOUBLE, y DOUBLE, fold INT, cell STRING"
    rows = [(float(i), 7.0, 2.0 * i, 3.0 * i + 1, i % 2, "k") for i in range(20)]
    bad = [(None, 7.0, 1.0, 1.0, 0, "k"), (1.0, 7.0, 1.0, None, 0, "k"), (float("nan"), 7.0, 1.0, 1.0, 1, "k"),
           (1.0, 7.0, float("inf"), 1.0, 1, None), (1.0, 7.0, 2.0, 99.0, None, None)]
    df = spark.createDataFrame(rows + bad, schema)
    res = ridge_cv(df, ["x.1", "c", "d"], "y", "fold", [0.0]).collect()
    assert [(r.fold, r.n_train, r.n_test) for r in res] == [(0, 10, 10), (1, 10, 10)]
    assert all(r.rmse < 1e-5 and r.is_best for r in res)
    b = ridge_fit(df.where("fold IS NOT NULL"), ["x.1", "c", "d"], "y")
    assert b[2] == 0 and abs(b[1] + 2 * b[3] - 3) < 1e-8 and abs(b[0] - 1) < 1e-6
    one = ridge_cv(df.where("fold = 0"), ["x.1"], "y", "fold", [0.0, 1.0]).collect()
    assert [(r.n_train, r.rmse, r.mean_rmse, r.is_best) for r in one] == [(0, None, None, False)] * 2
    assert ridge_cv(df.limit(0), ["x.1"], "y", "fold", [0.0]).count() == 0 and ridge_fit(df.limit(0), ["c"], "y") is None


def test_penalties_are_mllibs(spark):
    """linear, ridge, lasso and a mix, with a constant feature and one that is ten times another."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression
    from pyspark.sql import functions as F
    from tessera.operators import ridge
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 4)) * [1, 20, 0.1, 3] + [0, 50, 1, -4]
    x = np.column_stack([x, 10 * x[:, 0], np.full(400, 2.0)])
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + 5 * x[:, 2] + rng.normal(size=400)
    df = spark.createDataFrame([(r, v) for r, v in zip(x.tolist(), y.tolist())], "x array<double>, label double")
    df = df.select(array_to_vector("x").alias("features"), "label").repartition(3)
    sums = ridge.vector_sums(df)
    for penalty, share in ((0.0, 0.0), (0.1, 0.0), (0.1, 1.0), (1.5, 1.0), (0.5, 0.3), (50.0, 1.0)):
        ours = ridge.SumsRegression(penalty, share).fit_sums(sums).setPredictionCol("ours")
        theirs = LinearRegression(regParam=penalty, elasticNetParam=share, maxIter=1000, tol=1e-12).fit(df)
        off = ours.transform(theirs.transform(df)).agg(F.max(F.abs(F.col("ours") - F.col("prediction")))).first()[0]
        assert off < 1e-4, (penalty, share, off)


def test_linear_models_share_a_pass(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    from tessera.operators import modeling as md
    df = spark.range(300).select(array_to_vector(F.array(F.col("id") % 7 * 1.0, F.col("id") % 5 * 1.0)).alias("features"), (F.col("id") % 7 * 2.0 + 1).alias("label"))
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda v: (seen.add(1), v)[1], "double").asNondeterministic()
    models = {k: v for k, v in md.regressors().items() if k in ("linear", "ridge", "lasso")}
    got = md.compare_regressors(spark, df.withColumn("label", count("label")), df, models).collect()
    assert seen.value == 300 and [r["model"] for r in got] == ["linear", "ridge", "lasso"] and got[0]["rmse"] < 1e-9
