"""Distributed model fitting, selection and scoring with ``pyspark.ml``
(MOD1-MOD4, MOD7-MOD10, FEA7, FEA10, FEA11, EVA6, EVA8).

Iterative loops (pseudo-labelling, active learning) cut lineage every round
with a reliable checkpoint into the shared checkpoint folder.
"""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.binned_trees import BinnedTrees, bin_rows
from tessera.operators.ridge import SumsRegression, vector_sums
from tessera.session import cut_lineage


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def regressors(seed: int = 42) -> dict:
    """MOD1: linear, ridge, lasso, tree, forest, boosting."""
    return {
        "linear": SumsRegression(0.0),
        "ridge": SumsRegression(0.1),
        "lasso": SumsRegression(0.1, l1_share=1.0),
        "tree": BinnedTrees(depth=6, seed=seed),
        "forest": BinnedTrees(depth=6, trees=20, bagged=True, seed=seed),
        "boosting": BinnedTrees(depth=4, trees=20, boosted=True, seed=seed),
    }


def compare_regressors(spark: SparkSession, train: DataFrame, test: DataFrame, models: dict | None = None,
                       label: str = "label") -> DataFrame:
    """MOD1 + EVA1: fit every model, one result row each (rmse, mae, r2).

    Linear models share one pass of sums, models of binned trees the binned rows; one pass over ``test``
    scores all models."""
    from tessera.operators.evaluation import regression_metrics
    fitted, binned, sums = {}, None, None
    for name, est in (models or regressors()).items():
        est = est.setLabelCol(label).setFeaturesCol("features")
        if isinstance(est, BinnedTrees):
            binned = binned or bin_rows(train, "features", label)
            fitted[name] = est.fit_binned(binned)
        elif isinstance(est, SumsRegression):
            sums = vector_sums(train, "features", label) if sums is None else sums
            fitted[name] = est.fit_sums(sums)
        else:
            fitted[name] = est.fit(train)
    if binned:
        binned.blocks.drop()
    scored, pairs = test, []
    for i, (name, model) in enumerate(fitted.items()):
        scored = model.setPredictionCol(f"__p{i}").transform(scored)
        pairs.append(F.struct(F.lit(name).alias("model"), F.col(f"__p{i}").alias("prediction")))
    scored = scored.select(F.col(label).alias("label"), F.explode(F.array(*pairs)).alias("__s")).select("label", "__s.*")
    metrics = {r["model"]: (r["rmse"], r["mae"], r["r2"]) for r in regression_metrics(scored, by="model").collect()}
    rows = [(name, *metrics.get(name, (None, None, None))) for name in fitted]
    return spark.createDataFrame(rows, "model STRING, rmse DOUBLE, mae DOUBLE, r2 DOUBLE")


def classifiers(seed: int = 42, n_classes: int = 2) -> dict:
    """MOD2: logistic regression, forest, linear SVM, boosting."""
    svc, gbt = LinearSVC(maxIter=50), GBTClassifier(maxIter=20, maxDepth=4, seed=seed)
    return {
        "logistic": LogisticRegression(maxIter=50),
        "forest": RandomForestClassifier(numTrees=30, maxDepth=6, seed=seed),
        # both are two-class models: one-vs-rest only where there are more classes
        "linear_svc": svc if n_classes == 2 else OneVsRest(classifier=svc),
        "boosting": gbt if n_classes == 2 else OneVsRest(classifier=gbt),
    }


def compare_classifiers(spark: SparkSession, train: DataFrame, test: DataFrame, models: dict | None = None,
                        label: str = "label") -> DataFrame:
    """MOD2: macro F1 (mean of per-class F1) and accuracy per model."""
    from tessera.operators.evaluation import per_class_report
    rows = []
    for name, est in (models or classifiers()).items():
        pred = est.setLabelCol(label).setFeaturesCol("features").fit(train).transform(test)
        rep = per_class_report(pred.select(F.col(label).cast("double").alias("label"),
                                           F.col("prediction").cast("double").alias("prediction")))
        m = rep.agg(F.avg("f1").alias("f1"), (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("acc")).first()
        rows.append((name, float(m["f1"]), float(m["acc"])))
    return spark.createDataFrame(rows, "model STRING, macro_f1 DOUBLE, accuracy DOUBLE")


def grid_search_cv(train: DataFrame, estimator, grid: dict, evaluator, fold_col: str | None = None,
                   k: int = 5, parallelism: int = 4, seed: int = 42):
    """MOD3: full grid x k-fold CV; ``fold_col`` (e.g. stratified folds) fixes the folds."""
    b = ParamGridBuilder()
    for p, values in grid.items():
        b = b.addGrid(getattr(estimator, p), values)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=b.build(), evaluator=evaluator,
                        numFolds=k, parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(train)


def random_search_cv(train: DataFrame, estimator, space: dict, evaluator, n_iter: int = 5,
                     fold_col: str | None = None, k: int = 5, seed: int = 42, parallelism: int = 4):
    """MOD4: ``n_iter`` seeded draws from the parameter space, then CV."""
    rng = random.Random(seed)
    maps = []
    for _ in range(n_iter):
        maps.append({getattr(estimator, p): rng.choice(values) for p, values in space.items()})
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=k,
                        parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(train), maps


def cv_results(spark: SparkSession, cv_model) -> DataFrame:
    """One row per parameter map with its mean CV metric."""
    rows = []
    for pm, m in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)), float(m)))
    return spark.createDataFrame(rows, "params STRING, mean_metric DOUBLE")


def mlp_classifier(layers: list[int], seed: int = 42, max_iter: int = 100) -> MultilayerPerceptronClassifier:
    """MOD7: feed-forward network (sigmoid hidden layers, softmax output)."""
    return MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed, blockSize=128)


def preprocessing_stages(train: DataFrame, numeric: list[str], categorical: list[str],
                         out: str = "features", na_token: str = "__NA__", keep_unseen: bool = True) -> list:
    """FEA7: column-wise preprocessing as persistable ``pyspark.ml`` stages:
    numeric NULL -> exact training median (baked into a ``SQLTransformer``),
    categorical NULL -> ``na_token``, text levels indexed in alphabetical
    order (unseen levels kept as an extra index, or -1 as in FEA4 without
    ``keep_unseen``), assembled and scaled."""
    from pyspark.ml.feature import SQLTransformer

    from tessera.operators.encoders import OrdinalEncoder
    from tessera.operators.quantiles import exact_quantiles
    med = exact_quantiles(_long_numeric(train, numeric), "value", [0.5], ["column"]).collect()
    fills = {r["column"]: r["q50"] for r in med}
    sel = ["*"] + [f"coalesce(`{c}`, {float(fills.get(c) or 0.0)!r}) AS `{c}__f`" for c in numeric] + \
          [f"coalesce(CAST(`{c}` AS STRING), '{na_token}') AS `{c}__f`" for c in categorical]
    stages = [SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")]
    stages += [OrdinalEncoder(inputCols=[f"{c}__f" for c in categorical], outputCols=[f"{c}__ix" for c in categorical],
                              keepUnseen=keep_unseen)]
    stages += [VectorAssembler(inputCols=[f"{c}__f" for c in numeric] + [f"{c}__ix" for c in categorical],
                               outputCol="__raw", handleInvalid="keep"),
               StandardScaler(inputCol="__raw", outputCol=out, withMean=True, withStd=True)]
    return stages


def _long_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(F.explode(arr).alias("__s")).select("__s.*")


def fit_save_pipeline(train: DataFrame, stages: list, path: str) -> PipelineModel:
    """FEA7 / MOD8: fit a pipeline and persist it; ``PipelineModel.load`` restores it."""
    model = Pipeline(stages=stages).fit(train)
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def forest_member_spread(model, df: DataFrame, out_mean: str = "mean_pred", out_std: str = "std_pred") -> DataFrame:
    """Per-row mean and population std of the trees' predictions (MOD9/MOD10).

    Every tree adds one prediction column to the same rows (no joins)."""
    x = df
    names = []
    for i, tree in enumerate(model.trees):
        c = f"__t{i}"
        x = tree.copy().setPredictionCol(c).setFeaturesCol(model.getFeaturesCol()).transform(x)
        names.append(c)
    arr = F.array(*[F.col(c) for c in names])
    n = float(len(names))
    mean = F.aggregate(arr, F.lit(0.0), lambda a, v: a + v) / n
    x = x.withColumn(out_mean, mean)
    var = F.aggregate(arr, F.lit(0.0), lambda a, v: a + (v - F.col(out_mean)) * (v - F.col(out_mean))) / n
    return x.withColumn(out_std, F.sqrt(var)).drop(*names)


def pseudo_labeling(spark: SparkSession, train: DataFrame, test: DataFrame, unlabeled: DataFrame,
                    id_col: str, label: str = "label", rounds: int = 3, threshold: float = 0.5,
                    decay: float = 0.98, seed: int = 42) -> DataFrame:
    """MOD9 + EVA6: each round fit a forest, predict the pool, move rows whose
    tree spread is <= threshold (with their predicted label) into train,
    shrink the threshold; returns the learning curve (round, train size, rmse)."""
    curve = []
    pool = unlabeled
    for r in range(rounds):
        est = RandomForestRegressor(numTrees=10, maxDepth=5, seed=seed, labelCol=label)
        model = est.fit(train)
        rmse = RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(model.transform(test))
        curve.append((r, train.count(), float(rmse), float(threshold)))
        scored = forest_member_spread(model, pool)
        confident = scored.where(F.col("std_pred") <= threshold)
        moved = confident.select(*[c for c in train.columns if c != label], F.col("mean_pred").alias(label))
        train = cut_lineage(train.unionByName(moved.select(*train.columns)))
        pool = cut_lineage(pool.join(confident.select(id_col), id_col, "left_anti"))
        threshold *= decay
    return spark.createDataFrame(curve, "round INT, train_size BIGINT, rmse DOUBLE, threshold DOUBLE")


def active_learning(spark: SparkSession, train: DataFrame, test: DataFrame, pool: DataFrame, oracle: DataFrame,
                    id_col: str, label: str = "label", k: int = 20, rounds: int = 3, seed: int = 42,
                    export_dir: str | None = None) -> DataFrame:
    """MOD10 + SRT5 + EVA6: each round export the ``k`` most uncertain pool rows
    (CSV, for annotators, who stand behind ``oracle`` (id, label)), read the
    labelled file back, add its rows to train; returns the learning curve."""
    curve = []
    for r in range(rounds):
        model = RandomForestRegressor(numTrees=10, maxDepth=5, seed=seed, labelCol=label).fit(train)
        rmse = RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(model.transform(test))
        curve.append((r, train.count(), float(rmse)))
        scored = forest_member_spread(model, pool)
        pick = scored.orderBy(F.desc("std_pred"), F.col(id_col)).limit(k).select(id_col)
        answers = pick.join(oracle, id_col).select(id_col, label)
        if export_dir:
            pick.write.mode("overwrite").option("header", True).csv(f"{export_dir}/round_{r}/asked")
            answers.write.mode("overwrite").option("header", True).csv(f"{export_dir}/round_{r}/answered")
            answers = spark.read.schema(answers.schema).option("header", True).csv(f"{export_dir}/round_{r}/answered")
        labelled = pool.drop(label).join(answers, id_col)
        train = cut_lineage(train.unionByName(labelled.select(*train.columns)))
        pool = cut_lineage(pool.join(pick, id_col, "left_anti"))
    return spark.createDataFrame(curve, "round INT, train_size BIGINT, rmse DOUBLE")


def sentence_vectors_w2v(tokens_df: DataFrame, id_col: str, tokens: str, size: int = 100, window: int = 5,
                         min_count: int = 2, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """FEA10: Word2Vec; a sentence is the mean of its *known* words' vectors
    (zeros when none).  MLlib's method with its tables in parts over the
    executors (``word_vectors``); trains in ``partitions`` parts, by default as
    many as the input has, in more where these would be large."""
    from tessera.operators.word_vectors import sentence_vectors
    return sentence_vectors(tokens_df, id_col, tokens, size, window, min_count, seed, partitions)


def pca_centered(df: DataFrame, vec_col: str, k: int = 2, out: str = "pca") -> DataFrame:
    """FEA11: centre the vectors (mean from one aggregate), then project with ML PCA."""
    v = df.withColumn("__v", array_to_vector(F.col(vec_col)))
    mean = v.agg(Summarizer.mean(F.col("__v")).alias("m")).first()["m"].toArray().tolist()
    centred = v.withColumn("__c", array_to_vector(F.zip_with(vector_to_array("__v"),
                                                             F.array(*[F.lit(float(x)) for x in mean]),
                                                             lambda a, b: a - b)))
    model = PCA(k=k, inputCol="__c", outputCol="__p").fit(centred)
    return model.transform(centred).withColumn(out, vector_to_array("__p")).drop("__v", "__c", "__p")


def kmeans_by_silhouette(df: DataFrame, features: str, ks: list[int], seed: int = 42):
    """EVA8: fit KMeans for each k, keep the k with the best silhouette."""
    ev = ClusteringEvaluator(featuresCol=features, metricName="silhouette")
    scores = []
    best = None
    for k in ks:
        m = KMeans(k=k, seed=seed, featuresCol=features).fit(df)
        s = ev.evaluate(m.transform(df))
        scores.append((k, float(s)))
        if best is None or s > best[1]:
            best = (m, s)
    return best[0], scores


def mask_overlap(df: DataFrame, group: str, truth: str, pred: str) -> DataFrame:
    """EVA8: IoU and Dice of predicted vs true membership per group (class),
    from counts only: |A and B|, |A|, |B|."""
    t = df.groupBy(F.col(truth).alias(group)).agg(F.count(F.lit(1)).alias("n_true"))
    p = df.groupBy(F.col(pred).alias(group)).agg(F.count(F.lit(1)).alias("n_pred"))
    both = df.where(F.col(truth) == F.col(pred)).groupBy(F.col(truth).alias(group)).agg(F.count(F.lit(1)).alias("n_both"))
    x = t.join(p, group, "full_outer").join(both, group, "left").fillna(0, ["n_true", "n_pred", "n_both"])
    union = F.col("n_true") + F.col("n_pred") - F.col("n_both")
    return x.select(group, (F.col("n_both") / union).alias("iou"),
                    (2 * F.col("n_both") / (F.col("n_true") + F.col("n_pred"))).alias("dice"))
