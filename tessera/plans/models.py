"""Model fitting / selection / scoring queries (rows-only checks: no SQL twin)."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import evaluation as ev
from tessera.operators import modeling as md
from tessera.operators.encoders import OrdinalEncoder
from tessera.operators import ridge, sampling
from tessera.plans.flights import flight_features
from tessera.plans.registry import query
from tessera.plans.sqlhash import h_sql, split_sql
from tessera.plans.views import with_flights
from tessera.sources.tables import cores, load_table, spread
from tessera.session import cut_lineage, stored
from tessera.streaming.runner import shared_path

FLIGHT_FEATURES = ["dep_hour", "distance_km", "day_of_year", "quarter", "is_weekend", "l_quantity",
                   "l_discount", "air_time", "cancelled"]
DOC_FEATURES = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share", "lang_en", "lang_fr", "lang_de"]


def _flight_xy(spark, sf):
    x = flight_features(spark, sf).where(F.col("arrival_delay").isNotNull())
    x = x.select("flight_id", "l_partkey", *[F.col(c).cast("double") for c in FLIGHT_FEATURES],
                 F.col("arrival_delay").alias("label"))
    x = sampling.hash_split(x, ["flight_id", "l_partkey"], {"train": 0.8, "test": 0.2})
    # stored once as columns, which every model and the scoring read anew; a checkpoint would be made twice.
    # Sorted, so that the rows drawn for thresholds and bags are the same in each run
    x = x.sortWithinPartitions("flight_id", "l_partkey", *FLIGHT_FEATURES, "label")
    return md.assemble(stored(x), FLIGHT_FEATURES)


def doc_features(spark, sf):
    d = load_table(spark, sf, "documents")
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1))
    return d.select(
        "doc_id", F.length(t).cast("double").alias("n_chars"), tx.word_count(t).cast("double").alias("n_words"),
        F.size(F.split(t, "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace(t, "[^0-9]", "")) / n).alias("digit_share"),
        (F.length(F.regexp_replace(t, "[^A-Z]", "")) / n).alias("upper_share"),
        *[(F.col("lang") == lg).cast("double").alias(f"lang_{lg}") for lg in ("en", "fr", "de")])


def _doc_xy(spark, sf, label="quality"):
    lab = load_table(spark, sf, "labels").select("doc_id", F.col(label).cast("double").alias("label"))
    x = doc_features(spark, sf).join(lab, "doc_id")
    x = sampling.hash_split(x, ["doc_id"], {"train": 0.8, "test": 0.2})
    return cut_lineage(md.assemble(x, DOC_FEATURES))


@query("mod1_regressor_comparison", covers="MOD1 EVA1 EVA7 SRT7 SMP1")
def mod1(spark, sf):
    x = _flight_xy(spark, sf)
    res = md.compare_regressors(spark, x.where("split = 'train'"), x.where("split = 'test'"))
    best = ev.best_run(res, "model", "rmse", maximize=False).first()["best_model"]     # EVA7 / SRT7
    return res.withColumn("is_best", F.col("model") == best)


@query("mod1_linear_closed_form", covers="MOD1", sql="""
SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 1) AS intercept,
       count(*) AS n_rows FROM lineitem""")
def mod1l(spark, sf):
    li = load_table(spark, sf, "lineitem").select(F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("label"))
    m = md.regressors()["linear"].setLabelCol("label").setFeaturesCol("features").fit(md.assemble(li, ["x"]))
    return li.agg(F.count(F.lit(1)).alias("n_rows")).select(F.round(F.lit(float(m.coefficients[0])), 3).alias("slope"),
                                                          F.round(F.lit(float(m.intercept)), 1).alias("intercept"), "n_rows")


@query("mod1_linear_beats_mean", covers="MOD1 SMP1 EVA1", sql=with_flights(f"""
SELECT count(*) AS n_test, TRUE AS beats_mean FROM (
  SELECT {split_sql(42, ["flight_id", "l_partkey"], {"train": 0.8, "test": 0.2})} AS split FROM flights WHERE arrival_delay IS NOT NULL)
WHERE split = 'test'"""))
def mod1b(spark, sf):
    x = _flight_xy(spark, sf)
    train, test = x.where("split = 'train'"), x.where("split = 'test'")
    res = md.compare_regressors(spark, train, test, {"linear": md.regressors()["linear"]})
    mean = train.agg(F.avg("label")).first()[0]
    base = test.agg(F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(F.pow(F.col("label") - F.lit(mean), 2))).alias("mean_rmse"))
    rmse = res.first()["rmse"]
    return base.select("n_test", (F.lit(rmse) <= F.col("mean_rmse")).alias("beats_mean"))


@query("mod2_classifier_comparison", covers="MOD2 EVA4 EVA7")
def mod2(spark, sf):
    x = _doc_xy(spark, sf)
    res = md.compare_classifiers(spark, x.where("split = 'train'"), x.where("split = 'test'"))
    best = ev.best_run(res, "model", "macro_f1").first()["best_model"]
    return res.withColumn("is_best", F.col("model") == best)


@query("mod3_grid_search_cv", covers="MOD3 SMP2")
def mod3(spark, sf):
    x = _doc_xy(spark, sf)
    x = sampling.stratified_folds(x, "label", ["doc_id"], k=3)
    cvm = md.grid_search_cv(x, LogisticRegression(maxIter=30), {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]},
                            BinaryClassificationEvaluator(), fold_col="fold", k=3)
    return md.cv_results(spark, cvm)


_PENALTIES = [0.0, 0.01, 0.1, 1.0]


# The oracle fits each fold on its rows (normal equations of two features) and scores the held-out rows one by one.
@query("mod3_ridge_shared_sums", covers="MOD3 MOD1 EVA1 EVA7 SMP1", sql=f"""
WITH x AS (SELECT CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) AS b, CAST(l_extendedprice AS DOUBLE) AS y,
                  {h_sql(42, "l_orderkey", "l_linenumber")} % 5 AS fold FROM lineitem),
f AS (SELECT DISTINCT fold FROM x),
p AS (SELECT unnest({_PENALTIES!r}::DOUBLE[]) AS penalty),
m AS (SELECT f.fold, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab,
             covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, count(*) AS n_train FROM f JOIN x ON x.fold <> f.fold GROUP BY f.fold),
c AS (SELECT *, va * (1 + penalty) * vb * (1 + penalty) - ab * ab AS det FROM m, p),
w AS (SELECT *, (ay * vb * (1 + penalty) - ab * by_) / det AS wa, (by_ * va * (1 + penalty) - ab * ay) / det AS wb FROM c),
e AS (SELECT penalty, w.fold, any_value(n_train) AS n_train, count(*) AS n_test,
             sqrt(avg(power(y - my - wa * (a - ma) - wb * (b - mb), 2))) AS rmse FROM w JOIN x ON x.fold = w.fold GROUP BY 1, 2),
g AS (SELECT penalty, avg(rmse) AS mean_rmse FROM e GROUP BY 1)
SELECT penalty, fold, n_train, n_test, round(rmse, 4) AS rmse, round(mean_rmse, 4) AS mean_rmse,
       penalty = (SELECT penalty FROM g ORDER BY mean_rmse, penalty DESC LIMIT 1) AS is_best
FROM e JOIN g USING (penalty)""")
def mod3r(spark, sf):
    x = load_table(spark, sf, "lineitem")
    x = x.withColumn("fold", F.pmod(sampling.hash64(["l_orderkey", "l_linenumber"], 42), F.lit(5)))
    res = ridge.ridge_cv(x, ["l_quantity", "l_discount"], "l_extendedprice", "fold", _PENALTIES)
    return res.withColumns({c: F.round(c, 4) for c in ("rmse", "mean_rmse")})


@query("mod4_random_search_cv", covers="MOD4 SMP2")
def mod4(spark, sf):
    x = sampling.stratified_folds(_doc_xy(spark, sf), "label", ["doc_id"], k=3)
    cvm, _maps = md.random_search_cv(x, GBTClassifier(seed=42),
                                     {"maxDepth": [2, 3, 4], "maxIter": [5, 10], "stepSize": [0.05, 0.1]},
                                     BinaryClassificationEvaluator(), n_iter=3, fold_col="fold", k=3)
    return md.cv_results(spark, cvm)


@query("mod7_mlp_embeddings", covers="MOD7 EVA3 EVA4")
def mod7(spark, sf):
    e = load_table(spark, sf, "embeddings")
    x = e.select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"))
    x = sampling.hash_split(x, ["vec_id"], {"train": 0.8, "test": 0.2})
    model = md.mlp_classifier([64, 32, 10], max_iter=100).fit(x.where("split = 'train'"))
    pred = model.transform(x.where("split = 'test'"))
    rep = ev.per_class_report(pred.select("label", "prediction"))
    return ev.summary_report(rep)


@query("mod8_delay_pipeline_saved", covers="MOD8 FEA7 FEA1 NUL3 NUL4 EVA1 EVA2 SNK6")
def mod8(spark, sf):
    # raw columns, NULLs included: the saved pipeline does the imputing and encoding
    x = flight_features(spark, sf).where(F.col("arrival_delay").isNotNull())
    x = x.select("flight_id", "l_partkey", *[F.col(c).cast("double") for c in FLIGHT_FEATURES],
                 "dep_time_bucket", "cancellation_reason", F.col("arrival_delay").alias("label"))
    # stored as columns: the medians, each fitted stage and the trees read the rows anew, a checkpoint would be made twice
    x = stored(sampling.hash_split(x, ["flight_id", "l_partkey"], {"train": 0.8, "test": 0.2}))
    train = x.where("split = 'train'")
    stages = md.preprocessing_stages(train, FLIGHT_FEATURES, ["dep_time_bucket", "cancellation_reason"], keep_unseen=False)
    path = shared_path(spark, "models", "delay_gbt", uuid.uuid4().hex[:12])
    model = md.fit_save_pipeline(train, stages + [GBTRegressor(maxIter=20, maxDepth=4, seed=42)], path)
    pred = model.transform(x.where("split = 'test'"))
    # scored rows replace the previous predictions table (SNK6)
    out = shared_path(spark, "tables", "pipeline_test_predictions", uuid.uuid4().hex[:12])
    pred.select("flight_id", "l_partkey", F.col("prediction").alias("predicted_arrival_delay")) \
        .write.mode("overwrite").parquet(out)
    return ev.regression_metrics(pred)


@query("fea7_saved_encoder", covers="FEA7 FEA4 FEA5 MOD8", sql="""
WITH lv AS (SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 10 AND p_type <> 'PROMO')),
lb AS (SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT p_brand FROM part WHERE p_size <= 10 AND p_type <> 'PROMO'))
SELECT p_partkey, CAST(coalesce(lv.code, -1) AS INTEGER) AS p_type_code, CAST(coalesce(lb.code, -1) AS INTEGER) AS p_brand_code
FROM part p LEFT JOIN lv ON p.p_type = lv.p_type LEFT JOIN lb ON p.p_brand = lb.p_brand""")
def fea7(spark, sf):
    """Codes of an encoder that was fitted, saved inside a pipeline model, and read back."""
    p = load_table(spark, sf, "part")
    cols = ["p_type", "p_brand"]
    stage = OrdinalEncoder(inputCols=cols, outputCols=[f"{c}_code" for c in cols])
    model = md.fit_save_pipeline(p.where("p_size <= 10 AND p_type <> 'PROMO'"), [stage], shared_path(spark, "models", "encoder", uuid.uuid4().hex[:12]))
    return model.transform(p).select("p_partkey", "p_type_code", "p_brand_code")


@query("mod9_pseudo_labeling_curve", covers="MOD9 EVA6 FLT8 SET3")
def mod9(spark, sf):
    x = _doc_xy(spark, sf)
    labelled = x.select("doc_id", "features", "label")
    unl = md.assemble(doc_features(spark, sf).join(load_table(spark, sf, "labels").select("doc_id"), "doc_id",
                                                   "left_anti"), DOC_FEATURES).select("doc_id", "features")
    train = labelled.join(x.where("split = 'train'").select("doc_id"), "doc_id")
    test = labelled.join(x.where("split = 'test'").select("doc_id"), "doc_id")
    return md.pseudo_labeling(spark, train, test, unl, "doc_id", rounds=3, threshold=0.2)


@query("mod10_active_learning_curve", covers="MOD10 SRT5 EVA6 SNK7")
def mod10(spark, sf):
    x = _doc_xy(spark, sf).select("doc_id", "features", "label", "split")
    test = x.where("split = 'test'").drop("split")
    rest = x.where("split = 'train'").drop("split")
    seed_ids = sampling.hash_sample(rest.select("doc_id"), ["doc_id"], 50)
    train = rest.join(seed_ids, "doc_id")
    pool = rest.join(seed_ids, "doc_id", "left_anti")
    oracle = rest.select("doc_id", "label")
    return md.active_learning(spark, train, test, pool, oracle, "doc_id", k=20, rounds=3,
                              export_dir=shared_path(spark, "active_learning", uuid.uuid4().hex[:12]))


@query("fea10_word2vec_sentence_vectors", covers="FEA10 TXT1")
def fea10(spark, sf):
    d = spread(load_table(spark, sf, "documents"), cores(spark)).select("doc_id", tx.tokenize(tx.remove_punctuation("text")).alias("tokens"))
    v = md.sentence_vectors_w2v(d, "doc_id", "tokens", size=100)
    return v.select("doc_id", F.sqrt(F.aggregate("sentence_vector", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))


@query("fea11_pca_centered_embeddings", covers="FEA11")
def fea11(spark, sf):
    p = md.pca_centered(load_table(spark, sf, "embeddings"), "embedding", 2)
    return p.select("vec_id", "label", F.col("pca")[0].alias("pc1"), F.col("pca")[1].alias("pc2"))


@query("fea11_pca_properties", covers="FEA11", sql="""
SELECT count(*) AS n_rows, CAST(0 AS DOUBLE) AS mean_pc1, CAST(0 AS DOUBLE) AS mean_pc2, TRUE AS ordered, TRUE AS uncorrelated FROM embeddings""")
def fea11p(spark, sf):
    p = md.pca_centered(load_table(spark, sf, "embeddings"), "embedding", 2)
    a, b = F.col("pca")[0], F.col("pca")[1]
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.abs(F.round(F.avg(a), 6)).alias("mean_pc1"), F.abs(F.round(F.avg(b), 6)).alias("mean_pc2"),
                 (F.var_pop(a) >= F.var_pop(b)).alias("ordered"), (F.abs(F.corr(a, b)) < 1e-6).alias("uncorrelated"))


@query("eva8_kmeans_silhouette_overlap", covers="EVA8")
def eva8(spark, sf):
    e = load_table(spark, sf, "embeddings").withColumn("features", array_to_vector("embedding"))
    model, _scores = md.kmeans_by_silhouette(e, "features", [5, 10])
    c = model.transform(e).select("vec_id", "label", F.col("prediction").alias("cluster"))
    # cluster -> its majority label (ties: smaller label)
    maj = (c.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("cluster").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("mapped")))
    j = c.join(maj, "cluster")
    return md.mask_overlap(j, "label", "label", "mapped")
