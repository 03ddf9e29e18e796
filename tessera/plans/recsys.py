"""Recommendation and evaluation queries.

ratings(user = o_custkey, item = l_partkey, rating = avg quantity / 5) from
lineitem x orders; trust edge = customer of an order -> customer of the next
order (one edge per order, weight = number of such links).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluation as ev
from tessera.operators import recsys as rs
from tessera.operators import retrieval as rt
from tessera.operators import sampling
from tessera.plans.registry import query
from tessera.plans.sqlhash import split_sql
from tessera.plans.text import _centroids
from tessera.session import stored
from tessera.sources.tables import load_table


def _r(c, d=9):
    """Means of q/5 ratings terminate in decimal, so rounding them at 6 digits
    hits exact ties that summation-order noise decides differently per engine.
    These values are small (ratings, rates), so 9 decimals remove the noise and
    both engines return the same double (the SQL twin rounds to 9 too)."""
    return F.round(F.col(c), d).alias(c)


def _rated(spark, sf):
    li, o = load_table(spark, sf, "lineitem"), load_table(spark, sf, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
             .agg((F.avg("l_quantity") / 5).alias("rating")))


def ratings(spark, sf):
    """(user, item, rating); used as targets, neighbour ratings and key sets,
    so it is materialised once in the shared checkpoint folder."""
    return stored(_rated(spark, sf))


def trust_edges(spark, sf):
    o = load_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("dst"))
    e = o.join(nxt, "o_orderkey").where(F.col("o_custkey") != F.col("dst"))
    return e.groupBy(F.col("o_custkey").alias("src"), "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


_RS_SQL = """WITH ratings AS (SELECT o_custkey AS user_id, l_partkey AS item_id, avg(l_quantity) / 5 AS rating
                 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
edges AS (SELECT a.o_custkey AS src, b.o_custkey AS dst, CAST(count(*) AS DOUBLE) AS weight
          FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
          WHERE a.o_custkey <> b.o_custkey GROUP BY 1, 2),
gm AS (SELECT avg(rating) AS m FROM ratings)"""


@query("joi7_trust_weighted_rating", covers="JOI7", sql=_RS_SQL + """,
nb AS (SELECT r.user_id, r.item_id, sum(e.weight * n.rating) / sum(e.weight) AS tp, sum(e.weight) AS wt
       FROM ratings r JOIN edges e ON e.src = r.user_id
       JOIN ratings n ON n.user_id = e.dst AND n.item_id = r.item_id GROUP BY 1, 2)
SELECT r.user_id, r.item_id, round(CASE WHEN nb.wt > 0 THEN nb.tp ELSE gm.m END, 9) AS trust_pred
FROM ratings r LEFT JOIN nb ON r.user_id = nb.user_id AND r.item_id = nb.item_id, gm""")
def joi7(spark, sf):
    r = ratings(spark, sf)
    gm = r.agg(F.avg("rating")).first()[0]
    x = rs.trust_weighted_rating(r.select("user_id", "item_id"), trust_edges(spark, sf), r, gm)
    return x.select("user_id", "item_id", _r("trust_pred"))


@query("joi8_rating_feature_table", covers="JOI8 FEA9 AGG22 AGG23 NUL1 NUL5 SCA24", sql=_RS_SQL + """,
us AS (SELECT user_id, avg(rating) AS user_mean, stddev_samp(rating) AS user_std, count(*) AS user_cnt FROM ratings GROUP BY 1),
it AS (SELECT item_id, avg(rating) AS item_mean, stddev_samp(rating) AS item_std, count(*) AS item_cnt FROM ratings GROUP BY 1),
od AS (SELECT src AS user_id, count(*) AS trustor_trustee FROM edges GROUP BY 1),
id AS (SELECT dst AS user_id, count(*) AS trustee_trustor FROM edges GROUP BY 1)
SELECT r.user_id, r.item_id, round(coalesce(user_mean, gm.m), 9) AS user_mean, round(coalesce(user_std, 0), 9) AS user_std,
       coalesce(user_cnt, 0) AS user_cnt, round(coalesce(item_mean, gm.m), 9) AS item_mean,
       round(coalesce(item_std, 0), 9) AS item_std, coalesce(item_cnt, 0) AS item_cnt,
       coalesce(trustor_trustee, 0) AS trustor_trustee, coalesce(trustee_trustor, 0) AS trustee_trustor,
       round(gm.m + (coalesce(user_mean, 0) - gm.m) + (coalesce(item_mean, 0) - gm.m), 9) AS baseline_bias
FROM ratings r LEFT JOIN us USING (user_id) LEFT JOIN it USING (item_id) LEFT JOIN od USING (user_id)
     LEFT JOIN id USING (user_id), gm""")
def joi8(spark, sf):
    r = ratings(spark, sf)
    gm = r.agg(F.avg("rating")).first()[0]
    x = rs.feature_table(r.select("user_id", "item_id"), r, trust_edges(spark, sf), gm)
    return x.select("user_id", "item_id", _r("user_mean"), _r("user_std"), "user_cnt", _r("item_mean"), _r("item_std"),
                    "item_cnt", "trustor_trustee", "trustee_trustor", _r("baseline_bias"))


@query("eva1_baseline_bias_metrics", covers="EVA1 EVA2 FEA9", sql=_RS_SQL + """,
us AS (SELECT user_id, avg(rating) AS um FROM ratings GROUP BY 1),
it AS (SELECT item_id, avg(rating) AS im FROM ratings GROUP BY 1),
p AS (SELECT rating AS label, gm.m + (um - gm.m) + (im - gm.m) AS prediction
      FROM ratings JOIN us USING (user_id) JOIN it USING (item_id), gm)
SELECT count(*) AS n, round(avg(pow(prediction - label, 2)), 9) AS mse, round(sqrt(avg(pow(prediction - label, 2))), 9) AS rmse,
       round(avg(abs(prediction - label)), 9) AS mae,
       round(1 - sum(pow(prediction - label, 2)) / (var_pop(label) * count(*)), 9) AS r2,
       round(avg(2 * abs(prediction - label) / greatest(abs(label) + abs(prediction), 1e-8)) * 100, 9) AS smape,
       round(avg(abs(prediction - label) / abs(label)) * 100, 9) AS mape, round(sum(prediction - label), 4) + 0.0 AS cumulative_error
FROM p""")
def eva1(spark, sf):
    r = ratings(spark, sf)
    gm = r.agg(F.avg("rating")).first()[0]
    x = rs.feature_table(r, r, trust_edges(spark, sf), gm)
    m = ev.regression_metrics(x.withColumnRenamed("rating", "label").withColumnRenamed("baseline_bias", "prediction"))
    # "+ 0.0" turns a rounded -0.0 into 0.0
    return m.select("n", *[_r(c) for c in ("mse", "rmse", "mae", "r2", "smape", "mape")],
                    (F.round("cumulative_error", 4) + F.lit(0.0)).alias("cumulative_error"))


def _rating_split(spark, sf):
    """Split by row, so that most test rows have a known user and item; one user in twenty and one
    item in twenty-five are in no training row, so that the cold-start rules apply too.  The parts are
    stored with their rows: both are read many times, and the hash that deals them is dear."""
    r = sampling.hash_split(_rated(spark, sf), ["user_id", "item_id"], {"train": 0.85, "test": 0.15})
    cold = (F.pmod("user_id", F.lit(20)) == 0) | (F.pmod("item_id", F.lit(25)) == 0)
    r = stored(r.withColumn("split", F.when(cold, "test").otherwise(F.col("split"))))
    return r.where("split = 'train'"), r.where("split = 'test'")


_SPLIT_SQL = _RS_SQL + f""",
s AS (SELECT *, CASE WHEN user_id % 20 = 0 OR item_id % 25 = 0 THEN 'test'
             ELSE {split_sql(42, ["user_id", "item_id"], {"train": 0.85, "test": 0.15})} END AS split FROM ratings)"""


@query("mod6_blend_branches", covers="MOD6 JOI11", sql=_SPLIT_SQL + """
SELECT CASE WHEN user_id NOT IN (SELECT user_id FROM s WHERE split = 'train') THEN 'cold user'
            WHEN item_id NOT IN (SELECT item_id FROM s WHERE split = 'train') THEN 'cold item' ELSE 'blend' END AS branch,
       count(*) AS n_rows FROM s WHERE split = 'test' GROUP BY 1""")
def mod6b(spark, sf):
    train, test = _rating_split(spark, sf)
    f = rs.cold_start_flags(test, train)
    branch = F.when(~F.col("known_user"), "cold user").when(~F.col("known_item"), "cold item").otherwise("blend")
    return f.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("mod5_als_grid_cv", covers="MOD5 EVA1")
def mod5(spark, sf):
    train, _ = _rating_split(spark, sf)
    gm = train.agg(F.avg("rating")).first()[0]
    scores, _best = rs.als_grid_cv(train, gm, ranks=(5, 10), regs=(0.05, 0.2), k=5, max_iter=5, remove_bias=True)
    return scores


#: Two rounds of alternating damped effects over the training ratings.
_EFFECTS_SQL = _SPLIT_SQL + """,
t AS (SELECT user_id, item_id, CAST(rating AS DOUBLE) AS r FROM s WHERE split = 'train'),
tm AS (SELECT avg(r) AS m, min(r) AS lo, max(r) AS hi FROM t),
i1 AS (SELECT item_id, sum(r - m) / (count(*) + 10) AS e FROM t, tm GROUP BY 1),
u1 AS (SELECT user_id, sum(r - m - i1.e) / (count(*) + 10) AS e FROM t JOIN i1 USING (item_id), tm GROUP BY 1),
i2 AS (SELECT item_id, sum(r - m - u1.e) / (count(*) + 10) AS e FROM t JOIN u1 USING (user_id), tm GROUP BY 1),
u2 AS (SELECT user_id, sum(r - m - i2.e) / (count(*) + 10) AS e FROM t JOIN i2 USING (item_id), tm GROUP BY 1)"""


@query("mod5_rating_effects", covers="MOD5", sql=_EFFECTS_SQL + """
SELECT 'user' AS side, user_id AS id, round(e, 7) AS effect FROM u2 UNION ALL SELECT 'item', item_id, round(e, 7) FROM i2""")
def mod5_effects(spark, sf):
    e = rs.fit_effects(_rating_split(spark, sf)[0], max_rounds=2, tolerance=0.0)
    return (e.users.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), F.col("user_effect").alias("effect"))
            .unionByName(e.items.select(F.lit("item").alias("side"), F.col("item_id").alias("id"), F.col("item_effect").alias("effect")))
            .withColumn("effect", F.round("effect", 7)))


@query("mod6_blend_values", covers="MOD6 JOI7 JOI11", sql=_EFFECTS_SQL + """,
nb AS (SELECT x.user_id, x.item_id, sum(e.weight * n.r) / sum(e.weight) AS tp
       FROM s x JOIN edges e ON e.src = x.user_id JOIN t n ON n.user_id = e.dst AND n.item_id = x.item_id
       WHERE x.split = 'test' GROUP BY 1, 2),
im AS (SELECT item_id, avg(r) AS item_mean FROM t GROUP BY 1),
p AS (SELECT x.user_id, x.item_id, m, lo, hi, u2.user_id IS NOT NULL AS ku, i2.item_id IS NOT NULL AS ki, item_mean,
             0.8 * (m + coalesce(u2.e, 0) + coalesce(i2.e, 0)) + 0.2 * coalesce(tp, m) AS blend
      FROM s x LEFT JOIN u2 USING (user_id) LEFT JOIN i2 USING (item_id) LEFT JOIN im USING (item_id)
           LEFT JOIN nb ON nb.user_id = x.user_id AND nb.item_id = x.item_id, tm WHERE x.split = 'test')
SELECT user_id, item_id, round(least(greatest(CASE WHEN NOT ku THEN coalesce(item_mean, m) WHEN NOT ki THEN m ELSE blend END, lo), hi), 6) AS pred FROM p""")
def mod6_values(spark, sf):
    """The blending rule over factors that SQL can compute too: mean, user and item effects."""
    train, test = _rating_split(spark, sf)
    effects = rs.fit_effects(train, max_rounds=2, tolerance=0.0)
    lo, hi = [float(v) for v in train.agg(F.min("rating"), F.max("rating")).first()]
    given = rs.with_effects(test.select("user_id", "item_id"), effects, out="mf_pred")
    pred = rs.blend_given(given, train, trust_edges(spark, sf), effects.mean, lo, hi)
    return pred.select("user_id", "item_id", F.round("pred", 6).alias("pred"))


@query("mod6_blended_recommender", covers="MOD5 MOD6 JOI11 SCA23 SCA24 EVA1")
def mod6(spark, sf):
    train, test = _rating_split(spark, sf)
    gm = train.agg(F.avg("rating")).first()[0]
    effects = rs.fit_effects(train)
    model = rs.fit_als(train, gm, effects=effects)
    lo, hi = [float(v) for v in train.agg(F.min("rating"), F.max("rating")).first()]
    pred = rs.blend_predictions(test, model, train, trust_edges(spark, sf), gm, lo, hi, effects=effects)
    m = ev.regression_metrics(pred.withColumnRenamed("rating", "label").withColumnRenamed("pred", "prediction"))
    return m


_NC_SQL = """WITH c AS (SELECT label AS cls, list(v ORDER BY i) AS qvec FROM (
        SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT e.vec_id, e.label, c.cls,
             sqrt(list_sum(list_transform(range(1, 65), lambda i: pow(CAST(e.embedding[i] AS DOUBLE) - c.qvec[i], 2)))) AS dist
      FROM embeddings e, c),
p AS (SELECT vec_id, label, arg_min(cls, dist) AS prediction FROM d GROUP BY 1, 2)"""


def _nc_distances(spark, sf):
    """Distance of every vector to every class centroid: the scores of all one-vs-rest problems."""
    e = load_table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return rt.centroid_distances(e, _centroids(spark, sf), "vec_id", "embedding", "query_id", "qvec",
                                 keep=["label"], out_class="cls")


def _nc_predictions(spark, sf):
    e = load_table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return rt.nearest_centroid(e, _centroids(spark, sf), "vec_id", "embedding", "query_id", "qvec", keep=["label"])


@query("eva3_confusion_matrix_nearest_centroid", covers="EVA3", sql=_NC_SQL + """
SELECT label, prediction, count(*) AS count FROM p GROUP BY 1, 2""")
def eva3(spark, sf):
    return ev.confusion_matrix(_nc_predictions(spark, sf), "label", "prediction")


@query("eva4_class_report_nearest_centroid", covers="EVA4", sql=_NC_SQL + """,
cm AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2),
cl AS (SELECT DISTINCT label AS class FROM p UNION SELECT DISTINCT prediction FROM p),
s AS (SELECT cl.class, coalesce((SELECT sum(n) FROM cm WHERE cm.label = cl.class), 0) AS support,
             coalesce((SELECT sum(n) FROM cm WHERE cm.prediction = cl.class), 0) AS n_pred,
             coalesce((SELECT sum(n) FROM cm WHERE cm.label = cl.class AND cm.prediction = cl.class), 0) AS tp FROM cl),
q AS (SELECT class, support, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM s)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 9) AS f1,
       CAST(support AS BIGINT) AS support FROM q""")
def eva4(spark, sf):
    rep = ev.per_class_report(_nc_predictions(spark, sf), "label", "prediction")
    return rep.select("class", _r("precision"), _r("recall"), _r("f1"), F.col("support").cast("bigint"))


@query("eva4_macro_weighted_summary", covers="EVA4", sql=_NC_SQL + """,
cm AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2),
cl AS (SELECT DISTINCT label AS class FROM p UNION SELECT DISTINCT prediction FROM p),
s AS (SELECT cl.class, coalesce((SELECT sum(n) FROM cm WHERE cm.label = cl.class), 0) AS support,
             coalesce((SELECT sum(n) FROM cm WHERE cm.prediction = cl.class), 0) AS n_pred,
             coalesce((SELECT sum(n) FROM cm WHERE cm.label = cl.class AND cm.prediction = cl.class), 0) AS tp FROM cl),
q AS (SELECT class, support, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS pr,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS rc FROM s),
f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f1 FROM q)
SELECT round(sum(rc * support) / sum(support), 9) AS accuracy, round(avg(pr), 9) AS macro_precision,
       round(avg(rc), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1,
       round(sum(pr * support) / sum(support), 9) AS weighted_precision, round(sum(f1 * support) / sum(support), 9) AS weighted_f1
FROM f""")
def eva4s(spark, sf):
    rep = ev.per_class_report(_nc_predictions(spark, sf), "label", "prediction")
    out = ev.summary_report(rep)
    return out.select(*[_r(c) for c in out.columns])


@query("eva8_class_overlap", covers="EVA8", sql=_NC_SQL + """,
t AS (SELECT label, count(*) AS n_true FROM p GROUP BY 1), q AS (SELECT prediction AS label, count(*) AS n_pred FROM p GROUP BY 1),
b AS (SELECT label, count(*) AS n_both FROM p WHERE label = prediction GROUP BY 1),
x AS (SELECT label, coalesce(n_true, 0) AS a, coalesce(n_pred, 0) AS c, coalesce(n_both, 0) AS b
      FROM t FULL OUTER JOIN q USING (label) LEFT JOIN b USING (label))
SELECT label, round(b / (a + c - b), 9) AS iou, round(2 * b / (a + c), 9) AS dice FROM x""")
def eva8o(spark, sf):
    from tessera.operators.modeling import mask_overlap
    return mask_overlap(_nc_predictions(spark, sf), "label", "label", "prediction").select("label", _r("iou"), _r("dice"))


@query("eva5_roc_auc_one_vs_rest", covers="EVA5", sql=_NC_SQL + """,
s AS (SELECT cls, -dist AS score, CAST(label = cls AS BIGINT) AS pos FROM d),
pts AS (SELECT cls, score, sum(pos) AS p, sum(1 - pos) AS n FROM s GROUP BY 1, 2),
cum AS (SELECT cls, score, sum(p) OVER w / sum(p) OVER (PARTITION BY cls) AS tpr,
               sum(n) OVER w / sum(n) OVER (PARTITION BY cls) AS fpr
        FROM pts WINDOW w AS (PARTITION BY cls ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
tr AS (SELECT cls, (fpr - coalesce(lag(fpr) OVER o, 0)) * (tpr + coalesce(lag(tpr) OVER o, 0)) / 2 AS a
       FROM cum WINDOW o AS (PARTITION BY cls ORDER BY score DESC))
SELECT cls, round(sum(a), 9) AS auc FROM tr GROUP BY 1""")
def eva5(spark, sf):
    d = _nc_distances(spark, sf).withColumn("score", -F.col("dist")).withColumn(
        "pos", (F.col("label") == F.col("cls")).cast("long"))
    return ev.roc_auc(d, "pos", "score", by="cls").select("cls", _r("auc"))
