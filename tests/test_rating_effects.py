import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import recsys


def biased(spark, n_users=30, n_items=20):
    """Ratings with strong user and item effects, and one user with a third of all rows."""
    rnd = np.random.default_rng(5)
    u, i = rnd.normal(0, 1.0, n_users + 1), rnd.normal(0, 1.0, n_items + 100)
    rows = [(a, b, float(3 + u[a] + i[b] + rnd.normal(0, 0.1))) for a in range(n_users) for b in range(n_items) if (a * 7 + b * 3) % 4]
    rows += [(n_users, b, float(3 + u[n_users] + i[b] + rnd.normal(0, 0.1))) for b in range(n_items + 100)]
    return spark.createDataFrame(rows, "user_id INT, item_id INT, rating DOUBLE")


def test_effects_settle_at_the_damped_means(spark):
    df = biased(spark).unionByName(spark.createDataFrame([(1, 2, None)], "user_id INT, item_id INT, rating DOUBLE"))
    e = recsys.fit_effects(df, damping=(2.0, 3.0), max_rounds=100, tolerance=1e-6)
    assert e.rounds < 100 and e.change <= 1e-6
    rows = [r for r in df.collect() if r.rating is not None]
    users = {r.user_id: r.user_effect for r in e.users.collect()}
    items = {r.item_id: r.item_effect for r in e.items.collect()}
    assert e.mean == pytest.approx(np.mean([r.rating for r in rows]))
    for side, other, key, okey, damp in ((users, items, "user_id", "item_id", 2.0), (items, users, "item_id", "user_id", 3.0)):
        for k, v in side.items():
            rest = [r.rating - e.mean - other[r[okey]] for r in rows if r[key] == k]
            assert v == pytest.approx(sum(rest) / (len(rest) + damp), abs=1e-4)


def test_bias_removal_lowers_the_held_out_error(spark):
    df = biased(spark).withColumn("held", F.pmod(F.xxhash64("user_id", "item_id"), F.lit(5)) == 0).cache()
    train, test = df.where("NOT held"), df.where("held")
    gm = train.agg(F.avg("rating")).first()[0]
    edges = spark.createDataFrame([], "src INT, dst INT, weight DOUBLE")
    rmse = []
    for effects in (None, recsys.fit_effects(train, damping=(1.0, 1.0))):
        p = recsys.blend_predictions(test, recsys.fit_als(train, gm, rank=2, max_iter=5, effects=effects), train, edges, gm, -9.0, 15.0, effects=effects)
        rmse.append(p.where("known_user AND known_item").agg(F.sqrt(F.avg(F.pow(F.col("mf_pred") - F.col("rating"), 2)))).first()[0])
    assert rmse[1] < 0.8 * rmse[0]


def test_unknown_keys_and_empty_tables(spark):
    e = recsys.fit_effects(biased(spark), max_rounds=2)
    pairs = spark.createDataFrame([(1, 1), (999, 1), (1, 999), (999, 999)], "user_id INT, item_id INT")
    got = {(r.user_id, r.item_id): r.bias for r in recsys.with_effects(pairs, e).collect()}
    assert got[999, 999] == pytest.approx(e.mean) and got[1, 1] == pytest.approx(got[999, 1] + got[1, 999] - e.mean)
    none = recsys.fit_effects(biased(spark).limit(0))
    assert none.mean is None and none.users.count() == 0 and none.items.count() == 0


def test_effects_sent_in_blocks_are_the_same(spark):
    df = biased(spark)
    one, many = (recsys.fit_effects(df, max_rounds=3, tolerance=0.0, broadcast_keys=n) for n in (None, 7))
    for a, b, key, name in ((one.users, many.users, "user_id", "user_effect"), (one.items, many.items, "item_id", "item_effect")):
        was, now = ({r[key]: r[name] for r in df.collect()} for df in (a, b))
        assert was.keys() == now.keys() and all(now[k] == pytest.approx(was[k], abs=1e-12) for k in was)


def test_rounds_do_not_shuffle_or_copy_the_ratings(spark):
    """The written bytes of the folds' fits stay below a few copies of the ratings; each fold wrote and shuffled its own."""
    from tessera import session

    n = 60_000
    df = spark.range(n).select((F.col("id") % 50).alias("user_id"), F.expr("id div 50").alias("item_id"), F.rand(3).alias("rating"))
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session.ensure_checkpoint_dir(spark))
    written = lambda: folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    before = written()
    scores, _ = recsys.als_grid_cv(df, 0.5, ranks=(2,), regs=(0.1,), k=5, max_iter=1, remove_bias=True, parallelism=1)
    assert scores.count() == 1
    assert written() - before < 100 * n


def test_rating_split_is_dealt_once(spark, sf):
    """each read of a part reads stored columns; the hash that deals the rows is not computed again."""
    from tessera.plans.recsys import _rating_split, ratings
    train, test = _rating_split(spark, sf)
    for part in (train, test):
        plan = part.select("rating")._jdf.queryExecution().executedPlan().toString()
        assert "md5" not in plan and "parquet" in plan.lower() and "Existing" not in plan
    whole = {tuple(r) for r in ratings(spark, sf).collect()}
    a, b = ({tuple(r)[:3] for r in p.collect()} for p in (train, test))
    assert a and b and not a & b and a | b == whole
