"""Recommendation (JOI7, JOI8, JOI11, FEA9, MOD5, MOD6, SCA23, SCA24).

The reference's per-row graph lookups become joins: targets x trust edges
on the user, then x ratings on (neighbour, item), aggregated per target.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage, stored

# ---- fixed values of the reference's blend ----------------------------------
SVD_WEIGHT, TRUST_WEIGHT = 0.8, 0.2
# -----------------------------------------------------------------------------


def trust_weighted_rating(targets: DataFrame, edges: DataFrame, ratings: DataFrame, global_mean: float,
                          user="user_id", item="item_id", rating="rating", src="src", dst="dst",
                          weight="weight", out="trust_pred") -> DataFrame:
    """JOI7: sum(w * r) / sum(w) over the items' ratings by users that ``user``
    trusts; the global mean when there is no neighbour or no such rating."""
    t = targets.select(user, item).distinct()
    # semi-joins first: only edges of users that have targets and ratings of
    # targeted items enter the (user x neighbour x item) join
    e = (edges.select(F.col(src).alias(user), F.col(dst).alias("__nb"), F.col(weight).alias("__w"))
              .join(t.select(user).distinct(), user, "left_semi"))
    r = (ratings.select(F.col(user).alias("__nb"), F.col(item), F.col(rating).alias("__r"))
                .join(t.select(item).distinct(), item, "left_semi"))
    nb = t.join(e, user).join(r, ["__nb", item])
    agg = nb.groupBy(user, item).agg((F.sum(F.col("__w") * F.col("__r")) / F.sum("__w")).alias("__tp"),
                                     F.sum("__w").alias("__wt"))
    j = targets.join(agg, [user, item], "left")
    return j.withColumn(out, F.when(F.col("__wt") > 0, F.col("__tp")).otherwise(F.lit(global_mean))).drop("__tp", "__wt")


def key_stats(ratings: DataFrame, key: str, rating="rating", prefix: str = "") -> DataFrame:
    """AGG22: mean, sample std (NULL for one row), count per key."""
    return ratings.groupBy(key).agg(F.avg(rating).alias(f"{prefix}mean"), F.stddev_samp(rating).alias(f"{prefix}std"),
                                    F.count(F.lit(1)).alias(f"{prefix}cnt"))


def feature_table(pairs: DataFrame, ratings: DataFrame, edges: DataFrame, global_mean: float,
                  user="user_id", item="item_id", rating="rating", src="src", dst="dst") -> DataFrame:
    """JOI8 + FEA9 + NUL1/NUL5: user/item statistics, trust degrees, bias feature.

    ``baseline_bias = mean + (user_mean or 0 - mean) + (item_mean or 0 - mean)``:
    a missing mean counts as 0, as in the reference."""
    us = key_stats(ratings, user, rating, "user_")
    it = key_stats(ratings, item, rating, "item_")
    out_deg = edges.groupBy(F.col(src).alias(user)).agg(F.count(F.lit(1)).alias("trustor_trustee"))
    in_deg = edges.groupBy(F.col(dst).alias(user)).agg(F.count(F.lit(1)).alias("trustee_trustor"))
    x = pairs.join(us, user, "left").join(it, item, "left").join(out_deg, user, "left").join(in_deg, user, "left")
    m = F.lit(global_mean)
    x = x.withColumn("baseline_bias", m + (F.coalesce(F.col("user_mean"), F.lit(0.0)) - m)
                     + (F.coalesce(F.col("item_mean"), F.lit(0.0)) - m))
    return x.fillna(global_mean, ["user_mean", "item_mean"]).fillna(0.0, ["user_std", "item_std"]).fillna(
        0, ["user_cnt", "item_cnt", "trustor_trustee", "trustee_trustor"])


def cold_start_flags(pairs: DataFrame, train: DataFrame, user="user_id", item="item_id") -> DataFrame:
    """JOI11: does the training data know this user / this item?"""
    ku = train.select(user).distinct().withColumn("known_user", F.lit(True))
    ki = train.select(item).distinct().withColumn("known_item", F.lit(True))
    return (pairs.join(ku, user, "left").join(ki, item, "left")
                 .fillna(False, ["known_user", "known_item"]))


@dataclass(frozen=True)
class RatingEffects:
    """rating = mean + user effect + item effect + rest: (user, user_effect), (item, item_effect), the rounds
    taken and the largest change of an effect in the last one."""

    mean: float
    users: DataFrame
    items: DataFrame
    rounds: int
    change: float


#: Keys whose effects are sent to the ratings at once; of more, one block after the other is.
BROADCAST_KEYS = 4_000_000


def _layouts(train: DataFrame, user: str, item: str, rating: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """The ratings in the order of items and of users, each in range partitions: a key's rows lie together
    (a key of a third of all ratings over many partitions), so sums by key leave a task as one row a key."""
    x = train.where(F.col(rating).isNotNull()).select(user, item, F.col(rating).cast("double").alias("__r"), *keep)
    parts = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_item = stored(x.repartitionByRange(parts, item, user))
    return by_item, stored(by_item.repartitionByRange(parts, user, item))


def _fit(by_item: DataFrame, by_user: DataFrame, user: str, item: str, damping: tuple[float, float], max_rounds: int, tolerance: float,
         broadcast_keys: int | None = None) -> RatingEffects:
    limit = BROADCAST_KEYS if broadcast_keys is None else broadcast_keys
    mean = by_item.agg(F.avg("__r")).first()[0]

    def side(x: DataFrame, key: str, other: str, effects: DataFrame, name: str, damp: float) -> DataFrame:
        held = [c for c in effects.columns if c != other][0]
        rest = F.col("__r") - F.lit(mean) - F.coalesce(F.col(held), F.lit(0.0))
        blocks = max(1, -(-effects.count() // limit))
        sums = None
        for b in range(blocks):
            of_block = F.pmod(F.xxhash64(other), F.lit(blocks)) == b
            part = x.where(of_block).join(F.broadcast(effects.where(of_block)), other, "left").groupBy(key).agg(
                F.sum(rest).alias("__s"), F.count(F.lit(1)).alias("__n"))
            part = part if blocks == 1 else cut_lineage(part)
            sums = part if sums is None else sums.unionByName(part)
        if blocks > 1:
            sums = sums.groupBy(key).agg(F.sum("__s").alias("__s"), F.sum("__n").alias("__n"))
        return cut_lineage(sums.select(key, (F.col("__s") / (F.col("__n") + damp)).alias(name)))

    users = cut_lineage(by_user.select(user).distinct().withColumn("user_effect", F.lit(0.0)))
    items, change, done = None, float("inf"), 0
    while done < max_rounds and change > tolerance:
        last_users, last_items = users, items
        items = side(by_item, item, user, users, "item_effect", damping[1])
        users = side(by_user, user, item, items, "user_effect", damping[0])
        moved = [(users, last_users, user, "user_effect")] + ([(items, last_items, item, "item_effect")] if last_items is not None else [])
        change = max(now.join(was.withColumnRenamed(name, "__was"), key).agg(F.max(F.abs(F.col(name) - F.col("__was")))).first()[0] or 0.0
                     for now, was, key, name in moved)
        done += 1
    return RatingEffects(mean, users, items, done, change)


def fit_effects(train: DataFrame, user="user_id", item="item_id", rating="rating", damping: tuple[float, float] = (10.0, 10.0),
                max_rounds: int = 20, tolerance: float = 1e-3, broadcast_keys: int | None = None) -> RatingEffects:
    """MOD5: damped user and item effects by alternating grouped means, until no effect moves by more than
    ``tolerance``: effect = sum of what the other side leaves / (ratings + damping).  The ratings are written
    in the order of items and of users once; in a round the effects of one side go to the ratings
    (``broadcast_keys`` at a time) and only sums by key are shuffled.

    NULL ratings are left out; the effects of an empty table are empty."""
    return _fit(*_layouts(train, user, item, rating), user, item, damping, max_rounds, tolerance, broadcast_keys)


def with_effects(pairs: DataFrame, effects: RatingEffects, user="user_id", item="item_id", out: str = "bias") -> DataFrame:
    """Adds mean + user effect + item effect; an unknown user or item has none."""
    sent = lambda df: F.broadcast(df) if df.count() <= BROADCAST_KEYS else df
    x = pairs.join(sent(effects.users), user, "left").join(sent(effects.items), item, "left")
    zero = F.lit(0.0)
    return x.withColumn(out, F.lit(effects.mean) + F.coalesce("user_effect", zero) + F.coalesce("item_effect", zero)).drop("user_effect", "item_effect")


def fit_als(train: DataFrame, global_mean: float, user="user_id", item="item_id", rating="rating",
            rank: int = 10, reg: float = 0.1, max_iter: int = 10, seed: int = 42, effects: RatingEffects | None = None):
    """MOD5: matrix factorisation on bias-removed ratings (mean-removed ones without ``effects``;
    ``coldStartStrategy=nan``)."""
    # ALS removes the shuffle files of the iterations before a checkpoint (by default every tenth); the factors are the same.
    als = ALS(userCol=user, itemCol=item, ratingCol="__res", rank=rank, regParam=reg, maxIter=max_iter,
              coldStartStrategy="nan", seed=seed, nonnegative=False, checkpointInterval=2)
    base = train.withColumn("__bias", F.lit(global_mean)) if effects is None else with_effects(train, effects, user, item, "__bias")
    return als.fit(base.withColumn("__res", F.col(rating) - F.col("__bias")))


def als_grid_cv(train: DataFrame, global_mean: float, ranks=(5, 10), regs=(0.05, 0.1), k: int = 5, max_iter: int = 10,
                user="user_id", item="item_id", rating="rating", seed: int = 42, parallelism: int = 4,
                remove_bias: bool = False):
    """MOD5: full grid of rank x regularisation, ``k`` fixed folds by hash of (user, item), mean fold RMSE;
    with ``remove_bias`` each fold's user and item effects are fitted on its training part and removed;
    unknown users or items of a fold predict the mean and the known effect.  Returns (scores table, model refitted on all
    of ``train`` with the best setting)."""
    from tessera.operators.sampling import hash64
    spark = train.sparkSession
    x = stored(train.select(user, item, rating).withColumn("__fold", F.pmod(hash64([user, item], seed), F.lit(k)).cast("int")))

    # all folds, and the fit to all ratings, read the same two orders of the ratings
    both = _layouts(x, user, item, rating, "__fold") if remove_bias else None
    damping, rounds, tolerance = (10.0, 10.0), 20, 1e-3

    def effects_of(rows) -> RatingEffects | None:
        return _fit(*[y.where(rows) for y in both], user, item, damping, rounds, tolerance) if remove_bias else None

    of_fold = [effects_of(F.col("__fold") != fold) for fold in range(k)]

    def fold_rmse(setting) -> float:
        rank, reg, fold = setting
        m = fit_als(x.where(F.col("__fold") != fold), global_mean, user, item, rating, rank, reg, max_iter, seed, of_fold[fold])
        p = m.transform(x.where(F.col("__fold") == fold))
        p = with_effects(p, of_fold[fold], user, item, "__bias") if remove_bias else p.withColumn("__bias", F.lit(global_mean))
        err = F.nanvl(F.col("prediction").cast("double"), F.lit(0.0)) + F.col("__bias") - F.col(rating)
        out = p.agg(F.sqrt(F.avg(err * err))).first()[0]
        # Spark removes a fit's shuffle files once its tables are collected as garbage, so that the disk holds only the fits that run.
        del m, p
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        return out

    grid = [(rank, reg) for rank in ranks for reg in regs]
    with ThreadPool(parallelism) as pool:  # Spark runs the fits side by side
        rmse = pool.map(fold_rmse, [(*g, fold) for g in grid for fold in range(k)])
    rows = [(int(rank), float(reg), sum(rmse[i * k:(i + 1) * k]) / k) for i, (rank, reg) in enumerate(grid)]
    best = min(rows, key=lambda r: (r[2], r[0], r[1]))
    effects = effects_of(F.lit(True))
    model = fit_als(train, global_mean, user, item, rating, best[0], best[1], max_iter, seed, effects)
    scores = spark.createDataFrame([(*r, r == best) for r in rows], "rank INT, reg DOUBLE, mean_rmse DOUBLE, is_best BOOLEAN")
    return scores, model


def blend_predictions(pairs: DataFrame, als_model, train: DataFrame, edges: DataFrame, global_mean: float,
                      lo: float, hi: float, user="user_id", item="item_id", rating="rating", effects: RatingEffects | None = None) -> DataFrame:
    """MOD6: 0.8 x MF + 0.2 x trust; unknown user -> item mean (else global
    mean); unknown item -> global mean; clipped to [lo, hi].  ``effects`` are those removed before the fit."""
    p = als_model.transform(pairs)
    p = p.withColumn("__bias", F.lit(global_mean)) if effects is None else with_effects(p, effects, user, item, "__bias")
    mf = F.coalesce(F.nanvl(F.col("prediction").cast("double"), F.lit(0.0)), F.lit(0.0)) + F.col("__bias")
    return blend_given(p.withColumn("mf_pred", mf).drop("prediction", "__bias"), train, edges, global_mean, lo, hi, user, item, rating)


def blend_given(pairs: DataFrame, train: DataFrame, edges: DataFrame, global_mean: float, lo: float, hi: float,
                user="user_id", item="item_id", rating="rating") -> DataFrame:
    """MOD6's rule for pairs that carry a factorisation's ``mf_pred``."""
    p = trust_weighted_rating(pairs, edges, train, global_mean, user, item, rating)
    p = cold_start_flags(p, train, user, item)
    item_mean = train.groupBy(item).agg(F.avg(rating).alias("__item_mean"))
    p = p.join(item_mean, item, "left")
    blend = F.lit(SVD_WEIGHT) * F.col("mf_pred") + F.lit(TRUST_WEIGHT) * F.col("trust_pred")
    pred = (F.when(~F.col("known_user"), F.coalesce(F.col("__item_mean"), F.lit(global_mean)))
             .when(~F.col("known_item"), F.lit(global_mean)).otherwise(blend))
    return p.withColumn("pred", F.least(F.greatest(pred, F.lit(lo)), F.lit(hi))).drop("__item_mean")
