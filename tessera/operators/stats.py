"""Statistics and inference (STT1-STT9, SCA29, AGG18).

Everything that scales with rows -- counts, sums, moments, medians,
absolute deviations -- is a distributed aggregate.  Tests of many groups get
their p-values from expressions (``functions.pvalues``); a single test's few
numbers are finished on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import pvalues as pv
from tessera.functions.distributions import f_sf, norm_sf, t_sf

Z95 = 1.96  # fixed two-sided 95 % normal quantile used by the reference


def proportion_interval(p_hat: Column, n: Column, z: float = Z95) -> tuple[Column, Column, Column]:
    """STT2: (standard error, lower, upper) for a proportion."""
    se = F.sqrt(p_hat * (F.lit(1.0) - p_hat) / n)
    return se, p_hat - F.lit(z) * se, p_hat + F.lit(z) * se


def weighted_proportion(df: DataFrame, share_pct: str, n: str, by: list[str] | None = None) -> DataFrame:
    """AGG18 + STT2: p = sum(share/100 * n) / sum(n) with its 95 % interval."""
    g = df.groupBy(*(by or [])).agg(F.sum(F.col(share_pct) / 100.0 * F.col(n)).alias("weighted"),
                                    F.sum(n).alias("n_total"))
    g = g.withColumn("p_hat", F.col("weighted") / F.col("n_total"))
    se, lo, hi = proportion_interval(F.col("p_hat"), F.col("n_total"))
    return g.withColumn("se", se).withColumn("lower", lo).withColumn("upper", hi)


def interval_coverage(samples: DataFrame, sample_col: str, outcome: str, p_true: float,
                      z: float = Z95) -> DataFrame:
    """STT3: share of samples whose 95 % interval for the mean of a 0/1
    ``outcome`` contains ``p_true``."""
    s = samples.groupBy(sample_col).agg(F.avg(outcome).alias("p_hat"), F.count(F.lit(1)).alias("n"))
    _se, lo, hi = proportion_interval(F.col("p_hat"), F.col("n"), z)
    covered = ((F.lit(p_true) >= lo) & (F.lit(p_true) <= hi)).cast("double")
    return s.agg(F.avg(covered).alias("coverage"), F.count(F.lit(1)).alias("n_samples"))


def spread_test(p: float, n: float, z: float = Z95) -> dict:
    """STT4: spread d = 2p - 1, its SE, interval, Z and two-sided p-value."""
    d = 2 * p - 1
    se = 2 * math.sqrt(p * (1 - p) / n)
    zz = d / se if se > 0 else float("nan")
    return {"spread": d, "se": se, "lower": d - z * se, "upper": d + z * se, "z": zz,
            "p_value": 2 * norm_sf(abs(zz)) if se > 0 else float("nan")}


def _two_group_sums(df: DataFrame, group: str, a, b, values: list[str]) -> dict:
    """{(metric, group): row} with count, mean, sample variance, and count, mean and population
    variance of the absolute deviations from the group's median; three passes for all metrics."""
    from tessera.operators.quantiles import exact_quantiles
    long = (df.where(F.col(group).isin([a, b]))
            .select(F.col(group).alias("__g"), F.explode(F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("x"))
                                                                   for v in values])).alias("s")).select("__g", "s.*")
            .where(F.col("x").isNotNull() & ~F.isnan("x")))
    med = exact_quantiles(long, "x", [0.5], ["metric", "__g"])
    z = long.join(med, ["metric", "__g"]).withColumn("z", F.abs(F.col("x") - F.col("q50")))
    rows = z.groupBy("metric", "__g").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.var_samp("x").alias("var"),
        F.avg("z").alias("zbar"), F.var_pop("z").alias("zvar")).collect()  # two rows per metric
    return {(r["metric"], r["__g"]): r for r in rows}


def _levene_from(ra, rb) -> tuple[float, float]:
    n, k = ra["n"] + rb["n"], 2
    zall = (ra["n"] * ra["zbar"] + rb["n"] * rb["zbar"]) / n
    between = sum(r["n"] * (r["zbar"] - zall) ** 2 for r in (ra, rb))
    within = sum(r["n"] * r["zvar"] for r in (ra, rb))
    if n - k <= 0 or not within:
        return float("nan"), float("nan")
    w = (n - k) / (k - 1) * between / within
    return w, f_sf(w, k - 1, n - k)


def levene(df: DataFrame, group: str, value: str, groups: list) -> tuple[float, float]:
    """STT6: Brown-Forsythe/Levene W (median-centred) of two groups and its p-value.
    Group medians are exact; NULL and NaN are left out."""
    m = _two_group_sums(df, group, *groups, [value])
    if any((value, g) not in m for g in groups):
        return float("nan"), float("nan")
    return _levene_from(*(m[value, g] for g in groups))


def ttest(df: DataFrame, group: str, a, b, value: str, equal_var: bool | None = None,
          alpha: float = 0.05) -> dict:
    """STT7: two-sample t-test; pooled when Levene p >= alpha (or as given),
    Welch otherwise; p-values for two-sided, greater (a > b) and less."""
    m = _two_group_sums(df, group, a, b, [value])
    return _ttest_from(value, m[value, a], m[value, b], equal_var, alpha)


def _ttest_from(value: str, ra, rb, equal_var: bool | None, alpha: float) -> dict:
    n1, n2, m1, m2, v1, v2 = ra["n"], rb["n"], ra["mean"], rb["mean"], ra["var"] or 0.0, rb["var"] or 0.0
    lev_w, lev_p = _levene_from(ra, rb)
    if equal_var is None:
        equal_var = not (lev_p < alpha)
    if equal_var:
        dof = float(n1 + n2 - 2)
        sp = ((n1 - 1) * v1 + (n2 - 1) * v2) / dof
        se = math.sqrt(sp * (1 / n1 + 1 / n2))
    else:
        se = math.sqrt(v1 / n1 + v2 / n2)
        dof = (v1 / n1 + v2 / n2) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1))
    t = (m1 - m2) / se
    p_greater = t_sf(t, dof)
    p_less = 1.0 - p_greater
    p_two = 2 * min(p_greater, p_less)
    return {"metric": value, "n_a": n1, "n_b": n2, "mean_a": m1, "mean_b": m2, "var_a": v1, "var_b": v2,
            "levene_w": lev_w, "levene_p": lev_p, "equal_var": bool(equal_var), "t": t, "dof": dof,
            "p_two_sided": p_two, "p_greater": p_greater, "p_less": p_less,
            "reject_two_sided": bool(p_two < alpha)}


TTEST_SCHEMA = ("metric STRING, n_a BIGINT, n_b BIGINT, mean_a DOUBLE, mean_b DOUBLE, var_a DOUBLE, var_b DOUBLE, "
                "levene_w DOUBLE, levene_p DOUBLE, equal_var BOOLEAN, t DOUBLE, dof DOUBLE, p_two_sided DOUBLE, "
                "p_greater DOUBLE, p_less DOUBLE, reject_two_sided BOOLEAN")


def ttest_table(spark: SparkSession, df: DataFrame, group: str, a, b, values: list[str],
                alpha: float = 0.05, equal_var: bool | None | tuple = None) -> DataFrame:
    """STT7 for several columns, from one long frame; of several ``equal_var`` each gives its rows,
    from the same sums."""
    m = _two_group_sums(df, group, a, b, values)
    settings = equal_var if isinstance(equal_var, tuple) else (equal_var,)
    rows = [_ttest_from(v, m[v, a], m[v, b], e, alpha) for e in settings for v in values]
    return spark.createDataFrame([tuple(r.values()) for r in rows], TTEST_SCHEMA)


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """STT8: pairwise-complete Pearson correlation for every column pair, one
    aggregate pass; returned long (col_a, col_b, corr)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    longf = row.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")
    mirrored = longf.where("col_a <> col_b").select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return longf.unionByName(mirrored)


def f_regression(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """STT9: univariate F = r^2 / (1 - r^2) * (n - 2) per feature (centred)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.corr(c, target).alias(c) for c in features])
    stack = ", ".join(f"'{c}', `{c}`" for c in features)
    x = row.selectExpr("n", f"stack({len(features)}, {stack}) AS (feature, r)")
    return x.withColumn("f_stat", F.pow("r", 2) / (F.lit(1.0) - F.pow("r", 2)) * (F.col("n") - 2))


def f_regression_pvalues(fr: DataFrame) -> DataFrame:
    """STT9: p-value of each row of ``f_regression``."""
    return fr.withColumn("p_value", pv.f_sf(F.col("f_stat"), F.lit(1.0), F.col("n") - 2))


def spread_p_value(z) -> Column:
    """STT4: two-sided p-value of a spread's z."""
    return 2 * pv.norm_sf(F.abs(z))


def ttest_by(df: DataFrame, keys: list[str], group: str, a, b, value: str, equal_var: bool = False) -> DataFrame:
    """STT7 for every key: (keys, n_a, n_b, mean_a, mean_b, t, dof, p_two_sided, p_greater, p_less), Welch's
    or the pooled test.  One aggregate, however many keys; p-values are expressions.

    NULL and NaN values are left out; keys with fewer than two values in a group, or
    without any variance, have no row."""
    x = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(group).isin([a, b]))
    side = {s: F.when(F.col(group) == g, F.col(value).cast("double")) for s, g in (("a", a), ("b", b))}
    sums = x.groupBy(*keys).agg(*[f(v).alias(f"{n}_{s}") for s, v in side.items() for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))])
    n1, n2, v1, v2 = (F.col(c) for c in ("n_a", "n_b", "var_a", "var_b"))
    sums = sums.where((n1 > 1) & (n2 > 1) & (v1 + v2 > 0))
    if equal_var:
        dof = (n1 + n2 - 2).cast("double")
        se = F.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / dof * (1 / n1 + 1 / n2))
    else:
        se = F.sqrt(v1 / n1 + v2 / n2)
        dof = F.pow(v1 / n1 + v2 / n2, 2) / (F.pow(v1 / n1, 2) / (n1 - 1) + F.pow(v2 / n2, 2) / (n2 - 1))
    tests = sums.withColumns({"t": (F.col("mean_a") - F.col("mean_b")) / se, "dof": dof})
    p = tests.withColumn("p_greater", pv.t_sf(F.col("t"), F.col("dof"))).withColumn("p_less", 1 - F.col("p_greater"))
    return p.withColumn("p_two_sided", 2 * F.least("p_greater", "p_less")).drop("var_a", "var_b")


def gaussian_density_and_score(df: DataFrame, x: str, y: str, mu: tuple, cov: tuple) -> DataFrame:
    """SCA29: bivariate normal density and score -Sigma^-1 (p - mu) as columns."""
    (sxx, sxy), (_syx, syy) = cov
    det = sxx * syy - sxy * sxy
    ixx, ixy, iyy = syy / det, -sxy / det, sxx / det
    dx, dy = F.col(x) - F.lit(mu[0]), F.col(y) - F.lit(mu[1])
    q = dx * dx * ixx + 2 * dx * dy * ixy + dy * dy * iyy
    return (df.withColumn("density", F.exp(-0.5 * q) / F.lit(2 * math.pi * math.sqrt(det)))
              .withColumn("score_x", -(dx * ixx + dy * ixy))
              .withColumn("score_y", -(dx * ixy + dy * iyy)))
