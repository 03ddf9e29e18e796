import math
import random

import numpy as np
import pytest

from tessera.functions.distributions import betainc, f_sf, norm_sf, t_sf
from tessera.operators import nulls, profiling, stats


def test_distribution_values():
    assert 2 * t_sf(2.0, 10) == pytest.approx(0.073388, abs=1e-6)
    assert t_sf(1.812461, 10) == pytest.approx(0.05, abs=1e-6)
    assert f_sf(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert norm_sf(1.959964) == pytest.approx(0.025, abs=1e-6)
    assert betainc(2.0, 3.0, 0.4) == pytest.approx(0.5248, abs=1e-6)


def _groups():
    rnd = random.Random(1)
    a = [rnd.gauss(10, 2) for _ in range(40)] + [None]
    b = [rnd.gauss(11, 5) for _ in range(30)]
    return a, b


def test_ttest_welch_and_levene_match_numpy(spark):
    a, b = _groups()
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g STRING, v DOUBLE")
    r = stats.ttest(df, "g", "a", "b", "v")
    xa, xb = np.array([x for x in a if x is not None]), np.array(b)
    # Levene (median-centred) by hand
    za, zb = np.abs(xa - np.median(xa)), np.abs(xb - np.median(xb))
    z = np.concatenate([za, zb])
    n, k = len(z), 2
    w = (n - k) / (k - 1) * (len(za) * (za.mean() - z.mean()) ** 2 + len(zb) * (zb.mean() - z.mean()) ** 2) / (
        ((za - za.mean()) ** 2).sum() + ((zb - zb.mean()) ** 2).sum())
    assert r["levene_w"] == pytest.approx(w)
    assert r["equal_var"] is False
    va, vb = xa.var(ddof=1) / len(xa), xb.var(ddof=1) / len(xb)
    t = (xa.mean() - xb.mean()) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (len(xa) - 1) + vb ** 2 / (len(xb) - 1))
    assert r["t"] == pytest.approx(t) and r["dof"] == pytest.approx(dof)
    assert r["p_two_sided"] == pytest.approx(2 * t_sf(abs(t), dof))
    assert r["p_greater"] + r["p_less"] == pytest.approx(1.0)
    assert r["reject_two_sided"] == (r["p_two_sided"] < 0.05)


def test_pooled_when_equal_variance(spark):
    rnd = random.Random(5)
    rows = [("a", rnd.gauss(0, 1)) for _ in range(50)] + [("b", rnd.gauss(0.3, 1)) for _ in range(50)]
    r = stats.ttest(spark.createDataFrame(rows, "g STRING, v DOUBLE"), "g", "a", "b", "v")
    assert r["equal_var"] is True and r["dof"] == 98.0


def test_exact_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x DOUBLE")
    assert nulls.exact_median(df, "x") == 3.0
    big = spark.range(0, 300_001).selectExpr("cast((id * 7919) % 300001 as double) x")
    assert nulls.exact_median(big, "x") == 150_000.0


def test_impute_cancelled_then_median(spark):
    df = spark.createDataFrame([(1, None), (0, None), (0, 1.0), (0, 5.0)], "cancelled INT, d DOUBLE")
    got = [r["d"] for r in nulls.impute_cancelled_then_median(df, ["d"], "cancelled").collect()]
    assert got == [-1.0, 1.0, 1.0, 5.0]      # median of (-1, 1, 5) after the -1 fill


def test_histogram_upper_edge_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 10)], "v DOUBLE")
    h = {r["bin"]: r["count"] for r in profiling.histogram(df, "v", 5).collect()}
    assert h == {0: 2, 1: 2, 4: 1}


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a DOUBLE, b DOUBLE")
    c = {(r["col_a"], r["col_b"]): r["corr"] for r in stats.correlation_pairs(df, ["a", "b"]).collect()}
    assert c[("a", "b")] == pytest.approx(1.0) and c[("b", "a")] == pytest.approx(1.0)


def test_proportion_interval(spark):
    df = spark.createDataFrame([(50.0, 100), (40.0, 100)], "share DOUBLE, n LONG")
    r = stats.weighted_proportion(df, "share", "n").first()
    assert r["p_hat"] == pytest.approx(0.45)
    se = math.sqrt(0.45 * 0.55 / 200)
    assert r["lower"] == pytest.approx(0.45 - 1.96 * se)


def test_exact_quantiles_hot_group_and_ties(spark):
    import pandas as pd
    from tessera.operators.quantiles import exact_quantiles
    rnd = random.Random(11)
    rows = [(0 if rnd.random() < 0.5 else rnd.randint(1, 4), float(rnd.choice([rnd.gauss(0, 1), rnd.randint(0, 3)])))
            for _ in range(5000)] + [(9, 5.0)] * 7 + [(8, 1.0)]
    df = spark.createDataFrame(rows, "g INT, v DOUBLE")
    got = {r["g"]: (r["q25"], r["q50"], r["q75"]) for r in
           exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"], partitions=40).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, s in pdf.groupby("g")["v"]:
        assert np.allclose(got[g], np.quantile(s.values, [0.25, 0.5, 0.75]))


def test_exact_quantiles_global_many_ranges(spark):
    from tessera.operators.quantiles import exact_quantiles
    rnd = random.Random(4)
    vals = [rnd.expovariate(1.0) for _ in range(3000)] + [2.0] * 50
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v DOUBLE")
    got = exact_quantiles(df, "v", [0.1, 0.5, 0.99], partitions=16).first()
    assert np.allclose([got["q10"], got["q50"], got["q99"]], np.quantile(vals, [0.1, 0.5, 0.99]))


def test_exact_quantiles_defined_cases(spark):
    """No rows, NULL keys, clashing keys in two columns, infinite values, one hot value over many ranges."""
    from tessera.operators.quantiles import exact_quantiles
    none = spark.createDataFrame([], "g INT, v DOUBLE")
    assert exact_quantiles(none, "v", [0.5], ["g"]).collect() == []
    assert exact_quantiles(none, "v", [0.25, 0.5]).first().asDict() == {"q25": None, "q50": None}
    inf = float("inf")
    rows = [("a", 1, 2.0)] * 3000 + [("a", 1, float(i)) for i in range(100)] + [("a", 2, -inf), ("a", 2, -inf), (None, 1, 9.0)]
    rows += [("b", 1, -0.0), ("b", 1, 0.0), ("b", 1, 4.0), ("b", 2, None)]
    df = spark.createDataFrame(rows, "g STRING, v INT, x DOUBLE")
    got = {(r["g"], r["v"]): (r["q12_5"], r["q50"], r["q99"]) for r in
           exact_quantiles(df, "x", [0.125, 0.5, 0.99], ["g", "v"], partitions=30).collect()}
    a1 = [r[2] for r in rows if r[:2] == ("a", 1)]
    assert set(got) == {("a", 1), ("a", 2), ("b", 1)}
    assert np.allclose(got["a", 1], np.quantile(a1, [0.125, 0.5, 0.99]))
    assert got["a", 2] == (-inf, -inf, -inf)
    assert np.allclose(got["b", 1], np.quantile([0.0, 0.0, 4.0], [0.125, 0.5, 0.99]))


def test_exact_quantiles_run_no_loop_of_passes(spark):
    """The jobs do not depend on how the values are spread."""
    from tessera.operators.quantiles import exact_quantiles
    sc = spark.sparkContext

    def jobs(values, tag):
        df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g INT, v DOUBLE")
        sc.setJobGroup(tag, tag)
        exact_quantiles(df, "v", [0.5], ["g"]).collect()
        n = len(sc.statusTracker().getJobIdsForGroup(tag))
        sc.setJobGroup("", "")
        return n

    even = jobs([float(i) for i in range(6000)], "even")
    assert 0 < jobs([1.5 ** (i % 1200) for i in range(6000)], "spread") <= even + 1
