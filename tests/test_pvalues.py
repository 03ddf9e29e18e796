import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import distributions as d
from tessera.functions import pvalues as pv
from tessera.functions import scalars as sc
from tessera.operators import stats as st


def test_tails_match_the_driver_functions(spark):
    ts = [(t, df) for t in (-40.0, -2.5, -0.1, 0.0, 1e-9, 0.3, 1.96, 6.0, 50.0) for df in (1.0, 2.5, 7.0, 30.0, 999.0, 5e5)]
    got = spark.createDataFrame(ts, "t double, df double").select("t", "df", pv.t_sf(F.col("t"), F.col("df")).alias("p")).collect()
    assert all(r.p == pytest.approx(d.t_sf(r.t, r.df), rel=1e-7, abs=1e-12) for r in got)
    fs = [(f, a, b) for f in (-1.0, 0.0, 0.2, 1.0, 3.5, 80.0) for a in (1.0, 4.0, 60.0) for b in (2.0, 11.0, 2e5)]
    got = spark.createDataFrame(fs, "f double, a double, b double").select("*", pv.f_sf(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect()
    assert all(r.p == pytest.approx(d.f_sf(r.f, r.a, r.b), rel=1e-7, abs=1e-12) for r in got)
    zs = [(z / 10,) for z in range(-80, 81)] + [(2.0,), (37.0,)]
    got = spark.createDataFrame(zs, "z double").select("z", pv.norm_sf(F.col("z")).alias("p")).collect()
    assert all(r.p == pytest.approx(d.norm_sf(r.z), rel=1e-9, abs=1e-14) for r in got)


def test_ln_gamma(spark):
    xs = [(x,) for x in (0.01, 0.5, 1.0, 2.0, 3.7, 30.0, 1e4, 1e8)]
    got = spark.createDataFrame(xs, "x double").select("x", pv.ln_gamma(F.col("x")).alias("g")).collect()
    assert all(r.g == pytest.approx(math.lgamma(r.x), rel=1e-11, abs=1e-11) for r in got)


def test_null_arguments_give_null(spark):
    r = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, 1.0D AS y").select(pv.t_sf(F.col("x"), F.col("y")).alias("t"), pv.norm_sf(F.col("x")).alias("z")).first()
    assert r.t is None and r.z is None


def test_tests_by_key_match_single_tests(spark):
    rows = [(k, g, float((i * 7919 + k * 31 + (g == "a") * 13 * k) % 101)) for k in range(4) for g in "ab" for i in range(25 + k)]
    rows += [(9, "a", 1.0), (9, "b", 2.0), (10, "a", 1.0), (10, "a", 1.0), (10, "b", 1.0), (10, "b", 1.0), (0, "a", None), (0, "b", float("nan")), (0, "c", 5.0)]
    df = spark.createDataFrame(rows, "k int, g string, v double")
    for equal in (True, False):
        got = {r["k"]: r for r in st.ttest_by(df, ["k"], "g", "a", "b", "v", equal_var=equal).collect()}
        assert got.keys() == {0, 1, 2, 3}  # too few values, no variance: no row
        for k in range(4):
            want = st.ttest(df.where(F.col("k") == k), "g", "a", "b", "v", equal_var=equal)
            for c in ("n_a", "n_b", "t", "dof", "p_two_sided", "p_greater", "p_less"):
                assert got[k][c] == pytest.approx(want[c], rel=1e-8)


def test_no_row_reaches_the_driver(spark):
    df = spark.range(1000).selectExpr("id % 50 AS k", "IF(id % 3 = 0, 'a', 'b') AS g", "CAST(id % 17 AS DOUBLE) AS v")
    assert st.ttest_by(df, ["k"], "g", "a", "b", "v").where("p_two_sided BETWEEN 0 AND 1").count() == 50


def test_softmax_of_long_arrays_is_linear(spark):
    df = spark.range(2000, numPartitions=4).select(F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: (i * F.col("id") % 97).cast("double")).alias("v"))
    r = df.select(sc.softmax("v").alias("p")).select(F.aggregate("p", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert r[0] == pytest.approx(1) and r[1] == pytest.approx(1)
