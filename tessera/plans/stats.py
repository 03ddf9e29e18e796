"""Statistics and table-profile queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions import scalars as sc
from tessera.operators import profiling as pf
from tessera.operators import evaluation as ev
from tessera.operators import stats as st
from tessera.plans.registry import query
from tessera.plans.views import flights, with_flights
from tessera.sources.tables import TABLES, load_table, register_tables


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def _rall(df, d=6, skip=()):
    return df.select(*[F.round(F.col(c), d).alias(c) if t in ("double", "float") and c not in skip else F.col(c)
                       for c, t in df.dtypes])


def _polls(spark, sf):
    """Each nation acts as a pollster: share (%) of its customers with a positive balance."""
    c = load_table(spark, sf, "customer")
    return c.groupBy("c_nationkey").agg((F.avg((F.col("c_acctbal") > 0).cast("double")) * 100).alias("share_pct"),
                                        F.count(F.lit(1)).alias("n_obs"))


_POLLS_SQL = """WITH polls AS (SELECT c_nationkey, avg(CAST(c_acctbal > 0 AS DOUBLE)) * 100 AS share_pct,
                          count(*) AS n_obs FROM customer GROUP BY 1)"""


@query("stt2_weighted_proportion_interval", covers="STT2 AGG18", sql=_POLLS_SQL + """,
g AS (SELECT sum(share_pct / 100 * n_obs) AS weighted, CAST(sum(n_obs) AS BIGINT) AS n_total FROM polls)
SELECT round(weighted, 6) AS weighted, n_total, round(weighted / n_total, 6) AS p_hat,
       round(sqrt((weighted / n_total) * (1 - weighted / n_total) / n_total), 6) AS se,
       round(weighted / n_total - 1.96 * sqrt((weighted / n_total) * (1 - weighted / n_total) / n_total), 6) AS lower,
       round(weighted / n_total + 1.96 * sqrt((weighted / n_total) * (1 - weighted / n_total) / n_total), 6) AS upper
FROM g""")
def stt2(spark, sf):
    return _rall(st.weighted_proportion(_polls(spark, sf), "share_pct", "n_obs"))


@query("stt3_interval_coverage", covers="STT3", sql="""
WITH p AS (SELECT avg(CAST(c_acctbal > 0 AS DOUBLE)) AS p_true FROM customer),
s AS (SELECT c_custkey // 30 AS sample_id, avg(CAST(c_acctbal > 0 AS DOUBLE)) AS p_hat, count(*) AS n
      FROM customer GROUP BY 1)
SELECT round(avg(CAST(p_true BETWEEN p_hat - 1.96 * sqrt(p_hat * (1 - p_hat) / n)
                                 AND p_hat + 1.96 * sqrt(p_hat * (1 - p_hat) / n) AS DOUBLE)), 6) AS coverage,
       count(*) AS n_samples
FROM s, p""")
def stt3(spark, sf):
    c = load_table(spark, sf, "customer").withColumn("pos", (F.col("c_acctbal") > 0).cast("double"))
    p_true = c.agg(F.avg("pos")).first()[0]
    x = st.interval_coverage(c.withColumn("sample_id", F.floor(F.col("c_custkey") / 30)), "sample_id", "pos", p_true)
    return x.select(_r("coverage"), "n_samples")


@query("stt4_spread_z_test", covers="STT4")
def stt4(spark, sf):
    c = load_table(spark, sf, "customer")
    row = c.agg(F.avg((F.col("c_acctbal") > 0).cast("double")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    r = st.spread_test(row["p"], row["n"])
    return spark.createDataFrame([tuple(r.values())], ", ".join(f"{k} DOUBLE" for k in r))


_TT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("stt7_ttest_returnflag", covers="STT6 STT7 SCA23")
def stt7(spark, sf):
    li = load_table(spark, sf, "lineitem")
    return st.ttest_table(spark, li, "l_returnflag", "R", "N", _TT_COLS)


@query("stt4_spread_statistic", covers="STT4", sql="""
WITH t AS (SELECT avg(CAST(c_acctbal > 0 AS DOUBLE)) AS p, count(*) AS n FROM customer),
s AS (SELECT 2 * p - 1 AS spread, 2 * sqrt(p * (1 - p) / n) AS se FROM t)
SELECT round(spread, 9) AS spread, round(se, 9) AS se, round(spread - 1.96 * se, 6) AS lower, round(spread + 1.96 * se, 6) AS upper,
       round(spread / se, 6) AS z FROM s""")
def stt4s(spark, sf):
    row = load_table(spark, sf, "customer").agg(F.avg((F.col("c_acctbal") > 0).cast("double")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    r = st.spread_test(row["p"], row["n"], z=1.96)
    out = spark.createDataFrame([tuple(r.values())], ", ".join(f"{k} DOUBLE" for k in r))
    return out.select(_r("spread", 9), _r("se", 9), _r("lower"), _r("upper"), _r("z"))


def _tt_sql(col: str) -> str:
    return f"""
SELECT '{col}' AS metric, f.equal_var, a.n AS n_a, b.n AS n_b, round(a.w, 4) AS levene_w,
       round((a.mean - b.mean) / CASE WHEN f.equal_var THEN sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n))
                                      ELSE sqrt(a.var / a.n + b.var / b.n) END, 4) AS t,
       round(CASE WHEN f.equal_var THEN a.n + b.n - 2
             ELSE pow(a.var / a.n + b.var / b.n, 2) / (pow(a.var / a.n, 2) / (a.n - 1) + pow(b.var / b.n, 2) / (b.n - 1)) END, 3) AS dof
FROM (SELECT *, (sum(n) OVER () - 2) * sum(n * pow(zbar - zall, 2)) OVER () / sum(n * zvar) OVER () AS w FROM (
        SELECT *, sum(n * zbar) OVER () / sum(n) OVER () AS zall FROM (
          SELECT g, count(*) AS n, avg(x) AS mean, var_samp(x) AS var, avg(abs(x - med)) AS zbar, var_pop(abs(x - med)) AS zvar
          FROM (SELECT l_returnflag AS g, CAST({col} AS DOUBLE) AS x,
                       quantile_cont(CAST({col} AS DOUBLE), 0.5) OVER (PARTITION BY l_returnflag) AS med
                FROM lineitem WHERE l_returnflag IN ('R', 'N')) GROUP BY g))) a,
     (SELECT count(*) AS n, avg({col}) AS mean, var_samp({col}) AS var FROM lineitem WHERE l_returnflag = 'N') b,
     (SELECT unnest([TRUE, FALSE]) AS equal_var) f WHERE a.g = 'R'"""


@query("stt7_ttest_statistics", covers="STT6 STT7", sql="\nUNION ALL ".join(_tt_sql(c) for c in _TT_COLS))
def stt7s(spark, sf):
    li = load_table(spark, sf, "lineitem")
    both = st.ttest_table(spark, li, "l_returnflag", "R", "N", _TT_COLS, equal_var=(True, False))
    return both.select("metric", "equal_var", "n_a", "n_b", _r("levene_w", 4), _r("t", 4), _r("dof", 3))


@query("sca27_softmax_argmax", covers="SCA27", sql="""
WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
e AS (SELECT vec_id, v, list_transform(v, lambda a: exp(a - list_max(v))) AS ex FROM x)
SELECT vec_id, round(list_max(ex) / list_sum(ex), 6) AS top_share, round(list_min(ex) / list_sum(ex), 6) AS low_share,
       CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS top FROM e""")
def sca27(spark, sf):
    e = load_table(spark, sf, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    probs, top = sc.softmax("v"), sc.argmax("v")
    return e.select("vec_id", F.round(F.array_max(probs), 6).alias("top_share"), F.round(F.array_min(probs), 6).alias("low_share"),
                    top.alias("top"))


@query("stt7_group_moments", covers="STT7 AGG21", sql="""
WITH m AS (SELECT l_returnflag AS grp, count(*) AS n, avg(l_quantity) AS mean, var_samp(l_quantity) AS var
           FROM lineitem WHERE l_returnflag IN ('R', 'N') GROUP BY 1),
a AS (SELECT * FROM m WHERE grp = 'R'), b AS (SELECT * FROM m WHERE grp = 'N')
SELECT a.n AS n_a, b.n AS n_b, round(a.mean, 6) AS mean_a, round(b.mean, 6) AS mean_b,
       round((a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n), 6) AS t_welch,
       round((a.mean - b.mean) / sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)), 6)
         AS t_pooled
FROM a, b""")
def stt7m(spark, sf):
    li = load_table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("R", "N"))
    g = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean"),
                                       F.var_samp("l_quantity").alias("var"))
    wide = g.groupBy().pivot("l_returnflag", ["R", "N"]).agg(F.first("n").alias("n"), F.first("mean").alias("mean"),
                                                            F.first("var").alias("var"))
    a_n, b_n, a_m, b_m, a_v, b_v = (F.col("R_n"), F.col("N_n"), F.col("R_mean"), F.col("N_mean"),
                                    F.col("R_var"), F.col("N_var"))
    welch = (a_m - b_m) / F.sqrt(a_v / a_n + b_v / b_n)
    pooled = (a_m - b_m) / F.sqrt(((a_n - 1) * a_v + (b_n - 1) * b_v) / (a_n + b_n - 2) * (F.lit(1.0) / a_n + F.lit(1.0) / b_n))
    return wide.select(a_n.alias("n_a"), b_n.alias("n_b"), F.round(a_m, 6).alias("mean_a"),
                       F.round(b_m, 6).alias("mean_b"), F.round(welch, 6).alias("t_welch"),
                       F.round(pooled, 6).alias("t_pooled"))


@query("stt8_correlation_matrix", covers="STT8 STT10", sql="""
WITH c AS (SELECT """ + ", ".join(f"corr({a}, {b}) AS \"{a}|{b}\"" for i, a in enumerate(_TT_COLS)
                                   for b in _TT_COLS[i:]) + """ FROM lineitem)
SELECT col_a, col_b, round(corr, 6) AS corr FROM (
""" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, \"{a}|{b}\" AS corr FROM c" +
    (f" UNION ALL SELECT '{b}', '{a}', \"{a}|{b}\" FROM c" if a != b else "")
    for i, a in enumerate(_TT_COLS) for b in _TT_COLS[i:]) + ")")
def stt8(spark, sf):
    li = load_table(spark, sf, "lineitem")
    return st.correlation_pairs(li, _TT_COLS).select("col_a", "col_b", _r("corr"))


_FR = ["l_quantity", "l_discount", "l_tax"]


@query("stt9_f_regression", covers="STT9", sql="""
SELECT feature, n, round(r, 6) AS r, round(r * r / (1 - r * r) * (n - 2), 4) AS f_stat FROM (
""" + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS n, corr({c}, l_extendedprice) AS r FROM lineitem"
                          for c in _FR) + ")")
def stt9(spark, sf):
    fr = st.f_regression(load_table(spark, sf, "lineitem"), _FR, "l_extendedprice")
    return fr.select("feature", "n", _r("r"), _r("f_stat", 4))


def _steps_sql(first: str, depth: int) -> str:
    return f"list_prepend(CAST({first} AS DOUBLE), list_transform(range({depth}), lambda i: CAST({depth} - i AS DOUBLE)))"


#: Regularised incomplete beta of columns a, b, x of a table ``args`` (rows named by ``key``), as its continued fraction.
def _beta_sql(keys: str) -> str:
    return f"""
side AS (SELECT {keys}, x < (a + 1) / (a + b + 2) AS near, a AS a0, b AS b0, x AS x0 FROM args),
arg AS (SELECT {keys}, near, CASE WHEN near THEN a0 ELSE b0 END AS a, CASE WHEN near THEN b0 ELSE a0 END AS b,
               CASE WHEN near THEN x0 ELSE 1 - x0 END AS x FROM side),
frac AS (SELECT *, list_reduce({_steps_sql('1', 2500)}, lambda t, m:
           1 + m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) / (1 - (a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)) / t)) AS rest FROM arg),
val AS (SELECT {keys}, near, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) / (1 - (a + b) * x / (a + 1) / rest) / a AS v FROM frac),
beta AS (SELECT {keys}, CASE WHEN near THEN v ELSE 1 - v END AS i FROM val)"""


@query("stt9_f_regression_pvalues", covers="STT9", sql="""
WITH f AS (SELECT feature, n, r * r / (1 - r * r) * (n - 2) AS f_stat FROM (
""" + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS n, corr({c}, l_extendedprice) AS r FROM lineitem" for c in _FR) + f""")),
args AS (SELECT feature, (n - 2) / 2.0 AS a, 0.5 AS b, (n - 2) / (n - 2 + f_stat) AS x FROM f), {_beta_sql('feature')}
SELECT feature, round(f_stat, 4) AS f_stat, round(i, 6) AS p_value FROM f JOIN beta USING (feature)""")
def stt9p(spark, sf):
    p = st.f_regression_pvalues(st.f_regression(load_table(spark, sf, "lineitem"), _FR, "l_extendedprice"))
    return p.select("feature", _r("f_stat", 4), _r("p_value"))


@query("stt7_ttest_by_supplier", covers="STT7 UDF2", sql=f"""
WITH g AS (SELECT l_suppkey, l_returnflag AS g, count(l_quantity) AS n, avg(CAST(l_quantity AS DOUBLE)) AS mean, var_samp(CAST(l_quantity AS DOUBLE)) AS var
           FROM lineitem WHERE l_returnflag IN ('R', 'N') GROUP BY 1, 2),
t AS (SELECT a.l_suppkey, a.n AS n_a, b.n AS n_b, (a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n) AS t,
             pow(a.var / a.n + b.var / b.n, 2) / (pow(a.var / a.n, 2) / (a.n - 1) + pow(b.var / b.n, 2) / (b.n - 1)) AS dof
      FROM g a JOIN g b ON a.l_suppkey = b.l_suppkey AND a.g = 'R' AND b.g = 'N' WHERE a.n > 1 AND b.n > 1 AND a.var + b.var > 0),
args AS (SELECT l_suppkey, dof / 2 AS a, 0.5 AS b, dof / (dof + t * t) AS x FROM t WHERE t <> 0), {_beta_sql('l_suppkey')}
SELECT l_suppkey, n_a, n_b, round(t, 6) AS t, round(dof, 4) AS dof, round(coalesce(i, 1), 6) AS p_two_sided,
       round(CASE WHEN t >= 0 THEN coalesce(i, 1) / 2 ELSE 1 - i / 2 END, 6) AS p_greater FROM t LEFT JOIN beta USING (l_suppkey)""")
def stt7_by(spark, sf):
    p = st.ttest_by(load_table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", "R", "N", "l_quantity")
    return p.select("l_suppkey", "n_a", "n_b", _r("t"), _r("dof", 4), _r("p_two_sided"), _r("p_greater"))


@query("stt4_spread_p_by_segment", covers="STT4", sql=f"""
WITH t AS (SELECT c_mktsegment, avg(CAST(c_acctbal > 4500 AS DOUBLE)) AS p, count(*) AS n FROM customer GROUP BY 1),
z AS (SELECT c_mktsegment, (2 * p - 1) / (2 * sqrt(p * (1 - p) / n)) AS z FROM t WHERE p > 0 AND p < 1),
d AS (SELECT *, abs(z) AS x, exp(-z * z / 2) / sqrt(2 * pi()) AS density FROM z),
q AS (SELECT c_mktsegment, z, CASE WHEN x > 2 THEN density / list_reduce({_steps_sql('x', 120)}, lambda r, m: x + m / r)
             ELSE 0.5 - density * x * list_reduce({_steps_sql('1', 120)}, lambda r, m: 1 + r * x * x / (2 * m + 1)) END AS tail FROM d)
SELECT c_mktsegment, round(z, 6) AS z, round(2 * tail, 6) AS p_value FROM q""")
def stt4_by(spark, sf):
    p = F.col("p")
    share = load_table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.avg((F.col("c_acctbal") > 4500).cast("double")).alias("p"), F.count(F.lit(1)).alias("n"))
    z = share.where((p > 0) & (p < 1)).withColumn("z", (2 * p - 1) / (2 * F.sqrt(p * (1 - p) / F.col("n"))))
    return z.select("c_mktsegment", _r("z"), F.round(st.spread_p_value(F.col("z")), 6).alias("p_value"))


@query("eva7_best_run", covers="EVA7 SRT7", sql="""
WITH r AS (SELECT c_mktsegment AS model, sqrt(avg(pow(c_acctbal - m, 2))) AS score FROM (
             SELECT c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal, avg(CAST(c_acctbal AS DOUBLE)) OVER (PARTITION BY c_mktsegment) AS m FROM customer) GROUP BY 1)
SELECT arg_min(model, score) AS best_model, round(min(score), 6) AS best_score FROM r""")
def eva7(spark, sf):
    """Of one mean predictor a segment, the run with the least error."""
    c = load_table(spark, sf, "customer").withColumn("y", F.col("c_acctbal").cast("double"))
    runs = c.groupBy(F.col("c_mktsegment").alias("model")).agg(F.sqrt(F.var_pop("y")).alias("score"))
    return ev.best_run(runs, maximize=False).select("best_model", _r("best_score"))


@query("sca29_gaussian_density_score", covers="SCA29", sql="""
WITH m AS (SELECT avg(l_discount) AS mx, avg(l_tax) AS my, var_samp(l_discount) AS sxx, var_samp(l_tax) AS syy,
                  covar_samp(l_discount, l_tax) AS sxy FROM lineitem),
i AS (SELECT *, sxx * syy - sxy * sxy AS det FROM m),
q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount - mx AS dx, l_tax - my AS dy, syy / det AS ixx,
             -sxy / det AS ixy, sxx / det AS iyy, det FROM lineitem, i)
SELECT l_orderkey, l_linenumber, l_partkey,
       round(exp(-0.5 * (dx * dx * ixx + 2 * dx * dy * ixy + dy * dy * iyy)) / (2 * pi() * sqrt(det)), 4) AS density,
       round(-(dx * ixx + dy * ixy), 4) AS score_x, round(-(dx * ixy + dy * iyy), 4) AS score_y
FROM q""")
def sca29(spark, sf):
    li = load_table(spark, sf, "lineitem")
    m = li.agg(F.avg("l_discount").alias("mx"), F.avg("l_tax").alias("my"), F.var_samp("l_discount").alias("sxx"),
               F.var_samp("l_tax").alias("syy"), F.covar_samp("l_discount", "l_tax").alias("sxy")).first()
    x = st.gaussian_density_and_score(li, "l_discount", "l_tax", (m["mx"], m["my"]),
                                      ((m["sxx"], m["sxy"]), (m["sxy"], m["syy"])))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", _r("density", 4), _r("score_x", 4), _r("score_y", 4))


@query("stt1_sample_mean_se", covers="STT1", sql="""
SELECT count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value) / sqrt(count(*)), 6) AS se FROM events""")
def stt1(spark, sf):
    e = load_table(spark, sf, "events")
    return e.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"),
                 F.round(F.stddev_samp("value") / F.sqrt(F.count(F.lit(1))), 6).alias("se"))


@query("agg37_value_histogram", covers="AGG37 STT1 TXT5", sql="""
WITH mm AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n FROM events),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 20)), 19) END AS INTEGER) AS bin,
             lo, hi, n FROM events, mm)
SELECT bin, round(lo + bin * (hi - lo) / 20, 6) AS bin_low, round(lo + (bin + 1) * (hi - lo) / 20, 6) AS bin_high,
       count(*) AS count, round(count(*) / (n * (hi - lo) / 20), 6) AS density
FROM b GROUP BY bin, lo, hi, n""")
def agg37(spark, sf):
    h = pf.histogram(load_table(spark, sf, "events"), "value", 20)
    return h.select("bin", _r("bin_low"), _r("bin_high"), "count", _r("density"))


_DESC = ["l_quantity", "l_extendedprice", "l_discount"]


@query("agg20_describe", covers="AGG20 AGG33", sql="\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
       round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
       round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem""" for c in _DESC))
def agg20(spark, sf):
    return _rall(pf.describe(load_table(spark, sf, "lineitem"), _DESC))


@query("agg21_group_summary", covers="AGG21 AGG22", sql="\nUNION ALL ".join(f"""
SELECT l_returnflag, '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       count({c}) AS count, round(median({c}), 6) AS median FROM lineitem GROUP BY l_returnflag""" for c in _DESC[:2]))
def agg21(spark, sf):
    return _rall(pf.group_summary(load_table(spark, sf, "lineitem"), "l_returnflag", _DESC[:2]))


@query("agg22_user_rating_stats", covers="AGG22", sql="""
SELECT o_custkey AS user_id, round(avg(l_quantity / 10), 9) AS mean,
       round(stddev_samp(l_quantity / 10), 9) AS std, count(*) AS count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def agg22(spark, sf):
    li, o = load_table(spark, sf, "lineitem"), load_table(spark, sf, "orders")
    r = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("user_id"),
                                                         (F.col("l_quantity") / 10).alias("rating"))
    # means of q/10 terminate in decimal: 9 digits avoid 6-digit ties (same in the SQL twin)
    return r.groupBy("user_id").agg(F.round(F.avg("rating"), 9).alias("mean"),
                                    F.round(F.stddev_samp("rating"), 9).alias("std"),
                                    F.count(F.lit(1)).alias("count"))


@query("agg23_group_size_histogram", covers="AGG23 AGG37", sql="""
WITH s AS (SELECT o_custkey, count(*) AS size FROM orders GROUP BY 1),
mm AS (SELECT min(size) AS lo, max(size) AS hi, count(*) AS n FROM s)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((size - lo) / ((hi - lo) / 10)), 9) END AS INTEGER) AS bin,
       count(*) AS count FROM s, mm GROUP BY 1""")
def agg23(spark, sf):
    sizes = load_table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("size"))
    return pf.histogram(sizes, "size", 10).select("bin", "count")


@query("agg25_null_counts_top10", covers="AGG25", sql=with_flights("""
SELECT "column", n_null FROM (""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM flights"
    for c in ["flight_id", "a_year", "a_month", "a_day", "airline", "origin_airport", "destination_airport",
              "scheduled_departure", "arrival_delay", "air_time", "cancelled", "cancellation_reason",
              "l_extendedprice", "l_discount", "l_quantity", "l_partkey"]) + """)
ORDER BY n_null DESC, "column" LIMIT 10"""))
def agg25(spark, sf):
    return pf.null_counts(flights(spark, sf), top=10)


@query("agg26_empty_text_rate", covers="AGG26", sql="""
SELECT 'role' AS "column", round(avg(CAST(trim(coalesce(role, '')) = '' AS DOUBLE)), 6) AS empty_rate FROM conversations
UNION ALL SELECT 'text', round(avg(CAST(trim(coalesce(text, '')) = '' AS DOUBLE)), 6) FROM conversations""")
def agg26(spark, sf):
    return _rall(pf.empty_text_rate(load_table(spark, sf, "conversations"), ["role", "text"]))


@query("agg27_distinct_counts", covers="AGG27", sql="\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM part"
    for c in ["p_brand", "p_type", "p_size", "p_name"]))
def agg27(spark, sf):
    return pf.distinct_counts(load_table(spark, sf, "part"), ["p_brand", "p_type", "p_size", "p_name"])


@query("agg28_outcome_rates", covers="AGG28 AGG24", sql="""
SELECT o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS rate FROM orders GROUP BY 1""")
def agg28(spark, sf):
    return pf.outcome_rates(load_table(spark, sf, "orders"), "o_orderstatus").select("o_orderstatus", "n", _r("rate"))


@query("agg29_text_length_stats", covers="AGG29 SCA25 TXT5", sql="""
WITH x AS (SELECT lang, CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '\\s+')) END AS n_words,
                  length(text) AS n_chars FROM documents)
SELECT lang, round(avg(n_words), 6) AS mean_words, round(median(n_words), 6) AS median_words,
       round(avg(n_chars), 6) AS mean_chars, round(median(n_chars), 6) AS median_chars FROM x GROUP BY lang""")
def agg29(spark, sf):
    return _rall(pf.length_stats(load_table(spark, sf, "documents"), "text", "lang"))


@query("agg31_dedupe_first_per_text", covers="AGG31", sql="""
SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY text""")
def agg31(spark, sf):
    # exact copies share a SHA-256 of the text: a 32-byte shuffle key instead of the text
    d = load_table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_key"))
    first = pf.first_per_key(d, ["text_key"], "doc_id", count_col="n_copies")
    return first.select("doc_id", "n_copies")


@query("agg34_box_stats", covers="AGG34", sql="""
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
j AS (SELECT l.l_returnflag, l_extendedprice AS v, q1, median, q3, q3 - q1 AS iqr FROM lineitem l JOIN q USING (l_returnflag))
SELECT l_returnflag, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(iqr, 4) AS iqr,
       min(CASE WHEN v BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr THEN v END) AS whisker_low,
       max(CASE WHEN v BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr THEN v END) AS whisker_high,
       count(CASE WHEN NOT (v BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr) THEN 1 END) AS n_outliers
FROM j GROUP BY 1, 2, 3, 4, 5""")
def agg34(spark, sf):
    b = pf.box_stats(load_table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return b.select("l_returnflag", _r("q1", 4), _r("median", 4), _r("q3", 4), _r("iqr", 4), "whisker_low",
                    "whisker_high", "n_outliers")


@query("agg35_listing_kpis", covers="AGG35", sql="""
SELECT p_type, count(*) AS n_listings, round(avg(p_retailprice), 6) AS avg_price, count(DISTINCT p_brand) AS n_hosts
FROM part GROUP BY 1""")
def agg35(spark, sf):
    p = load_table(spark, sf, "part")
    return p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_listings"),
                                   F.round(F.avg("p_retailprice"), 6).alias("avg_price"),
                                   F.countDistinct("p_brand").alias("n_hosts"))


@query("agg36_category_table_sizes", covers="AGG36", sql=with_flights("""
SELECT 'airline' AS "column", CAST(max(airline) + 1 AS BIGINT) AS n_levels,
       CAST(least(50, floor((max(airline) + 1) / 2) + 1) AS BIGINT) AS embed_dim FROM flights
UNION ALL SELECT 'origin_airport', CAST(max(origin_airport) + 1 AS BIGINT),
       CAST(least(50, floor((max(origin_airport) + 1) / 2) + 1) AS BIGINT) FROM flights"""))
def agg36(spark, sf):
    return pf.category_table_sizes(flights(spark, sf), ["airline", "origin_airport"])


@query("src12_catalog_listing", covers="SRC12 SRC8", sql="\nUNION ALL ".join(f"""
SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, column_name, CAST(ordinal_position - 1 AS INTEGER) AS position
FROM information_schema.columns WHERE table_name = '{t}'""" for t in TABLES))
def src12(spark, sf):
    tag = f"src12_{uuid.uuid4().hex[:8]}_"
    register_tables(spark, sf, TABLES, tag)
    out = pf.list_tables(spark, [tag + t for t in TABLES])
    for t in TABLES:
        spark.catalog.dropTempView(tag + t)  # the plan holds the tables themselves
    return out.select(F.substring(F.col("table_name"), len(tag) + 1, 100).alias("table_name"), "n_rows", "column_name", "position")


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("src13_table_profile", covers="SRC13", sql="""
WITH t AS (SELECT column_name AS "column",
                  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                       WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS dtype
           FROM information_schema.columns WHERE table_name = 'lineitem'),
c AS (SELECT * FROM (SELECT count(*) AS n_rows, """ + ", ".join(f"count({c}) AS {c}" for c in _LI_COLS) + """ FROM lineitem)
      UNPIVOT (non_null FOR "column" IN (""" + ", ".join(_LI_COLS) + """)))
SELECT n_rows, t."column", dtype, non_null FROM c JOIN t USING ("column")""")
def src13(spark, sf):
    return pf.profile(load_table(spark, sf, "lineitem"))
