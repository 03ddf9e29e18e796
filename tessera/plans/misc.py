"""Scalar-feature, prompt-building, standings and distribution queries."""

from __future__ import annotations

import math

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import scalars as sc
from tessera.functions.distributions import norm_sf
from tessera.operators import features as fe
from tessera.functions import text as tx
from tessera.operators import joins, nulls, sampling
from tessera.operators import profiling as pf
from tessera.plans.registry import query
from tessera.plans.sqlhash import h_sql
from tessera.plans.views import flights, with_flights
from tessera.sources.tables import load_table


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def _raw_parts(spark, sf):
    """Text columns shaped like the reference's clinical sheet, derived from ``part``."""
    p = load_table(spark, sf, "part")
    stage = F.element_at(F.array(*[F.lit(s) for s in ("0", "i", "II", " iii", "IV", "v", "VI")]),
                         (F.pmod(F.col("p_size"), F.lit(7)) + 1).cast("int"))
    return p.select(
        "p_partkey", "p_size", "p_retailprice",
        F.concat((F.col("p_size") + 150).cast("string"), F.lit("cm")).alias("height_text"),
        stage.alias("stage_text"),
        F.when(F.col("p_retailprice") > 1500, "Yes").otherwise("no ").alias("family_text"),
        F.when(F.pmod(F.col("p_size"), F.lit(5)) != 0, F.regexp_replace("p_name", " ", "+")).alias("drugs_text"),
        F.regexp_extract("p_brand", "#(.*)$", 1).alias("brand_code"))


@query("sca_clinical_style_features", covers="SCA12 SCA15 SCA17 SCA18 SCA20 SCA21 SCA22 SCA23 PRJ6 PRJ7 PRJ8 FLT3", sql="""
WITH r AS (SELECT p_partkey, p_size, p_retailprice, CAST(p_size + 150 AS VARCHAR) || 'cm' AS height_text,
                  ['0', 'i', 'II', ' iii', 'IV', 'v', 'VI'][p_size % 7 + 1] AS stage_text,
                  CASE WHEN p_retailprice > 1500 THEN 'Yes' ELSE 'no ' END AS family_text,
                  CASE WHEN p_size % 5 <> 0 THEN replace(p_name, ' ', '+') END AS drugs_text,
                  regexp_extract(p_brand, '#(.*)$', 1) AS brand_code FROM part),
f AS (SELECT p_partkey, TRY_CAST(replace(height_text, 'cm', '') AS DOUBLE) AS height_cm,
             CASE upper(trim(stage_text)) WHEN '0' THEN 0 WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3
                  WHEN 'IV' THEN 4 WHEN 'V' THEN 5 END AS stage,
             CASE lower(trim(family_text)) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 WHEN 'y' THEN 1 WHEN 'n' THEN 0 END AS family_history,
             CASE WHEN drugs_text IS NULL THEN 0 ELSE len(string_split(drugs_text, '+')) END AS n_drugs,
             coalesce(CAST(TRY_CAST(brand_code AS DOUBLE) > 0 AS INTEGER), 0) AS brand_flag,
             CASE WHEN p_size >= 0 AND p_size <= 2 THEN 0 WHEN p_size > 2 AND p_size <= 5 THEN 1
                  WHEN p_size > 5 AND p_size <= 10 THEN 2 WHEN p_size > 10 AND p_size <= 50 THEN 3
                  WHEN p_size > 50 THEN 4 END AS size_bin,
             p_retailprice / 20 AS weight, least(greatest(p_retailprice, 1000.0), 1500.0) AS price_clipped,
             round_even(p_retailprice / 7, 2) AS price_per7
      FROM r WHERE p_retailprice IS NOT NULL AND p_size IS NOT NULL)
SELECT p_partkey AS part_id, height_cm, CAST(stage AS DOUBLE) AS stage, CAST(family_history AS INTEGER) AS family_history,
       CAST(n_drugs AS INTEGER) AS n_drugs, brand_flag, CAST(size_bin AS INTEGER) AS size_bin,
       round(weight / pow(height_cm / 100, 2), 6) AS bmi, price_clipped, round(price_per7, 2) AS price_per7
FROM f""")
def sca_feats(spark, sf):
    r = _raw_parts(spark, sf)
    r = nulls.drop_null_rows(r, ["p_retailprice", "p_size"])
    x = r.select(
        "p_partkey", sc.strip_unit("height_text", "cm").alias("height_cm"),
        sc.roman_to_int("stage_text").cast("double").alias("stage"),
        sc.yes_no_to_int("family_text").cast("int").alias("family_history"),
        sc.count_parts("drugs_text").cast("int").alias("n_drugs"),
        sc.positive_flag("brand_code").alias("brand_flag"),
        sc.right_closed_bin("p_size").cast("int").alias("size_bin"),
        (F.col("p_retailprice") / 20).alias("weight"),
        sc.clip("p_retailprice", 1000.0, 1500.0).alias("price_clipped"),
        sc.round_half_even(F.col("p_retailprice") / 7, 2).alias("price_per7"))
    x = x.withColumn("bmi", F.round(sc.bmi("weight", "height_cm"), 6))
    x = fe.drop_if_present(x, ["weight", "not_a_column"])
    return fe.rename_with_prefix(x, "", ["p_partkey"]).withColumnRenamed("p_partkey", "part_id")


_PROBE_COLS = ["height_text", "stage_text", "family_text", "drugs_text"]


@query("sca18_yes_no_column_probe", covers="SCA18 AGG27", sql="""
WITH r AS (SELECT CAST(p_size + 150 AS VARCHAR) || 'cm' AS height_text,
                  ['0', 'i', 'II', ' iii', 'IV', 'v', 'VI'][p_size % 7 + 1] AS stage_text,
                  CASE WHEN p_retailprice > 1500 THEN 'Yes' ELSE 'no ' END AS family_text,
                  CASE WHEN p_size % 5 <> 0 THEN replace(p_name, ' ', '+') END AS drugs_text FROM part),
p AS (SELECT """ + ", ".join(
    f"bool_and({c} IS NULL OR lower(trim({c})) IN ('yes', 'no', 'y', 'n')) AS {c}" for c in _PROBE_COLS) + """ FROM r)
SELECT yes_no_column FROM (UNPIVOT p ON """ + ", ".join(_PROBE_COLS) + """ INTO NAME yes_no_column VALUE flag)
WHERE flag""")
def sca18(spark, sf):
    r = _raw_parts(spark, sf)
    cols = sc.yes_no_columns(r, _PROBE_COLS)
    return spark.createDataFrame([(c,) for c in cols], "yes_no_column STRING")


@query("sca19_date_features", covers="SCA16 SCA19 SCA8 NUL4 FLT2", sql="""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS date_text,
                  CAST(DATE '1950-01-01' + CAST(o_custkey % 15000 AS INTEGER) AS DATE) AS birth_date,
                  CAST(o_orderdate AS DATE) AS od FROM orders)
SELECT o_orderkey, strftime(CAST(strptime(date_text, '%d-%m-%Y') AS DATE), '%Y-%m-%d') AS order_date,
       CAST(floor(datediff('day', birth_date, od) / 365) AS INTEGER) AS age_years,
       CAST(year(od) AS INTEGER) AS order_year, CAST(month(od) AS INTEGER) AS order_month,
       coalesce(NULL, -1) AS missing_code
FROM t""")
def sca19(spark, sf):
    o = load_table(spark, sf, "orders")
    t = o.select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy").alias("date_text"),
                 F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(F.col("o_custkey"), F.lit(15000)).cast("int"))
                  .alias("birth_date"), F.to_date("o_orderdate").alias("od"))
    x = t.select("o_orderkey", F.date_format(sc.lenient_date("date_text", "dd-MM-yyyy"), "yyyy-MM-dd").alias("order_date"),
                 sc.years_between("od", "birth_date").alias("age_years"), F.year("od").alias("order_year"),
                 F.month("od").alias("order_month"), F.lit(None).cast("int").alias("missing_code"))
    return nulls.fill_constants(x, {"missing_code": -1})


def _mc_items(spark, sf):
    """Multiple-choice items from conversations: every five turns are an item, the first its context,
    the others its options; a last item of fewer turns has empty options."""
    c = load_table(spark, sf, "conversations").select("conv_id", "text", F.floor(F.col("turn") / 5).cast("int").alias("item"),
                                                      F.pmod("turn", F.lit(5)).alias("turn"))
    wide = c.groupBy("conv_id", "item").pivot("turn", [0, 1, 2, 3, 4]).agg(F.first("text"))
    return wide.select("conv_id", "item", F.col("0").alias("context"),
                       F.array(*[F.coalesce(F.col(str(i)), F.lit("")) for i in (1, 2, 3, 4)]).alias("endings"),
                       F.pmod(F.col("conv_id"), F.lit(4)).cast("int").alias("label"))


@query("prj12_choice_rows", covers="PRJ12", sql="""
WITH c AS (SELECT conv_id, CAST(turn // 5 AS INTEGER) AS item, turn % 5 AS turn, text FROM conversations),
ids AS (SELECT DISTINCT conv_id, item FROM c),
g AS (SELECT ids.conv_id, ids.item, t.i AS pos, coalesce(c.text, '') AS option FROM ids, range(1, 5) t(i)
      LEFT JOIN c ON c.conv_id = ids.conv_id AND c.item = ids.item AND c.turn = t.i)
SELECT conv_id, item, CAST(pos - 1 AS INTEGER) AS pos, length(option) AS option_chars FROM g""")
def prj12(spark, sf):
    items = _mc_items(spark, sf)
    rows = items.select("conv_id", "item", F.posexplode("endings").alias("pos", "option"))
    # regroup by four in position order (the inverse step) and check it round-trips
    back = rows.groupBy("conv_id", "item").agg(F.array_sort(F.collect_list(F.struct("pos", "option"))).alias("s"))
    back = back.select("conv_id", "item", F.transform("s", lambda s: s["option"]).alias("endings2"))
    chk = rows.join(back, ["conv_id", "item"]).where(F.element_at("endings2", F.col("pos") + 1) == F.col("option"))
    return chk.select("conv_id", "item", F.col("pos").cast("int").alias("pos"), F.length("option").alias("option_chars"))


LETTERS = ("A", "B", "C", "D")


def format_demo(context, endings, label=None):
    """PRJ13: 'Context: ...' then 'A) ..' .. 'D) ..' then 'Answer: X' (answer only when given)."""
    parts = [F.concat(F.lit("Context: "), context)]
    parts += [F.concat(F.lit(f"{L}) "), F.element_at(endings, i + 1)) for i, L in enumerate(LETTERS)]
    ans = F.concat(F.lit("Answer: "), F.element_at(F.array(*[F.lit(x) for x in LETTERS]), label + 1)) \
        if label is not None else F.lit("Answer:")
    return F.concat_ws("\n", *parts, ans)


@query("prj13_fewshot_prompts", covers="PRJ13 SMP5", sql=f"""
WITH c AS (SELECT conv_id, CAST(turn // 5 AS INTEGER) AS item, turn % 5 AS turn, text FROM conversations),
items AS (SELECT conv_id, item, first(text ORDER BY turn) FILTER (WHERE turn = 0) AS context,
                 coalesce(first(text) FILTER (WHERE turn = 1), '') AS e1, coalesce(first(text) FILTER (WHERE turn = 2), '') AS e2,
                 coalesce(first(text) FILTER (WHERE turn = 3), '') AS e3, coalesce(first(text) FILTER (WHERE turn = 4), '') AS e4,
                 conv_id % 4 AS label
          FROM c GROUP BY conv_id, item),
h AS (SELECT *, concat_ws(chr(10), 'Context: ' || context, 'A) ' || e1, 'B) ' || e2, 'C) ' || e3, 'D) ' || e4) AS body,
             {h_sql(42, "conv_id", "item")} AS hv FROM items),
demos AS (SELECT * FROM h ORDER BY hv, conv_id, item LIMIT 4),
prefix AS (SELECT string_agg(body || chr(10) || 'Answer: ' || ['A', 'B', 'C', 'D'][label + 1], chr(10) || chr(10)
                             ORDER BY hv) AS p FROM demos)
SELECT conv_id, item, CAST(label AS INTEGER) AS label,
       CAST(length(p || chr(10) || chr(10) || body || chr(10) || 'Answer:') AS INTEGER) AS prompt_chars
FROM h, prefix""")
def prj13(spark, sf):
    items = _mc_items(spark, sf)
    demos = sampling.hash_sample(items, ["conv_id", "item"], 4, seed=42)
    demos = demos.withColumn("__h", sampling.hash64(["conv_id", "item"], 42))
    # the k demonstrations form one short text (k rows); it is prepended as a literal
    prefix = demos.agg(F.concat_ws("\n\n", F.transform(
        F.array_sort(F.collect_list(F.struct("__h", format_demo(F.col("context"), F.col("endings"), F.col("label"))
                                             .alias("t")))), lambda s: s["t"])).alias("prefix")).first()["prefix"]
    full = F.concat_ws("\n\n", F.lit(prefix), format_demo(F.col("context"), F.col("endings")))
    return items.select("conv_id", "item", "label", F.length(full).alias("prompt_chars"))


def _matches(spark, sf, status=None):
    li, o = load_table(spark, sf, "lineitem"), load_table(spark, sf, "orders")
    c, s = load_table(spark, sf, "customer"), load_table(spark, sf, "supplier")
    n = load_table(spark, sf, "nation")
    m = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
           .join(s, li.l_suppkey == s.s_suppkey))
    if status:
        m = m.where(F.col("o_orderstatus") == status)
    m = m.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", F.col("c_nationkey").alias("home_key"),
                 F.col("s_nationkey").alias("away_key"),
                 F.pmod(F.col("l_linenumber"), F.lit(4)).alias("home_goals"),
                 F.pmod(F.col("l_partkey"), F.lit(4)).alias("away_goals"))
    nn = n.select(F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey"))
    return (m.join(nn.withColumnsRenamed({"n_nationkey": "home_key", "n_name": "home_team", "n_regionkey": "home_group"}), "home_key")
             .join(nn.withColumnsRenamed({"n_nationkey": "away_key", "n_name": "away_team", "n_regionkey": "away_group"}), "away_key")
             .where(F.col("home_key") != F.col("away_key")))


_MATCH_SQL = """WITH m AS (
  SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, h.n_name AS home_team, h.n_regionkey AS home_group,
         a.n_name AS away_team, a.n_regionkey AS away_group, l_linenumber % 4 AS home_goals, l_partkey % 4 AS away_goals
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation h ON c_nationkey = h.n_nationkey
       JOIN nation a ON s_nationkey = a.n_nationkey WHERE c_nationkey <> s_nationkey)"""


@query("win9_group_standings", covers="WIN9 SRT2", sql=_MATCH_SQL + """,
u AS (SELECT home_group AS grp, home_team AS team,
             CASE WHEN home_goals > away_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END AS pts,
             home_goals - away_goals AS gd FROM m
      UNION ALL
      SELECT away_group, away_team, CASE WHEN away_goals > home_goals THEN 3 WHEN away_goals = home_goals THEN 1 ELSE 0 END,
             away_goals - home_goals FROM m),
s AS (SELECT grp, team, CAST(sum(pts) AS BIGINT) AS points, CAST(sum(gd) AS BIGINT) AS goal_diff FROM u GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY points DESC, goal_diff DESC, team) AS position FROM s)
SELECT CAST(grp AS INTEGER) AS grp, team, points, goal_diff, CAST(position AS INTEGER) AS position FROM r WHERE position <= 2""")
def win9(spark, sf):
    m = _matches(spark, sf)
    hp = F.when(F.col("home_goals") > F.col("away_goals"), 3).when(F.col("home_goals") == F.col("away_goals"), 1).otherwise(0)
    ap = F.when(F.col("away_goals") > F.col("home_goals"), 3).when(F.col("home_goals") == F.col("away_goals"), 1).otherwise(0)
    sides = F.array(F.struct(F.col("home_group").alias("grp"), F.col("home_team").alias("team"), hp.alias("pts"),
                             (F.col("home_goals") - F.col("away_goals")).alias("gd")),
                    F.struct(F.col("away_group").alias("grp"), F.col("away_team").alias("team"), ap.alias("pts"),
                             (F.col("away_goals") - F.col("home_goals")).alias("gd")))
    u = m.select(F.explode(sides).alias("s")).select("s.*")  # both sides of a match from one scan
    s = u.groupBy("grp", "team").agg(F.sum("pts").cast("bigint").alias("points"), F.sum("gd").cast("bigint").alias("goal_diff"))
    w = W.partitionBy("grp").orderBy(F.desc("points"), F.desc("goal_diff"), "team")
    return (s.withColumn("position", F.row_number().over(w)).where("position <= 2")
             .select(F.col("grp").cast("int").alias("grp"), "team", "points", "goal_diff", "position"))


@query("joi10_unordered_pair_first_match", covers="JOI10", sql=_MATCH_SQL + """,
fx AS (SELECT DISTINCT least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b
       FROM m WHERE o_orderstatus = 'P'),
hist AS (SELECT least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b,
                l_orderkey, l_linenumber, l_partkey, home_team, home_goals, away_goals FROM m WHERE o_orderstatus = 'F'),
r AS (SELECT fx.team_a, fx.team_b, hist.home_team, hist.home_goals, hist.away_goals,
             row_number() OVER (PARTITION BY fx.team_a, fx.team_b ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn
      FROM fx JOIN hist ON fx.team_a = hist.team_a AND fx.team_b = hist.team_b)
SELECT team_a, team_b, home_team AS first_home_team, home_goals AS first_home_goals, away_goals AS first_away_goals
FROM r WHERE rn = 1""")
def joi10(spark, sf):
    m = _matches(spark, sf)
    key = [F.least("home_team", "away_team").alias("team_a"), F.greatest("home_team", "away_team").alias("team_b")]
    fx = m.where("o_orderstatus = 'P'").select(*key).distinct()
    hist = m.where("o_orderstatus = 'F'").select(*key, "l_orderkey", "l_linenumber", "l_partkey", "home_team",
                                                 "home_goals", "away_goals")
    # first historical match of the pair in either orientation: a partial aggregate (min_by), no window
    first = hist.groupBy("team_a", "team_b").agg(F.min_by(F.struct("home_team", "home_goals", "away_goals"),
                                                          F.struct("l_orderkey", "l_linenumber", "l_partkey")).alias("f"))
    return fx.join(first, ["team_a", "team_b"]).select(
        "team_a", "team_b", F.col("f.home_team").alias("first_home_team"),
        F.col("f.home_goals").alias("first_home_goals"), F.col("f.away_goals").alias("first_away_goals"))


_GRID = (10, 30, 100)
_Z = 1.0


@query("stt5_normal_tail_vs_empirical", covers="STT5 STT1", sql="""
WITH s AS (SELECT avg(value) AS mu, stddev_pop(value) AS sigma FROM events),
""" + "\nUNION ALL ".join(f"""g{n} AS (SELECT {n} AS n, event_id // {n} AS sample_id, avg(value) AS m, count(*) AS k FROM events GROUP BY 2)"""
                           for n in _GRID).replace("\nUNION ALL ", ",\n") + """,
g AS (""" + " UNION ALL ".join(f"SELECT * FROM g{n}" for n in _GRID) + f""")
SELECT CAST(n AS INTEGER) AS n, count(*) AS n_samples,
       round(avg(CAST(m > mu + {_Z} * sigma / sqrt(n) AS DOUBLE)), 6) AS empirical,
       {round(norm_sf(_Z), 6)} AS normal_approx
FROM g, s WHERE k = n GROUP BY n""")
def stt5(spark, sf):
    e = load_table(spark, sf, "events")
    st = e.agg(F.avg("value").alias("mu"), F.stddev_pop("value").alias("sigma")).first()
    parts = []
    for n in _GRID:
        g = (e.groupBy(F.floor(F.col("event_id") / n).alias("sample_id"))
              .agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("k")).where(F.col("k") == n))
        thr = st["mu"] + _Z * st["sigma"] / math.sqrt(n)
        parts.append(g.agg(F.count(F.lit(1)).alias("n_samples"),
                           F.round(F.avg((F.col("m") > F.lit(thr)).cast("double")), 6).alias("empirical"))
                      .withColumn("n", F.lit(n)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("n", "n_samples", "empirical", F.lit(round(norm_sf(_Z), 6)).alias("normal_approx"))


# ---- rules over rows they apply to -------------------------------------------

@query("prj7_prefixed_columns", covers="PRJ7", sql="""
SELECT n_nationkey, n_name AS home_n_name, n_regionkey AS home_n_regionkey FROM nation""")
def prj7(spark, sf):
    n = load_table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return fe.rename_with_prefix(n, "home_", ["n_nationkey"])


@query("flt2_nul4_delays_and_reasons", covers="FLT2 NUL4 NUL1", sql=with_flights("""
SELECT coalesce(cancellation_reason, '__NA__') AS cancellation_reason, count(*) AS n_flights, round(avg(arrival_delay), 6) AS avg_delay
FROM flights WHERE arrival_delay IS NOT NULL GROUP BY 1"""))
def flt2(spark, sf):
    f = nulls.drop_null_rows(flights(spark, sf), ["arrival_delay"])
    f = nulls.fill_constants(f, {"cancellation_reason": "__NA__"})
    return f.groupBy("cancellation_reason").agg(F.count(F.lit(1)).alias("n_flights"), F.round(F.avg("arrival_delay"), 6).alias("avg_delay"))


@query("agg26_blank_reasons", covers="AGG26", sql=with_flights("""
SELECT 'cancellation_reason' AS "column", round(avg(CAST(trim(coalesce(cancellation_reason, '')) = '' AS DOUBLE)), 6) AS empty_rate FROM flights
UNION ALL SELECT 'blank', round(avg(CAST(flight_id % 3 <> 0 AS DOUBLE)), 6) FROM flights"""))
def agg26b(spark, sf):
    f = flights(spark, sf).withColumn("blank", F.when(F.col("flight_id") % 3 == 0, "x").otherwise("  "))
    return pf.empty_text_rate(f, ["cancellation_reason", "blank"]).select("column", _r("empty_rate"))


@query("joi9_orphan_parts", covers="JOI9", sql="""
SELECT p_partkey % 10 AS last_digit, count(*) AS n_rows FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_partkey % 10 IN (0, 5) GROUP BY 1""")
def joi9o(spark, sf):
    # parts whose key ends in 0 or 5 are missing on the parent side
    parents = load_table(spark, sf, "part").where(~F.pmod("p_partkey", F.lit(10)).isin(0, 5))
    o = joins.orphans(load_table(spark, sf, "lineitem"), parents, "l_partkey", "p_partkey")
    return o.groupBy(F.pmod("l_partkey", F.lit(10)).alias("last_digit")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("joi1_unmatched_role", covers="JOI1 JOI2", sql="""
SELECT coalesce(n_name, 'none') AS home, count(*) AS n_customers FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c_nationkey = n_nationkey GROUP BY 1""")
def joi1u(spark, sf):
    n = load_table(spark, sf, "nation").where("n_regionkey <> 0")
    j = joins.role_join(load_table(spark, sf, "customer").select("c_custkey", "c_nationkey"), n, "c_nationkey", "n_nationkey", "home_")
    return j.groupBy(F.coalesce("home_n_name", F.lit("none")).alias("home")).agg(F.count(F.lit(1)).alias("n_customers"))


@query("txt1_letter_forms", covers="TXT1 FLT7", sql="""
SELECT doc_id, length(translate(t, 'كي', 'کی')) AS n_chars, t LIKE '%ك%' OR t LIKE '%ي%' AS had_forms,
       translate(t, 'كي', 'کی') LIKE '%ک%' AS has_kaf
FROM (SELECT doc_id, translate(text, 'ky', 'كي') AS t FROM documents)""")
def txt1f(spark, sf):
    # Latin k and y of the documents stand in for the Arabic letter forms
    d = load_table(spark, sf, "documents").select("doc_id", F.translate("text", "ky", "كي").alias("t"))
    mapped = F.translate("t", tx.CHAR_MAP_FROM, tx.CHAR_MAP_TO)
    return d.select("doc_id", F.length(mapped).alias("n_chars"), F.col("t").rlike("[كي]").alias("had_forms"),
                    mapped.contains("ک").alias("has_kaf"))


@query("sca20_interaction_products", covers="SCA20", sql="""
SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS quantity_x_discount,
       round(l_extendedprice * CASE WHEN l_returnflag = 'R' THEN l_tax END, 6) AS price_x_tax FROM lineitem""")
def sca20i(spark, sf):
    li = load_table(spark, sf, "lineitem")
    tax = F.when(F.col("l_returnflag") == "R", F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", F.round(sc.interaction("l_quantity", "l_discount"), 6).alias("quantity_x_discount"),
                     F.round(sc.interaction("l_extendedprice", tax), 6).alias("price_x_tax"))
