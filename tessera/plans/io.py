"""Source and sink round trips: each query writes data derived from the test
tables to the shared folder, reads it back through the operator under test
and aggregates, so the oracle is the same aggregate over the original table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.registry import query
from tessera.plans.sqlhash import split_sql
from tessera.plans.views import payments, with_payments
from tessera.sources import files, sinks
from tessera.sources.tables import load_table
from tessera.streaming.runner import shared_path


def _dir(spark, name):
    return shared_path(spark, "io", name, uuid.uuid4().hex[:12])


@query("src1_json_lines_scan", covers="SRC1 SRC4 PRJ5", sql="""
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total_value FROM events GROUP BY 1""")
def src1(spark, sf):
    ev = load_table(spark, sf, "events")
    p = _dir(spark, "events_json")
    ev.write.mode("overwrite").json(p)
    back = files.read_json_lines(spark, p, ev.schema)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total_value"))


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@query("src5_csv_scan", covers="SRC5 SNK7", sql="""
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 4) AS total_balance FROM customer GROUP BY 1""")
def src5(spark, sf):
    c = load_table(spark, sf, "customer")
    p = _dir(spark, "customer_csv")
    sinks.export_csv(c, p)
    back = files.read_csv(spark, p, CUSTOMER_SCHEMA)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"),
                                            F.round(F.sum("c_acctbal"), 4).alias("total_balance"))


@query("src6_dated_csv_ordered", covers="SRC6 SRT1", sql="""
SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d, count(*) AS n_orders FROM orders GROUP BY 1""")
def src6(spark, sf):
    o = load_table(spark, sf, "orders")
    daily = o.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n_orders"))
    # an exported pandas frame carries its row index as an unnamed first column
    p = _dir(spark, "daily_csv")
    daily.select(F.monotonically_increasing_id().alias("Unnamed: 0"), "d", "n_orders").write.option("header", True).csv(p)
    schema = "`Unnamed: 0` BIGINT, d DATE, n_orders BIGINT"
    back = files.read_dated_csv(spark, p, schema, "d")
    return back.select(F.date_format("d", "yyyy-MM-dd").alias("d"), "n_orders")


@query("src7_nested_json_explode", covers="SRC7 AGG30", sql="""
SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations""")
def src7(spark, sf):
    c = load_table(spark, sf, "conversations")
    nested = c.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns"))
    p = _dir(spark, "conv_nested")
    nested.write.json(p)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turns", T.ArrayType(
        T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                      T.StructField("text", T.StringType())])))])
    back = files.read_nested_json(spark, p, schema, "turns", ["conv_id"], multiline=False)
    return back.select("conv_id", "turn", "role", F.length("text").alias("n_chars"))


@query("src9_labelled_file_listing", covers="SRC9", sql="""
SELECT regexp_extract(url, '/(en|fr|de|es)/', 1) AS label, count(*) AS n_pages FROM pages GROUP BY 1""")
def src9(spark, sf):
    pg = load_table(spark, sf, "pages").withColumn("label", F.regexp_extract("url", "/(en|fr|de|es)/", 1))
    root = _dir(spark, "pages_files")
    # one folder per label; a file holds the pages of one task, each on one line
    pg.select("label", F.regexp_replace("html", r"[\r\n]+", " ").alias("value")).write.partitionBy("label").text(f"{root}/train")
    listing = files.read_labelled_files(spark, root, r"/(train|test)/label=([^/]*)/", "*.txt")
    lines = F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1
    label = F.when(F.col("label") == "__HIVE_DEFAULT_PARTITION__", "").otherwise(F.col("label"))
    return listing.groupBy(label.alias("label")).agg(F.sum(lines).alias("n_pages"))


@query("src10_split_sizes", covers="SRC10 SMP1", sql=f"""
SELECT split, count(*) AS num_rows FROM (
  SELECT {split_sql(42, ["item_id"], {"train": 0.8, "validation": 0.1, "test": 0.1})} AS split FROM benchmark) GROUP BY 1""")
def src10(spark, sf):
    from tessera.operators import sampling
    b = sampling.hash_split(load_table(spark, sf, "benchmark"), ["item_id"],
                            {"train": 0.8, "validation": 0.1, "test": 0.1})
    p = _dir(spark, "benchmark_splits")
    b.write.partitionBy("split").parquet(p)
    return files.split_sizes(spark.read.parquet(p))


@query("snk3_partitioned_append_and_retention", covers="SNK3 SNK10 SNK4", sql=with_payments("""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS n
FROM pay WHERE ts >= TIMESTAMP '2024-01-25 12:00:00' GROUP BY 1"""))
def snk3(spark, sf):
    p = _dir(spark, "payments_by_date")
    sinks.append_partitioned_by_date(payments(spark, sf).select("transaction_id", "ts", "amount"), p)
    table = spark.read.parquet(p)
    sinks.apply_retention(table, p, "ts", "2024-01-25 12:00:00")
    kept = spark.read.parquet(p)
    return kept.groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))


@query("snk6_replace_then_append_unique", covers="SNK5 SNK6 SET2", sql="""
SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1""")
def snk6(spark, sf):
    o = load_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    p = _dir(spark, "orders_pk")
    first = o.where("o_orderstatus = 'F'")
    sinks.replace_table(first, p)
    sinks.append_unique(o.where("o_orderstatus <> 'F'"), p, ["o_orderkey"], existing=spark.read.parquet(p))
    back = spark.read.parquet(p)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("snk8_preview_head_tail", covers="SNK8 SRT6", sql="""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, count(*) OVER () AS total_rows
           FROM orders)
SELECT position, o_orderkey, total_rows FROM r WHERE position < 6 OR position >= total_rows - 3""")
def snk8(spark, sf):
    o = load_table(spark, sf, "orders").select("o_orderkey").orderBy("o_orderkey")
    return sinks.preview(o)


@query("src3_topic_batch_scan", covers="SRC3 SRC2", sql="""
SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def src3(spark, sf):
    # the same call reads a Kafka topic with fmt="kafka"; here the file format stands in
    from tessera.streaming.runner import read_topic_batch
    ev = read_topic_batch(spark, {"path": f"{sf}/events.parquet"}, fmt="parquet")
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("joi12_listings_by_neighbourhood", covers="JOI12 AGG35 SRC11", sql="""
SELECT n_name AS neighbourhood, r_name AS area, count(*) AS n_listings, round(avg(s_acctbal), 4) AS avg_balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def joi12(spark, sf):
    s, n, r = (load_table(spark, sf, t) for t in ("supplier", "nation", "region"))
    loc = n.join(r, n.n_regionkey == r.r_regionkey)
    j = s.join(loc, s.s_nationkey == loc.n_nationkey)
    return j.groupBy(F.col("n_name").alias("neighbourhood"), F.col("r_name").alias("area")).agg(
        F.count(F.lit(1)).alias("n_listings"), F.round(F.avg("s_acctbal"), 4).alias("avg_balance"))
