"""Streaming queries run to completion over the events table as a file stream.

Each query reads ``events`` as a stream (the file source stands in for the
topic), runs with ``availableNow`` into Parquet under the shared checkpoint
folder, and returns what the sink received.  Append mode emits exactly the
windows closed by the final watermark (max event time - delay), so each
oracle is the batch twin's SQL restricted to those windows; the stateful
operators match their batch forms row for row.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tessera.plans import alerts as _alerts  # noqa: F401  (registers the batch twins first)
from tessera.plans import payments as _payments  # noqa: F401  (agg11, twin of the minute stream)
from tessera.plans.registry import REGISTRY, query
from tessera.plans.views import payments, payments_from, with_payments
from tessera.sources.tables import load_table
from tessera.streaming import metrics as M
from tessera.streaming import runner, stateful


def _closed(batch_query: str, delay_s: int, end_col: str = "end_time") -> str:
    """Oracle of an append-mode stream run to completion: its batch twin's rows
    whose window closed under the final watermark (max event time - delay)."""
    return (f"SELECT * FROM ({REGISTRY[batch_query][1]}) WHERE {end_col} <= "
            f"({with_payments('SELECT max(ts) FROM pay')}) - INTERVAL {delay_s} SECOND")


def _ntz(*cols):
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in cols]


def _txn_stream(spark, sf):
    schema = load_table(spark, sf, "events").schema
    src = runner.read_stream(spark, os.path.join(sf, "events.parquet"), schema)
    return M.event_time(payments_from(src))


@query("str1_sliding_category_stream", covers="STR1 SRC2 SNK1",
       sql=_closed("str1_sliding_category_commission_batch", 60))
def str1s(spark, sf):
    df = M.sliding_category_commission(_txn_stream(spark, sf), watermark=M.CATEGORY_WINDOW)
    out = runner.run_to_table(df, "str1_sliding_category")
    return out.select(*_ntz("start_time", "end_time"), "merchant_category", "total_commission",
                      F.round("avg_commission", 6).alias("avg_commission"))


@query("str2_velocity_stream", covers="STR2 STR9", sql=_closed("str2_velocity_alerts_batch", 120))
def str2s(spark, sf):
    out = runner.run_to_table(M.velocity_alerts(_txn_stream(spark, sf)), "str2_velocity")
    return out.select("customer_id", *_ntz("start_time", "end_time"), "detail", "fraud_reason")


@query("str3_geo_window_stream", covers="STR3", sql=_closed("str3_geo_window_alerts_batch", 300))
def str3s(spark, sf):
    out = runner.run_to_table(M.geo_window_alerts(_txn_stream(spark, sf)), "str3_geo_window")
    return out.select("customer_id", *_ntz("start_time", "end_time"), "detail", "fraud_reason")


# pairs are emitted once the watermark (milliseconds, five minutes behind) has passed both events
@query("str3_geo_state_stream", covers="STR3 WIN8", sql=f"""
SELECT j.* FROM ({REGISTRY["win8_geo_consecutive_jumps"][1]}) j
JOIN ({with_payments("SELECT transaction_id, ts FROM pay")}) p USING (transaction_id)
WHERE epoch_us(p.ts) < ((SELECT epoch_ms(max(ts)) FROM ({with_payments("SELECT ts FROM pay")})) - 300000) * 1000""")
def str3st(spark, sf):
    out = runner.run_to_table(stateful.geo_jumps_stateful(_txn_stream(spark, sf)), "str3_geo_state")
    return out.select("customer_id", "transaction_id", "prev_transaction_id",
                      F.round("seconds_apart", 6).alias("seconds_apart"), F.round("distance_km", 4).alias("distance_km"))


@query("str6_metric_a_stream", covers="STR6", sql=_closed("str6_metric_commission_by_type_batch", 60))
def str6s(spark, sf):
    out = runner.run_to_table(M.metric_commission_by_type(_txn_stream(spark, sf)), "str6_metric_a")
    return out.select(*_ntz("start_time", "end_time"), "metric", "dimension", "value")


@query("str7_metric_b_stream", covers="STR7", sql=_closed("str7_metric_commission_ratio_batch", 60))
def str7s(spark, sf):
    out = runner.run_to_table(M.metric_commission_ratio(_txn_stream(spark, sf)), "str7_metric_b")
    return out.select(*_ntz("start_time", "end_time"), "metric", "dimension", F.round("value", 6).alias("value"))


@query("str8_metric_c_stream", covers="STR8 WIN13", sql=_closed("win13_top_merchant_per_window", 60))
def str8s(spark, sf):
    out = runner.run_to_table(M.metric_top_merchant(_txn_stream(spark, sf)), "str8_metric_c")
    return out.select(*_ntz("start_time", "end_time"), "metric", "dimension", "value")


@query("str13_minute_volume_stream", covers="STR13 AGG11",
       sql=_closed("agg11_minute_volume", 60, "minute + INTERVAL 60 SECOND"))
def str13s(spark, sf):
    t = _txn_stream(spark, sf).withWatermark("event_time", "1 minute")
    df = (t.groupBy(F.window("event_time", "1 minute").alias("w"))
           .agg(F.count(F.lit(1)).alias("transaction_count"))
           .select(F.col("w.start").alias("minute"), "transaction_count"))
    out = runner.run_to_table(df, "str13_minute_volume")
    return out.select(*_ntz("minute"), "transaction_count")


@query("str14_spike_state_stream", covers="STR14 WIN6 WIN7", sql=REGISTRY["win7_spike_detection"][1])
def str14s(spark, sf):
    out = runner.run_to_table(stateful.spikes_stateful(_txn_stream(spark, sf)), "str14_spikes")
    return out.select("transaction_id", F.col("merchant_id").cast("int").alias("merchant_id"), "rolling_count",
                      "hour_count", "prev_hours_count", F.round("baseline", 6).alias("baseline"), "is_spike")


@query("str14_spike_three_hours_stream", covers="STR14 WIN6 WIN7", sql=REGISTRY["win7_spike_three_hours"][1])
def str14h(spark, sf):
    out = runner.run_to_table(stateful.spikes_stateful(_txn_stream(spark, sf), horizon_hours=3), "str14_spikes_h3")
    return out.select("transaction_id", F.col("merchant_id").cast("int").alias("merchant_id"), "rolling_count",
                      "hour_count", "prev_hours_count", F.round("baseline", 6).alias("baseline"), "is_spike")


# one query, two watermarks: windows close under the later one (five minutes)
@query("str5_alert_union_stream", covers="STR5 STR4 SET1 UDF2", sql=_alerts.alert_union_sql(
    f"end_time <= ({with_payments('SELECT max(ts) FROM pay')}) - INTERVAL 300 SECOND"))
def str5s(spark, sf):
    avg = payments(spark, sf).groupBy("customer_id").agg(F.avg("amount").alias("avg_amount"))
    out = runner.run_to_table(_alerts.alert_union(_txn_stream(spark, sf), avg, watermark=True), "str5_alerts")
    return _alerts.alert_columns(out)


_STREAMS = ("str10_metric_a", "str10_metric_b", "str10_alerts_json")


@query("str10_concurrent_streams_progress", covers="STR10 SNK1", sql="\nUNION ALL ".join(
    f"SELECT '{n}' AS query, count(*) AS input_rows, CAST(0 AS BIGINT) AS lag FROM events" for n in _STREAMS))
def str10(spark, sf):
    t = _txn_stream(spark, sf)
    qs = [runner.start(M.metric_commission_by_type(t), _STREAMS[0]),
          runner.start(M.metric_commission_ratio(t), _STREAMS[1]),
          runner.start(runner.json_values(M.velocity_alerts(t)), _STREAMS[2], fmt="json")]
    runner.await_all(spark, qs, timeout_s=600)
    return runner.progress_table(spark, qs).select("query", "input_rows", "lag")


# Arrival in five parts: six days each, out of order by up to a minute; some bursts come with the
# last part, long after their window.  The stream stops after each part and goes on from its
# checkpoint.  Rows of the last part are late if their window had closed when the others were read.
_ARRIVAL_SQL = """,
p AS (SELECT *, transaction_id // 8 % 12 = 0 AND transaction_id // 96 % 5 = 0 AS held FROM pay),
q AS (SELECT *, CASE WHEN held THEN 4 ELSE least(4, (epoch_ms(ts) // 1000 - 1704067200 + transaction_id % 7 * 10) // 518400) END AS part,
             time_bucket(INTERVAL 2 MINUTE, ts, TIMESTAMP '1970-01-01') AS start_time FROM p)
SELECT customer_id, start_time, start_time + INTERVAL 2 MINUTE AS end_time, CAST(count(*) AS VARCHAR) AS detail, 'velocity' AS fraud_reason
FROM q WHERE start_time + INTERVAL 2 MINUTE <= (SELECT max(ts) FROM q) - INTERVAL 2 MINUTE
  AND NOT (held AND start_time + INTERVAL 2 MINUTE <= (SELECT max(ts) FROM q WHERE part <= 3) - INTERVAL 2 MINUTE)
GROUP BY ALL HAVING count(*) > 5"""


@query("str11_restart_and_late_rows", covers="STR11 STR9 STR2", sql=with_payments(_ARRIVAL_SQL))
def str11(spark, sf):
    tag = uuid.uuid4().hex[:12]
    folder = runner.shared_path(spark, "streams", "str11", tag, "in")
    out = runner.shared_path(spark, "streams", "str11", tag, "out")
    checkpoint = runner.shared_path(spark, "streams", "str11", tag, "_checkpoint")
    t = payments(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    eid = F.col("transaction_id")
    held = (F.pmod(F.floor(eid / 8), F.lit(12)) == 0) & (F.pmod(F.floor(eid / 96), F.lit(5)) == 0)
    part = F.least(F.lit(4), F.floor((F.floor(F.unix_millis("ts") / 1000) - 1704067200 + F.pmod(eid, F.lit(7)) * 10) / 518400))
    t = t.withColumn("part", F.when(held, F.lit(4)).otherwise(part).cast("int"))
    schema = t.drop("part").schema

    def arrive(n):
        t.where(F.col("part") == n).drop("part").write.mode("append").parquet(f"{folder}/p{n}")

    def go_on():
        src = M.event_time(spark.readStream.schema(schema).parquet(f"{folder}/*"))
        q = runner.start(M.velocity_alerts(src), "str11", path=out, checkpoint=checkpoint)
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    for n in range(5):
        arrive(n)
        go_on()
    res = spark.read.parquet(out)
    return res.select("customer_id", *_ntz("start_time", "end_time"), "detail", "fraud_reason")


@query("str12_stream_validation_dead_letter", covers="STR12 SNK2 SRC4 SRC1 FLT1",
       sql=with_payments(_alerts.VALIDATION_CTE + """
SELECT CASE WHEN error_codes <> '' THEN 'dead_letter' ELSE 'valid' END AS output, count(*) AS n_rows FROM v GROUP BY 1"""))
def str12(spark, sf):
    from tessera.operators import quality
    from tessera.plans.alerts import AS_OF
    # drain the events "topic" to JSON lines (SRC4), then validate the JSON stream
    events = load_table(spark, sf, "events")
    folder = runner.drain_to_files(spark, runner.read_stream(spark, os.path.join(sf, "events.parquet"),
                                                             events.schema), "str12_events")
    pays = payments_from(spark.readStream.schema(events.schema).json(folder))

    def route(batch):
        valid, dead = quality.route_dead_letter(quality.validation_errors(batch, AS_OF))
        return {"valid": valid.select("transaction_id", "amount"), "dead": dead}

    tag = uuid.uuid4().hex[:12]
    out = {k: runner.shared_path(spark, "streams", "str12", tag, k) for k in ("valid", "dead")}
    q = runner.start_split_sink(pays, "str12_validate", route, out)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    dead, valid = spark.read.parquet(out["dead"]), spark.read.parquet(out["valid"])
    return (dead.select(F.lit("dead_letter").alias("output"), "transaction_id")
                .unionByName(valid.select(F.lit("valid").alias("output"), "transaction_id"))
                .groupBy("output").agg(F.count(F.lit(1)).alias("n_rows")))


@query("str13_live_merchant_counts", covers="STR13 AGG12", sql=with_payments("""
SELECT merchant_id, count(*) AS transaction_count FROM pay GROUP BY 1"""))
def str13m(spark, sf):
    t = _txn_stream(spark, sf)
    counts = t.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("transaction_count"))
    out = runner.shared_path(spark, "streams", "str13_live_counts", uuid.uuid4().hex[:12])
    q = runner.run_update_counts(counts, "str13_live_counts", out)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return runner.latest(spark.read.parquet(out), ["merchant_id"], ["transaction_count"])


# Six days of rows arrive at a time; the stream stops after each part and goes on from its checkpoint.
@query("str1_running_category_table", covers="STR1 STR11 STR13", sql=REGISTRY["str1_sliding_category_commission_batch"][1])
def str1r(spark, sf):
    """Every window as it stands when the rows end: closed ones and those still open."""
    tag = uuid.uuid4().hex[:12]
    folder, out, checkpoint = (runner.shared_path(spark, "streams", "str1_running", tag, k) for k in ("in", "out", "_checkpoint"))
    t = payments(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    part = F.greatest(F.lit(0), F.least(F.lit(4), F.floor((F.unix_millis("ts") / 1000 - 1704067200) / 518400)))
    for n in range(5):
        t.where(part == n).write.mode("overwrite").parquet(f"{folder}/p{n}")
        df = M.sliding_category_commission(M.event_time(spark.readStream.schema(t.schema).parquet(f"{folder}/*")), watermark=M.CATEGORY_WINDOW)
        q = runner.run_update_counts(df, "str1_running", out, checkpoint)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    res = runner.running_table(spark, out, df.schema, ["start_time", "end_time", "merchant_category"])
    return res.select(*_ntz("start_time", "end_time"), "merchant_category", "total_commission", F.round("avg_commission", 6).alias("avg_commission"))


# Seven files of unlike size (one writer each, so that the oracle knows the files), two a micro-batch.
@query("str15_backlog_after_each_batch", covers="STR15 SRC4 SRC2", sql="""
WITH f AS (SELECT CAST(floor(sqrt(event_id % 49)) AS BIGINT) AS part FROM events),
b AS (SELECT part // 2 AS batch_id, count(*) AS input_rows FROM f GROUP BY 1)
SELECT batch_id, input_rows, CAST(sum(input_rows) OVER () - sum(input_rows) OVER (ORDER BY batch_id) AS BIGINT) AS lag FROM b""")
def str15(spark, sf):
    e = load_table(spark, sf, "events")
    folder = runner.shared_path(spark, "streams", "str15", uuid.uuid4().hex[:12], "in")
    part = F.floor(F.sqrt(F.pmod("event_id", F.lit(49))))
    for n in range(7):
        e.where(part == n).coalesce(1).write.mode("append").parquet(folder)
    return runner.bounded_drain(spark, folder, e.schema, "str15_backlog", files_per_trigger=2)[1]
