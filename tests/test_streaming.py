import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tessera.streaming import metrics as M
from tessera.streaming import runner, stateful

SCHEMA = "transaction_id LONG, customer_id LONG, merchant_id LONG, ts TIMESTAMP, lat DOUBLE, lng DOUBLE, " \
         "commission_amount LONG, amount LONG, commission_type STRING, merchant_category STRING"


def _write(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(folder, name))


def _stream(spark, folder):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder + "/*")
    return M.event_time(src)


def _row(i, cust, ts, lat=25.0, merch=1):
    return (i, cust, merch, ts, lat, 45.0, 10 * i, 1000, "flat", "retail")


def test_velocity_stream_matches_batch_and_drops_late(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [_row(i, 1, t0 + dt.timedelta(seconds=5 * i)) for i in range(6)]          # 6 in one window -> alert
    rows += [_row(10 + i, 2, t0 + dt.timedelta(seconds=5 * i)) for i in range(5)]    # 5 -> no alert
    rows += [_row(20 + i, 3, t0 + dt.timedelta(seconds=100 + 5 * i)) for i in range(6)]  # 6 across a boundary
    folder = tempfile.mkdtemp(dir="/tmp")
    _write(spark, folder, rows, "a")
    # later batches move the watermark on; rows arriving after that behind it are dropped.
    # (Spark judges lateness against the previous batch's watermark, hence two batches.)
    _write(spark, folder, [_row(40, 9, t0 + dt.timedelta(minutes=30))], "b")
    _write(spark, folder, [_row(41, 9, t0 + dt.timedelta(minutes=31))], "b2")
    _write(spark, folder, [_row(50 + i, 4, t0 + dt.timedelta(seconds=i)) for i in range(7)], "c")
    _write(spark, folder, [_row(60, 9, t0 + dt.timedelta(minutes=60))], "d")
    out = runner.run_to_table(M.velocity_alerts(_stream(spark, folder)), "t_velocity").collect()
    assert {(r["customer_id"], r["detail"]) for r in out} == {(1, "6")}
    batch = M.velocity_alerts(M.event_time(spark.createDataFrame(rows, SCHEMA)), watermark=None).collect()
    assert {(r["customer_id"], r["detail"]) for r in batch} == {(1, "6")}


def test_stateful_geo_catches_pairs_across_windows(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 4, 50)                          # 10 s before a 5-minute edge
    rows = [_row(1, 7, t0, lat=25.0), _row(2, 7, t0 + dt.timedelta(seconds=20), lat=27.0),   # 222 km, 20 s
            _row(3, 8, t0, lat=25.0), _row(4, 8, t0 + dt.timedelta(seconds=301), lat=27.0),   # 301 s: no
            _row(5, 9, t0, lat=25.0), _row(6, 9, t0 + dt.timedelta(seconds=300), lat=25.44),  # 48.9 km: no
            _row(7, 10, t0 + dt.timedelta(minutes=30))]  # moves the watermark past the others
    folder = tempfile.mkdtemp(dir="/tmp")
    _write(spark, folder, rows, "a")
    out = runner.run_to_table(stateful.geo_jumps_stateful(_stream(spark, folder)), "t_geo").collect()
    assert {(r["customer_id"], r["transaction_id"]) for r in out} == {(7, 2)}
    # the tumbling-window variant misses the pair that straddles the window edge
    win = M.geo_window_alerts(M.event_time(spark.createDataFrame(rows, SCHEMA)), watermark=None).collect()
    assert win == []


def test_top_merchant_stream_equals_batch_on_closed_windows(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(i, i % 3, i % 4, t0 + dt.timedelta(seconds=13 * i), 25.0, 45.0, (i * 37) % 11, 1000, "flat", "retail")
            for i in range(200)]
    folder = tempfile.mkdtemp(dir="/tmp")
    _write(spark, folder, rows[:100], "a")
    _write(spark, folder, rows[100:], "b")
    s = runner.run_to_table(M.metric_top_merchant(_stream(spark, folder)), "t_top")
    b = M.metric_top_merchant(M.event_time(spark.createDataFrame(rows, SCHEMA)), watermark=None)
    got = {(r["start_time"], r["dimension"], r["value"]) for r in s.collect()}
    exp = {(r["start_time"], r["dimension"], r["value"]) for r in b.collect()}
    assert got and got <= exp
    last_closed = max(r[0] for r in got)
    assert {e for e in exp if e[0] <= last_closed} == got


def test_progress_table(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    folder = tempfile.mkdtemp(dir="/tmp")
    _write(spark, folder, [_row(i, 1, t0 + dt.timedelta(seconds=i)) for i in range(10)], "a")
    q = runner.start(M.sliding_category_commission(_stream(spark, folder), watermark="1 minute"), "t_prog")
    runner.await_all(spark, [q])
    p = runner.progress_table(spark, [q]).collect()
    assert p and p[0]["query"].startswith("t_prog")


def test_stateful_spikes_match_batch_on_ordered_data(spark):
    import random
    from tessera.operators import windows
    rnd = random.Random(2)
    t0 = dt.datetime(2024, 1, 1, 9, 0, 0)
    secs = sorted(rnd.sample(range(0, 3 * 3600), 400))
    rows = [(i, rnd.choice([1, 1, 1, 2]), t0 + dt.timedelta(seconds=s, microseconds=i)) for i, s in enumerate(secs)]
    schema = "transaction_id LONG, merchant_id LONG, ts TIMESTAMP"
    folder = tempfile.mkdtemp(dir="/tmp")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(folder, "a"))
    src = M.event_time(spark.readStream.schema(schema).parquet(folder + "/*"))
    got = {r["transaction_id"]: r for r in runner.run_to_table(stateful.spikes_stateful(src), "t_spike").collect()}
    exp = {r["transaction_id"]: r for r in windows.spike_flags(spark.createDataFrame(rows, schema)).collect()}
    assert got.keys() == exp.keys()
    for k, e in exp.items():
        g = got[k]
        assert (g["rolling_count"], g["hour_count"], g["prev_hours_count"], g["is_spike"]) == \
               (e["rolling_count"], e["hour_count"], e["prev_hours_count"], e["is_spike"]), k


def test_stateful_spikes_across_micro_batches(spark):
    import random
    from tessera.operators import windows
    rnd = random.Random(9)
    t0 = dt.datetime(2024, 1, 1, 9, 0, 0)
    secs = sorted(rnd.sample(range(0, 5 * 3600), 900))
    rows = [(i, rnd.choice([1, 1, 2, 3]), t0 + dt.timedelta(seconds=s, microseconds=i)) for i, s in enumerate(secs)]
    schema = "transaction_id LONG, merchant_id LONG, ts TIMESTAMP"
    folder = tempfile.mkdtemp(dir="/tmp")
    for j in range(0, len(rows), 150):          # six files -> six micro-batches, in time order
        spark.createDataFrame(rows[j:j + 150], schema).coalesce(1).write.parquet(os.path.join(folder, f"p{j:05d}"))
    src = M.event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder + "/*"))
    got = {r["transaction_id"]: r for r in runner.run_to_table(stateful.spikes_stateful(src), "t_spike_mb").collect()}
    exp = {r["transaction_id"]: r for r in windows.spike_flags(spark.createDataFrame(rows, schema)).collect()}
    assert got.keys() == exp.keys()
    for k, e in exp.items():
        g = got[k]
        assert (g["rolling_count"], g["hour_count"], g["prev_hours_count"]) == \
               (e["rolling_count"], e["hour_count"], e["prev_hours_count"]), k


def test_stateful_geo_across_micro_batches(spark):
    import random
    from tessera.operators import windows
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1, 9, 0, 0)
    secs = sorted(rnd.sample(range(0, 3 * 3600), 600))
    rows = [_row(i, rnd.choice([1, 2, 3]), t0 + dt.timedelta(seconds=s), lat=25.0 + rnd.choice([0, 1, 2]))
            for i, s in enumerate(secs)]
    folder = tempfile.mkdtemp(dir="/tmp")
    for j in range(0, len(rows), 100):
        _write(spark, folder, rows[j:j + 100], f"p{j:05d}")
    out = runner.run_to_table(stateful.geo_jumps_stateful(_stream(spark, folder)), "t_geo_mb").collect()
    got = {(r["transaction_id"], r["prev_transaction_id"]) for r in out}
    b = spark.createDataFrame(rows, SCHEMA)
    # pairs are complete once the watermark (five minutes behind the last row) has passed them
    closed = {r[0] for r in rows if r[3] < rows[-1][3] - dt.timedelta(minutes=5)}
    exp = {(r["transaction_id"], r["prev_transaction_id"]) for r in windows.consecutive_geo_jumps(b).collect() if r["transaction_id"] in closed}
    assert got == exp and exp


def _batches(spark, folder, schema, parts):
    import time
    for j, part in enumerate(parts):  # one file, and so one micro-batch, for each part, in this order
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(os.path.join(folder, f"p{j:05d}"))
        time.sleep(0.05)


def test_spike_counts_of_rows_that_come_out_of_order(spark):
    """10:00, then 09:50, then 10:20: the last batch is the 6th to 10th row of its hour."""
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    schema = "transaction_id LONG, merchant_id LONG, ts TIMESTAMP"
    parts = [[(10 * j + i, 1, t0 + dt.timedelta(minutes=m, seconds=i)) for i in range(5)] for j, m in enumerate((0, -10, 20))]
    folder = tempfile.mkdtemp(dir="/tmp")
    _batches(spark, folder, schema, parts)
    src = M.event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder + "/*"))
    got = {r["transaction_id"]: r for r in runner.run_to_table(stateful.spikes_stateful(src), "t_spike_ooo").collect()}
    assert [got[20 + i]["hour_count"] for i in range(5)] == [6, 7, 8, 9, 10]
    assert [got[20 + i]["rolling_count"] for i in range(5)] == [1, 2, 3, 4, 5]
    assert [got[20 + i]["prev_hours_count"] for i in range(5)] == [5] * 5
    assert [got[10 + i]["hour_count"] for i in range(5)] == [1, 2, 3, 4, 5]


def test_spike_horizon_of_three_hours_matches_batch(spark):
    import random
    from tessera.operators import windows
    rnd = random.Random(4)
    t0 = dt.datetime(2024, 1, 1, 9, 0, 0)
    secs = sorted(rnd.sample(range(0, 6 * 3600), 120)) + list(range(7 * 3600, 7 * 3600 + 80, 10))
    schema = "transaction_id LONG, merchant_id LONG, ts TIMESTAMP"
    rows = [(i, 1 if s >= 7 * 3600 else rnd.choice([1, 2, 3, 4]), t0 + dt.timedelta(seconds=s, microseconds=i)) for i, s in enumerate(secs)]
    folder = tempfile.mkdtemp(dir="/tmp")
    _batches(spark, folder, schema, [rows[:50], rows[50:100], rows[100:]])
    src = M.event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder + "/*"))
    got = {r["transaction_id"]: r for r in runner.run_to_table(stateful.spikes_stateful(src, horizon_hours=3), "t_spike_h3").collect()}
    exp = {r["transaction_id"]: r for r in windows.spike_flags(spark.createDataFrame(rows, schema), horizon_hours=3).collect()}
    cols = ("rolling_count", "hour_count", "prev_hours_count", "is_spike")
    assert {k: [r[c] for c in cols] for k, r in got.items()} == {k: [r[c] for c in cols] for k, r in exp.items()}


def test_geo_pairs_of_rows_that_come_late_inside_the_watermark(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    at = lambda i, s, lat: _row(i, 7, t0 + dt.timedelta(seconds=s), lat=lat)
    folder = tempfile.mkdtemp(dir="/tmp")
    _write(spark, folder, [at(1, 0, 25.0), at(2, 100, 25.0)], "a")
    _write(spark, folder, [at(3, 50, 27.0)], "b")       # late by 50 s: pairs 1-3 and 3-2, not 1-2
    _write(spark, folder, [at(9, 3600, 25.0)], "c")     # moves the watermark on
    out = runner.run_to_table(stateful.geo_jumps_stateful(_stream(spark, folder)), "t_geo_late").collect()
    assert {(r["prev_transaction_id"], r["transaction_id"]) for r in out} == {(1, 3), (3, 2)}


def test_progress_counts_rows_and_lag(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    folder = tempfile.mkdtemp(dir="/tmp")
    for j in range(3):
        _write(spark, folder, [_row(10 * j + i, 1, t0 + dt.timedelta(seconds=10 * j + i)) for i in range(10)], f"p{j}")
    q = runner.start(M.sliding_category_commission(_stream(spark, folder), watermark="1 minute"), "t_rows")
    runner.await_all(spark, [q], timeout_s=120)
    r = runner.progress_table(spark, [q]).first()
    assert (r["query"], r["busy_batches"], r["input_rows"], r["lag"]) == ("t_rows", 3, 30, 0)
    assert runner._offset_lag('{"t":{"0":10,"1":7}}', '{"t":{"0":4,"1":7}}') == 6


def test_backlog_is_seen_after_each_batch_and_a_drain_goes_on(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / k) for k in ("in", "out", "_checkpoint"))
    def arrive(*sizes):
        for n in sizes:
            spark.range(n).coalesce(1).write.mode("append").parquet(folder)
    def drain(files=1):
        path, log = runner.bounded_drain(spark, folder, "id LONG", "t_drain", files, out=out, checkpoint=checkpoint)
        assert path == out
        return [(r.input_rows, r.lag) for r in log.orderBy("batch_id").collect()]
    (tmp_path / "in").mkdir()
    assert drain() == []
    arrive(5, 3, 2)
    assert drain() == [(5, 5), (3, 2), (2, 0)]
    assert drain() == []
    arrive(4, 1, 1)
    assert drain(2) == [(5, 1), (1, 0)]
    assert spark.read.parquet(out).count() == 16


def test_running_table_holds_open_windows_and_a_replayed_batch_changes_nothing(spark, tmp_path, request):
    key = "spark.sql.streaming.noDataMicroBatches.enabled"  # the last batch has rows
    spark.conf.set(key, "false")
    request.addfinalizer(lambda: spark.conf.unset(key))
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    folder, out, checkpoint = (str(tmp_path / k) for k in ("in", "out", "_checkpoint"))
    keys = ["start_time", "end_time", "merchant_category"]
    def go_on():
        df = M.sliding_category_commission(_stream(spark, folder), watermark="1 minute")
        q = runner.run_update_counts(df, "t_running", out, checkpoint)
        q.awaitTermination()
        assert q.exception() is None
        return df
    for n, rows in enumerate(([_row(1, 1, t0), _row(2, 1, t0 + dt.timedelta(seconds=5))], [_row(3, 1, t0 + dt.timedelta(seconds=30))])):
        _write(spark, folder, rows, f"p{n}")
        df = go_on()
    read = lambda: {str(r.start_time)[11:19]: r.total_commission for r in runner.running_table(spark, out, df.schema, keys).collect()}
    want = {"09:59:20": 30, "09:59:40": 60, "10:00:00": 60, "10:00:20": 30}
    assert read() == want
    # without its commit the last batch counts as lost half way: it runs again
    assert sorted(f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()) == ["0", "1"]
    for f in ("1", ".1.crc"):
        os.remove(f"{checkpoint}/commits/{f}")
    written = os.path.getmtime(f"{out}/batch_id=1/_SUCCESS")
    go_on()
    assert os.path.getmtime(f"{out}/batch_id=1/_SUCCESS") > written
    assert read() == want
    assert runner.running_table(spark, str(tmp_path / "none"), df.schema, keys).count() == 0
