import datetime as dt
import os
import tempfile


from tessera.sources import sinks
from tessera.streaming import runner


def test_retention_drops_old_days_and_trims_boundary(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(hours=6 * i)) for i in range(16)]   # 4 days, 4 rows each
    df = spark.createDataFrame(rows, "id LONG, ts TIMESTAMP")
    path = tempfile.mkdtemp(dir="/tmp") + "/t"
    sinks.append_partitioned_by_date(df, path)
    sinks.apply_retention(spark.read.parquet(path), path, "ts", "2024-01-02 12:00:00")
    kept = spark.read.parquet(path)
    assert sorted(r["id"] for r in kept.collect()) == list(range(6, 16))
    days = sorted(d for d in os.listdir(path) if d.startswith("date="))
    assert days == ["date=2024-01-02", "date=2024-01-03", "date=2024-01-04"]


def test_append_unique_refuses_duplicates(spark):
    import pytest
    path = tempfile.mkdtemp(dir="/tmp") + "/pk"
    sinks.replace_table(spark.createDataFrame([(1,), (2,)], "k LONG"), path)
    with pytest.raises(ValueError):
        sinks.append_unique(spark.createDataFrame([(2,), (3,)], "k LONG"), path, ["k"], existing=spark.read.parquet(path))
    sinks.append_unique(spark.createDataFrame([(3,)], "k LONG"), path, ["k"], existing=spark.read.parquet(path))
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_preview_head_tail(spark):
    p = sinks.preview(spark.range(100).orderBy("id")).collect()
    assert [r["position"] for r in p] == [0, 1, 2, 3, 4, 5, 97, 98, 99]
    assert [r["id"] for r in p][-1] == 99 and p[0]["total_rows"] == 100
    assert len(sinks.preview(spark.range(5)).collect()) == 5


def test_stream_restarts_from_checkpoint(spark):
    folder = tempfile.mkdtemp(dir="/tmp")
    schema = "id LONG"
    spark.createDataFrame([(i,) for i in range(5)], schema).write.parquet(folder + "/a")
    ck = runner.shared_path(spark, "tests", "restart", os.path.basename(folder), "_checkpoint")
    out = tempfile.mkdtemp(dir="/tmp") + "/out"
    src = lambda: spark.readStream.schema(schema).parquet(folder + "/*")
    q = runner.start(src(), "restart", path=out, checkpoint=ck)
    q.awaitTermination()
    spark.createDataFrame([(i,) for i in range(5, 8)], schema).write.parquet(folder + "/b")
    q2 = runner.start(src(), "restart", path=out, checkpoint=ck)
    q2.awaitTermination()
    assert q2.recentProgress[0]["numInputRows"] == 3          # only the new file
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(8))


def test_keep_if_and_spread(spark):
    from tessera.operators.quality import keep_if
    from tessera.sources.tables import spread
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id INT, ok BOOLEAN")
    assert [r["id"] for r in keep_if(df, "ok").collect()] == [1]
    assert spread(spark.range(10).coalesce(1), 6).rdd.getNumPartitions() == 6
    big = spark.range(0, 100, 1, 64)
    assert spread(big, None).rdd.getNumPartitions() == 64
