"""Streaming sources, sinks and query control (SRC2-SRC4, SNK1, STR10-STR15).

Kafka is an external package: every source and sink takes a ``fmt`` so that
files stand in for topics in tests and ``kafka`` is used on a cluster.  All
checkpoint and output folders live under the session's shared checkpoint
folder (``spark.checkpoint.dir``), never a machine-local temp folder.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tessera.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, *parts])


def _is_file(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, local or remote."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def _holds_files(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, local or remote."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def read_stream(spark: SparkSession, path: str | None = None, schema=None, fmt: str = "parquet",
                options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC2: streaming scan.  ``fmt='kafka'`` yields (key, value, topic, partition,
    offset, timestamp); file formats need an explicit schema (no inference)."""
    r = spark.readStream.format(fmt)
    if path and fmt != "kafka" and _is_file(spark, path):
        # a file stream watches a folder; a single file becomes folder + name filter
        path, name = path.rstrip("/").rsplit("/", 1)
        r = r.option("pathGlobFilter", name)
    if schema is not None and fmt != "kafka":
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path) if path else r.load()


def read_topic_batch(spark: SparkSession, options: dict, fmt: str = "kafka") -> DataFrame:
    """SRC3: bounded read of a topic from the earliest offset."""
    opts = {"startingOffsets": "earliest", **options}
    return spark.read.format(fmt).options(**opts).load()


def json_values(df: DataFrame) -> DataFrame:
    """SNK1 payload: one JSON ``value`` per row (what a Kafka sink expects)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def start(df: DataFrame, name: str, output_mode: str = "append", fmt: str = "parquet",
          path: str | None = None, options: dict | None = None, available_now: bool = True,
          processing_time: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """SNK1 / STR11: start one query with its own checkpoint folder."""
    spark = df.sparkSession
    run = uuid.uuid4().hex[:12]
    checkpoint = checkpoint or shared_path(spark, "streams", name, run, "_checkpoint")
    w = df.writeStream.queryName(f"{name}_{run}").outputMode(output_mode).format(fmt)
    w = w.option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if fmt in ("parquet", "json", "csv", "orc", "text"):
        path = path or shared_path(spark, "streams", name, run, "out")
        q = w.start(path)
        OUTPUTS[q.id] = path
        return q
    return w.start()


OUTPUTS: dict[str, str] = {}


def output_path(q: StreamingQuery) -> str:
    """Folder a file-sink query writes to."""
    return OUTPUTS[q.id]


def run_to_table(df: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Run a streaming plan to completion (``availableNow``) into Parquet in the
    shared folder and return the written rows as a batch DataFrame."""
    q = start(df, name, output_mode, "parquet")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return df.sparkSession.read.schema(df.schema).parquet(output_path(q))


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """STR10: wait until every query ends (``availableNow``) or ``timeout_s`` seconds have
    passed in all, then stop what still runs."""
    end = time.monotonic() + timeout_s if timeout_s else None
    for q in queries:
        if end is None:
            q.awaitTermination()
        elif (left := end - time.monotonic()) > 0:
            q.awaitTermination(left)
    for q in queries:
        if q.isActive:
            q.stop()


def _offset_lag(latest, end) -> int | None:
    """Latest minus end offset, summed over partitions of a topic; for a file source, files listed
    but not read.  None where the source reports no latest offset."""
    def parsed(o):
        if isinstance(o, str):
            try:
                return json.loads(o)
            except ValueError:
                return None
        return o
    latest, end = parsed(latest), parsed(end)
    if not isinstance(latest, dict) or not isinstance(end, dict):
        return None
    if set(latest) == {"logOffset"}:
        return max(0, int(latest["logOffset"]) - int(end.get("logOffset", -1)))
    return sum(max(0, int(v) - int((end.get(t) or {}).get(p, 0))) for t, ps in latest.items() for p, v in ps.items())


def progress_table(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """STR15: per query (name without the run's suffix), summed over its micro-batches: batches
    with rows, input rows, seconds; and the lag after the last one (latest minus end offset;
    0 where the source was read to its end)."""
    rows = []
    for q in queries:
        progress = list(q.recentProgress)
        sources = [s for p in progress for s in p["sources"]]
        n = sum(int(s["numInputRows"] or 0) for s in sources)
        busy = [p for p in progress if sum(int(s["numInputRows"] or 0) for s in p["sources"])]
        seconds = sum(int(p["batchDuration"] or 0) for p in progress) / 1000
        lags = [_offset_lag(s["latestOffset"], s["endOffset"]) for s in (progress[-1]["sources"] if progress else [])]
        lag = sum(x or 0 for x in lags)
        rows.append((q.name.rsplit("_", 1)[0], len(busy), n, float(seconds), int(lag)))
    return spark.createDataFrame(rows, "query STRING, busy_batches BIGINT, input_rows BIGINT, seconds DOUBLE, lag BIGINT")


def drain_to_files(spark: SparkSession, source: DataFrame, name: str, fmt: str = "json") -> str:
    """SRC4: copy everything currently in a stream to files (``availableNow``); returns the folder."""
    out = shared_path(spark, "drain", name, uuid.uuid4().hex[:12])
    q = start(source, name, "append", fmt, path=out)
    q.awaitTermination()
    return out


def bounded_drain(spark: SparkSession, folder: str, schema, name: str, files_per_trigger: int, fmt: str = "parquet",
                  out: str | None = None, checkpoint: str | None = None) -> tuple[str, DataFrame]:
    """SRC4 / STR15: copy a folder's backlog in micro-batches of at most ``files_per_trigger`` files.

    Returns the output folder and one row per micro-batch with rows: ``batch_id``, ``input_rows``
    and ``lag``, the rows of the backlog not yet read after it.  The backlog is what lies in the
    folder at the call less what ``out`` holds; given the same ``out`` and ``checkpoint``, a later
    call goes on where the last one stopped.  Files that come during the call wait for the next
    (a file that comes between the count and the start is read, and the lag stops at 0).  An empty
    backlog gives no rows.  The folder may be a pattern; files go by age."""
    run = uuid.uuid4().hex[:12]
    out = out or shared_path(spark, "drain", name, run, "out")
    checkpoint = checkpoint or shared_path(spark, "drain", name, run, "_checkpoint")
    done = spark.read.schema(schema).parquet(out).count() if _holds_files(spark, checkpoint) and _holds_files(spark, out) else 0
    files = spark.read.format(fmt).schema(schema).load(folder)
    backlog = files.count() - done
    # Spark keeps the progress of the last 100 micro-batches unless told to keep more.
    key = "spark.sql.streaming.numRecentProgressUpdates"
    kept = spark.conf.get(key)
    spark.conf.set(key, str(max(int(kept), 2 * len(files.inputFiles()) + 10)))
    try:
        q = start(read_stream(spark, folder, schema, fmt, max_files_per_trigger=files_per_trigger), name, path=out, checkpoint=checkpoint)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        rows = {p["batchId"]: sum(int(s["numInputRows"] or 0) for s in p["sources"]) for p in q.recentProgress}
    finally:
        spark.conf.set(key, kept)
    table = []
    for batch_id, n in sorted(rows.items()):
        if n:
            backlog -= n
            table.append((batch_id, n, max(0, backlog)))
    return out, spark.createDataFrame(table, "batch_id BIGINT, input_rows BIGINT, lag BIGINT")


def running_table(spark: SparkSession, out: str, schema, keys: list[str]) -> DataFrame:
    """STR1: current row of each key of an update-mode change log, open windows included; empty
    where no batch has been written.  ``schema`` is that of the running aggregate."""
    if not _holds_files(spark, out):
        return spark.createDataFrame([], schema)
    changes = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(out)
    return latest(changes, keys, [c for c in schema.names if c not in keys]).select(*schema.names)


def start_split_sink(df: DataFrame, name: str, route, outputs: dict[str, str]) -> StreamingQuery:
    """STR12 / SNK2: one micro-batch stream written to several outputs.

    ``route(batch_df) -> {output_name: DataFrame}`` splits each micro-batch
    (e.g. valid rows / dead-letter rows).  Each part goes to its own
    ``batch_id=N`` folder with overwrite, so a micro-batch replayed after a
    failure rewrites the same folder: the outputs stay exactly-once."""
    spark = df.sparkSession
    run = uuid.uuid4().hex[:12]

    def write(batch, batch_id):
        batch.persist()  # each output reads it once more
        try:
            for key, part in route(batch).items():
                part.write.mode("overwrite").parquet(f"{outputs[key]}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    q = (df.writeStream.queryName(f"{name}_{run}").foreachBatch(write)
           .option("checkpointLocation", shared_path(spark, "streams", name, run, "_checkpoint"))
           .trigger(availableNow=True).start())
    return q


def run_update_counts(df: DataFrame, name: str, out: str, checkpoint: str | None = None) -> StreamingQuery:
    """STR13 / STR1: running aggregates in update mode; every micro-batch
    writes the keys whose value changed into its own ``batch_id=N`` folder
    (overwrite, so a replayed batch is idempotent).  ``latest(...)`` or
    ``running_table(...)`` reads the current table back.  For windows, the
    watermark of ``df`` bounds the state: a window behind it changes no more."""
    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    spark = df.sparkSession
    run = uuid.uuid4().hex[:12]
    return (df.writeStream.queryName(f"{name}_{run}").outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint or shared_path(spark, "streams", name, run, "_checkpoint"))
              .trigger(availableNow=True).start())


def latest(changes: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Current value per key from an update change log (largest batch id wins;
    a partial aggregate, no window over a key)."""
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("__v"))
    return last.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in cols])
