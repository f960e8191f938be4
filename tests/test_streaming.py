"""Streaming: watermark drops late rows, restart from checkpoint adds no duplicates, and the
stream equals the batch form on closed windows."""

import datetime as dt
import os
import tempfile
import time

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.streaming import runner, windows

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _write(folder, name, minutes, host="h"):
    ts = [T0 + dt.timedelta(minutes=m) for m in minutes]
    table = pa.table({"ts": pa.array(ts, pa.timestamp("us")), "host": pa.array([host] * len(ts))})
    pq.write_table(table, os.path.join(folder, name))
    time.sleep(1.1)  # distinct modification times keep the file order


def _run(spark, src, sink, ckpt):
    stream = (
        spark.readStream.schema("ts timestamp_ntz, host string").option("maxFilesPerTrigger", 1).parquet(src)
        .withColumn("event_time", F.col("ts").cast("timestamp"))
    )
    q = runner.start_parquet_sink(windows.tumbling_counts(stream, "event_time", ["host"], "host"), sink, ckpt,
                                  available_now=True)
    q.awaitTermination()
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", [])
    )
    return dropped


def test_late_rows_dropped_and_restart_is_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="tidemark-stream-")
    src, sink, ckpt = (os.path.join(root, x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    _write(src, "f1.parquet", range(0, 21))          # 00:00 .. 00:20
    _write(src, "f2.parquet", [25])                  # advances the watermark
    # The late-row filter of batch n uses the watermark of batch n-2 (Spark's multi-operator
    # rule), so the late row comes one batch later: 00:01 is behind 00:19:45 by then.
    _write(src, "f3.parquet", [1, 30])
    dropped = _run(spark, src, sink, ckpt)
    out = spark.read.parquet(sink)
    first = out.where(F.col("window_start").cast("timestamp_ntz") == F.lit(T0)).first()
    assert first["num_hits"] == 5  # 00:00..00:04 only; the late 00:01 row is not counted
    assert dropped >= 1
    n_before = out.count()

    _write(src, "f4.parquet", [41, 50])              # restart: only new windows are added
    _run(spark, src, sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() > n_before
    assert out.groupBy("window_start", "host").count().where("count > 1").count() == 0


def test_stream_equals_batch_on_closed_windows(spark):
    root = tempfile.mkdtemp(prefix="tidemark-stream-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    _write(src, "f1.parquet", [0, 1, 2, 7, 8, 13, 26, 27, 44])
    streamed = runner.run_to_completion(
        spark,
        windows.tumbling_counts(
            spark.readStream.schema("ts timestamp_ntz, host string").parquet(src)
            .withColumn("event_time", F.col("ts").cast("timestamp")), "event_time", ["host"], "host"),
        "test-closed",
    )
    batch = spark.read.parquet(src).withColumn("event_time", F.col("ts").cast("timestamp"))
    max_ts = batch.agg(F.max("event_time")).first()[0]
    expected = (
        batch.groupBy(F.window("event_time", "5 minutes"), "host").agg(F.count("host").alias("num_hits"))
        .where(F.col("window.end") <= F.lit(max_ts - dt.timedelta(seconds=15)))
        .select(F.col("window.start").alias("window_start"), "num_hits")
    )
    got = streamed.select("window_start", "num_hits")
    assert sorted(got.collect()) == sorted(expected.collect())


def test_session_windows_merge_within_gap(spark):
    root = tempfile.mkdtemp(prefix="tidemark-stream-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    _write(src, "f1.parquet", [0, 3, 8, 20, 40])  # 0-3-8 chain (gaps <= 5), 20 alone, 40 open
    out = runner.run_to_completion(
        spark,
        windows.session_counts(
            spark.readStream.schema("ts timestamp_ntz, host string").parquet(src)
            .withColumn("event_time", F.col("ts").cast("timestamp")), "event_time", ["host"]),
        "test-sessions",
    )
    counts = sorted(r["n_events"] for r in out.collect())
    assert counts == [1, 3]  # the session starting at 40 is still open (not emitted)


def test_fan_out_two_sinks_from_one_source(spark):
    root = tempfile.mkdtemp(prefix="tidemark-stream-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    _write(src, "f1.parquet", [0, 1, 6, 12, 30])
    stream = (
        spark.readStream.schema("ts timestamp_ntz, host string").parquet(src)
        .withColumn("event_time", F.col("ts").cast("timestamp"))
    )
    per_host = windows.tumbling_counts(stream, "event_time", ["host"], "host")
    sessions = windows.session_counts(stream, "event_time", ["host"])
    qs = runner.fan_out({
        "fan_hosts": (per_host, os.path.join(root, "s1"), os.path.join(root, "c1")),
        "fan_sessions": (sessions, os.path.join(root, "s2"), os.path.join(root, "c2")),
    }, processing_time="1 second")
    try:
        for q in qs:
            q.processAllAvailable()
        read = [sum(p["numInputRows"] for p in q.recentProgress) for q in qs]
    finally:
        for q in qs:
            q.stop()
    assert read == [5, 5]  # each query read the whole source once, with its own offsets
    assert os.path.isdir(os.path.join(root, "c1", "offsets")) and os.path.isdir(os.path.join(root, "c2", "offsets"))


def test_foreach_batch_sink_is_idempotent_per_batch(spark):
    root = tempfile.mkdtemp(prefix="tidemark-stream-")
    src, out, ckpt = (os.path.join(root, x) for x in ("src", "out", "ckpt"))
    os.makedirs(src)
    _write(src, "f1.parquet", [0, 1, 2])
    _write(src, "f2.parquet", [3, 4])

    def write_batch(batch, batch_id):
        # one folder per batch id, overwritten: a replayed batch replaces its own output
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    stream = spark.readStream.schema("ts timestamp_ntz, host string").option("maxFilesPerTrigger", 1).parquet(src)
    q = runner.start_batch_sink(stream, write_batch, ckpt, available_now=True)
    q.awaitTermination()
    write_batch(spark.read.parquet(os.path.join(src, "f1.parquet")), 0)  # a replay of batch 0 (file f1)
    result = spark.read.parquet(out)
    assert result.count() == 5
    assert {r["batch_id"] for r in result.select("batch_id").distinct().collect()} == {0, 1}


def test_datelist_map_per_browser(spark):
    import datetime as dt

    from tidemark.operators.activity import datelist_map

    rows = spark.createDataFrame(
        [(1, "chrome", [dt.date(2024, 1, 1)]), (1, "safari", [dt.date(2024, 1, 2), dt.date(2024, 1, 3)])],
        "user_id long, browser_type string, dates_active array<date>",
    )
    m = datelist_map(rows, "user_id", "browser_type").first()["browser_type_dates_active"]
    assert m == {"chrome": [dt.date(2024, 1, 1)], "safari": [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]}


def test_event_stream_reads_a_file_and_a_folder(spark):
    """A table that is one file and the same rows as a folder of part files give the same stream."""
    from tidemark.streaming.sources import events_file_stream

    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    single = tempfile.mkdtemp(prefix="tidemark-one-")
    pq.write_table(pq.read_table("/root/testdata/sf0.001/events.parquet"), f"{single}/events.parquet")
    folder = tempfile.mkdtemp(prefix="tidemark-many-")
    rows.repartition(5).write.parquet(f"{folder}/events.parquet")
    for sf_dir in (single, folder):
        out = runner.run_to_completion(spark, events_file_stream(spark, sf_dir), "events")
        assert out.count() == rows.count() == 1000
