"""One reading for several sinks, late rows beside the sink, sessions over slices."""

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators.sessions import sliced_sessions
from tidemark.streaming import late, runner, shared

T0 = dt.datetime(2024, 1, 1)


def _source(spark, n=40):
    root = tempfile.mkdtemp(prefix="tidemark-shared-")
    spark.range(n).select("id", (F.col("id") % 3).alias("k")).coalesce(1).write.parquet(f"{root}/src")
    return root, spark.readStream.schema("id long, k long").parquet(f"{root}/src")


def test_source_is_read_once_and_a_failed_sink_replays_alone(spark):
    root, stream = _source(spark)
    calls = {"all": [], "sums": []}
    broken = [True]

    def everything(batch, batch_id):
        calls["all"].append(batch_id)
        runner.folder_writer(f"{root}/all", lambda b: b)(batch, batch_id)

    def sums(batch, batch_id):
        calls["sums"].append(batch_id)
        if broken[0]:
            raise ValueError("the second sink is down")
        runner.folder_writer(f"{root}/sums", lambda b: b.groupBy("k").agg(F.sum("id").alias("s")))(batch, batch_id)

    sinks = {"sums": sums, "all": everything}  # the failing one first: the other still gets its rows
    q = shared.start_shared(stream, sinks, f"{root}/ledger", f"{root}/ckpt", available_now=True)
    with pytest.raises(Exception, match="second sink|failed in sums"):
        q.awaitTermination()
    assert spark.read.parquet(f"{root}/all").count() == 40 and not os.path.exists(f"{root}/sums")

    broken[0] = False
    q = shared.start_shared(stream, sinks, f"{root}/ledger", f"{root}/ckpt", available_now=True)
    q.awaitTermination()
    assert calls == {"all": [0], "sums": [0, 0]}
    assert sum(p["numInputRows"] for p in q.recentProgress) == 40
    assert sum(r["s"] for r in spark.read.parquet(f"{root}/sums").collect()) == sum(range(40))
    assert [f for f in os.listdir(f"{root}/ledger/sums") if not f.startswith(".")] == ["0"]


def test_both_sinks_share_one_scan(spark):
    root, stream = _source(spark)
    writers = {n: runner.folder_writer(f"{root}/{n}", lambda b: b) for n in ("a", "b")}
    q = shared.start_shared(stream, writers, f"{root}/ledger", f"{root}/ckpt", available_now=True)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 40  # 80 if each sink had read the source
    assert all(spark.read.parquet(f"{root}/{n}").count() == 40 for n in writers)


def test_ledger_keeps_the_last_mark(spark):
    ledger = shared.Ledger(spark, tempfile.mkdtemp(prefix="tidemark-ledger-") + "/sink")
    assert ledger.last() == -1
    for batch_id in (0, 1, 12):
        ledger.add(batch_id)
    assert ledger.last() == 12


def test_late_rows_are_stored_by_batch(spark):
    root = tempfile.mkdtemp(prefix="tidemark-late-")
    listener = late.LateRows(spark, f"{root}/late", "late-test")
    spark.streams.addListener(listener)
    try:
        for part, minutes in enumerate(([0, 10, 20], [1, 2, 30], [29, 31, 40])):
            rows = [(i, T0 + dt.timedelta(minutes=m)) for i, m in enumerate(minutes, 10 * part)]
            spark.createDataFrame(rows, "id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{root}/src/part={part}")
            stream = spark.readStream.schema("id long, ts timestamp_ntz, part int").parquet(f"{root}/src")
            timed = stream.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", "15 seconds")
            q = runner.start_parquet_sink(timed.dropDuplicates(["id", "event_time"]), f"{root}/sink", f"{root}/ckpt",
                                          available_now=True, name="late-test")
            q.awaitTermination()
            listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    stored = listener.read().where("n_rows > 0").orderBy("batch_id").collect()
    assert [(r["n_rows"], r["n_late"]) for r in stored] == [(3, 0), (3, 2), (3, 1)]
    assert spark.read.parquet(f"{root}/sink").count() == 6
    files = [f for f in os.listdir(f"{root}/late") if f.endswith(".json") and not f.startswith(".")]
    assert all(json.load(open(f"{root}/late/{f}"))["name"] == "late-test" for f in files)


def _brute(rows, gap):
    """Sessions of (key, time) rows by a sorted scan."""
    out, by_key = [], {}
    for key, ts in rows:
        if ts is not None:
            by_key.setdefault(key, []).append(ts)
    for key, times in by_key.items():
        times.sort()
        start, last, n = times[0], times[0], 1
        for ts in times[1:]:
            if ts - last > gap:
                out.append((start, last + gap, key, n))
                start, n = ts, 0
            last, n = ts, n + 1
        out.append((start, last + gap, key, n))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_seconds", [60, 600, 86400])
def test_sliced_sessions_equal_a_sorted_scan(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    rows = [("hot", T0 + dt.timedelta(seconds=rng.randrange(0, 40_000))) for _ in range(400)]
    rows += [(rng.choice(["a", "b", None]), T0 + dt.timedelta(seconds=rng.randrange(0, 40_000))) for _ in range(300)]
    rows += [("edge", T0 + dt.timedelta(seconds=300 * i)) for i in range(30)]  # the gap to the second: one session
    rows += [("far", T0), ("far", T0 + dt.timedelta(seconds=300, microseconds=1)), ("none", None), ("hot", rows[0][1])]
    rows += [("old", dt.datetime(1969, 12, 31, 23, 58)), ("old", dt.datetime(1970, 1, 1, 0, 1))]
    events = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = [tuple(r) for r in sliced_sessions(events, "ts", ["k"], slice_seconds=slice_seconds).collect()]
    assert sorted(got, key=str) == _brute(rows, dt.timedelta(minutes=5))
    assert sliced_sessions(events.limit(0), "ts", ["k"]).count() == 0


def test_hot_key_is_spread_over_its_slices(spark):
    """A third of all rows under one key: the events' exchange is by key and slice, and the window by
    key alone gets at most two rows a slice."""
    hours = 48
    hot = spark.range(20_000).select(
        F.lit("hot").alias("k"), (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 8.64)).alias("ts"))
    other = spark.range(40_000).select(
        F.concat(F.lit("k"), F.col("id") % 500).alias("k"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 4.32)).alias("ts"))
    both = hot.unionByName(other)
    found = sliced_sessions(both, "ts", ["k"])
    assert found.where("k = 'hot'").collect()[0]["n_events"] == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_slice" in plan.split("hashpartitioning(k", 1)[1].split("\n", 1)[0]
    per_task = both.repartition(200, "k", F.floor(F.unix_micros("ts") / 3_600_000_000)).where("k = 'hot'").groupBy(
        F.spark_partition_id().alias("task")).count()
    assert per_task.count() > hours // 2
