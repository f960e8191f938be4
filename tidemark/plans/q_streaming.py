"""Registered queries: streaming windows, sessions, ingest with geo enrichment (run with
``availableNow`` to completion, then read back from the exactly-once file sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geo, sessions
from ..plans.joins import scoped_setting
from ..session import stream_paths
from ..sources import adapters
from ..sources.tables import Tables
from ..streaming import late, runner, shared, sources, windows


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


def q_stream_host_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sources.with_event_time(sources.web_event_stream(spark, sf_dir))
    out = runner.run_to_completion(spark, windows.tumbling_counts(s, "event_time", ["host"], "host"), "host_hits")
    return out.select(_ntz("window_start"), _ntz("window_end"), "host", "num_hits")


def q_stream_host_referrer_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sources.with_event_time(sources.web_event_stream(spark, sf_dir))
    agg = windows.tumbling_counts(s, "event_time", ["host", "referrer"], "host")
    out = runner.run_to_completion(spark, agg, "host_referrer_hits")
    return out.select(_ntz("window_start"), _ntz("window_end"), "host", "referrer", "num_hits")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sources.with_event_time(sources.web_event_stream(spark, sf_dir))
    # sessions of a key merge in each task before the shuffle: a hot key sends few rows
    with scoped_setting(spark, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"):
        out = runner.run_to_completion(spark, windows.session_counts(s, "event_time", ["ip", "host"]), "sessions")
    return out.select(_ntz("session_start"), _ntz("session_end"), "ip", "host", "n_events")


def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_sessions(spark, sf_dir)


def closed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions that the stream emits, as a batch: a key's events lie in as many tasks as its hours."""
    events = adapters.web_events(Tables(spark, sf_dir))
    last = Tables(spark, sf_dir).events.agg(F.max("ts") - F.expr(f"INTERVAL {windows.WATERMARK}")).first()[0]
    found = sessions.sliced_sessions(events, "event_time", ["ip", "host"], windows.SESSION_GAP)
    return found.where(F.col("session_end") <= F.lit(last))


def q_session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average events per session, per host and over all hosts (rollup)."""
    return closed_sessions(spark, sf_dir).rollup("host").agg(
        F.count(F.lit(1)).alias("n_sessions"),
        (F.sum("n_events").cast("double") / F.count(F.lit(1))).alias("avg_events_per_session"),
        F.max("n_events").alias("max_events"),
    )


def q_sliced_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_sessions(spark, sf_dir)


def q_stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sinks of one reading and one state: hits per (window, host, referrer) and per (window, host).
    All rows of a window close with it, in one batch, so the second is a sum over the batch."""
    s = sources.with_event_time(sources.web_event_stream(spark, sf_dir))
    agg = windows.tumbling_counts(s, "event_time", ["host", "referrer"], "host")
    root, checkpoint = stream_paths(spark, "fan_out")
    per_host = ["window_start", "window_end", "host"]

    def hosts(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*per_host).agg(F.sum("num_hits").alias("num_hits"))

    makers = {"referrers": lambda batch: batch, "hosts": hosts}
    for name, make in makers.items():  # a stream without rows has no batch
        empty = make(spark.createDataFrame([], agg.schema))
        empty.write.parquet(f"{root}/{name}/batch_id=-1")
    writers = {name: runner.folder_writer(f"{root}/{name}", make) for name, make in makers.items()}
    q = shared.start_shared(agg, writers, f"{root}/ledger", checkpoint, available_now=True)
    q.awaitTermination()
    stored = [
        spark.read.parquet(f"{root}/{name}").select(
            F.lit(name).alias("sink"), _ntz("window_start"), _ntz("window_end"), "host",
            (F.col("referrer") if name == "referrers" else F.lit(None).cast("string")).alias("referrer"), "num_hits")
        for name in makers
    ]
    return stored[0].unionByName(stored[1])


ARRIVALS = 3


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive in ``ARRIVALS`` parts by the remainder of their id, so that later parts are late
    nearly throughout: rows and late rows of each part, as stored beside the sink by the listener."""
    events = Tables(spark, sf_dir).events.select("event_id", "ts")
    root, checkpoint = stream_paths(spark, "late_rows")
    listener = late.LateRows(spark, f"{root}/late", "late_rows")
    spark.streams.addListener(listener)
    runs = []
    try:
        for part in range(ARRIVALS):
            events.where(F.pmod("event_id", F.lit(ARRIVALS)) == part).write.parquet(f"{root}/arrived/part={part}")
            stream = spark.readStream.schema("event_id long, ts timestamp_ntz, part int").parquet(f"{root}/arrived")
            timed = sources.with_event_time(stream, "ts").withWatermark("event_time", windows.WATERMARK)
            once = timed.dropDuplicates(["event_id", "event_time"])
            q = runner.start_parquet_sink(once, f"{root}/sink", checkpoint, available_now=True, name="late_rows")
            q.awaitTermination()
            listener.wait(q)
            runs.append((str(q.runId), part))
    finally:
        spark.streams.removeListener(listener)
    kept = spark.read.parquet(f"{root}/sink").groupBy("part").agg(F.count(F.lit(1)).alias("n_kept"))
    parts = spark.createDataFrame(runs, "run_id string, part long")  # ARRIVALS rows
    counted = listener.read().join(parts, "run_id").groupBy("part").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_late").alias("n_late"))
    return counted.where("n_rows > 0").join(kept, "part", "left").select(
        "part", "n_rows", "n_late", F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"))


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON events (as a Kafka value) -> parsed event time -> geo range search, batch by batch -> sink."""
    t = Tables(spark, sf_dir)
    web = sources.web_event_stream(spark, sf_dir)
    raw = web.select(
        "url", "referrer", F.lit(None).cast("string").alias("user_agent"), "host", "ip",
        F.lit(None).cast("string").alias("headers"),
        F.date_format("event_ts", sources.EVENT_TIME_FORMAT).alias("event_time"),
    )
    parsed = sources.parse_raw_events(sources.encode_json(raw))
    known = geo.index(geo.nation_ranges(t.nation, t.region))

    def located(batch: DataFrame) -> DataFrame:
        return geo.enrich(batch, "ip", known).select(
            "ip", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "referrer", "host", "url",
            "country", "state", "city",
        )

    return runner.run_batches_to_completion(spark, parsed, located, "ingest")


def q_geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    ev = adapters.web_events(t).select("event_id", "ip")
    return geo.enrich(ev, "ip", geo.nation_ranges(t.nation, t.region))


QUERIES = {
    "stream_host_hits": q_stream_host_hits,
    "stream_host_referrer_hits": q_stream_host_referrer_hits,
    "stream_sessions": q_stream_sessions,
    "session_stats": q_session_stats,
    "sliced_sessions": q_sliced_sessions,
    "stream_fan_out": q_stream_fan_out,
    "stream_late_rows": q_stream_late_rows,
    "stream_ingest": q_stream_ingest,
    "geo_enrich": q_geo_enrich,
}

WEBS = """
pg AS (SELECT page_id, MIN(url) AS referrer FROM pages GROUP BY 1),
we AS (
  SELECT e.event_id, e.ts, e.event_type AS url, '10.' || CAST(a.n // 65536 AS VARCHAR) || '.' || CAST(a.n // 256 % 256 AS VARCHAR) || '.' || CAST(a.n % 256 AS VARCHAR) AS ip,
         'host_' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS VARCHAR) AS host, pg.referrer
  FROM events e, LATERAL (SELECT e.user_id * 104729 % 1835008 AS n) a
  LEFT JOIN pg ON pg.page_id = e.user_id * 2 + CAST(json_extract_string(e.props, '$.k') AS BIGINT)
),
wm AS (SELECT MAX(ts) - INTERVAL 15 SECOND AS w FROM events)"""

GEO = """
geo AS (
  SELECT 167772160 + 65536 * n.n_nationkey + p.low AS ip_start, 167772160 + 65536 * n.n_nationkey + p.high AS ip_end,
         n.n_name AS country, r.r_name AS state, n.n_name || p.city AS city
  FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey,
       (VALUES (0, 65535, ' City'), (16384, 20479, ' Centre')) AS p(low, high, city)
)"""

IPNUM = ("(CAST(split_part({c}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({c}, '.', 2) AS BIGINT) * 65536 "
         "+ CAST(split_part({c}, '.', 3) AS BIGINT) * 256 + CAST(split_part({c}, '.', 4) AS BIGINT))")

SESSIONS = WEBS + """,
ord AS (SELECT ip, host, ts, LAG(ts) OVER (PARTITION BY ip, host ORDER BY ts) AS prev FROM we),
mark AS (SELECT *, SUM(CASE WHEN prev IS NULL OR ts - prev > INTERVAL 5 MINUTE THEN 1 ELSE 0 END)
                    OVER (PARTITION BY ip, host ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM ord),
sess AS (SELECT ip, host, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end, COUNT(*) AS n_events
         FROM mark GROUP BY ip, host, sid),
closed AS (SELECT * FROM sess WHERE session_end <= (SELECT w FROM wm))"""

ORACLES = {
    "stream_host_hits": f"""WITH {WEBS}
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
         AS window_end, host, COUNT(host) AS num_hits
FROM we GROUP BY 1, 2, 3 HAVING time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= (SELECT w FROM wm)""",
    "stream_host_referrer_hits": f"""WITH {WEBS}
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
         AS window_end, host, referrer, COUNT(host) AS num_hits
FROM we GROUP BY 1, 2, 3, 4 HAVING time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= (SELECT w FROM wm)""",
    "stream_sessions": f"WITH {SESSIONS} SELECT session_start, session_end, ip, host, n_events FROM closed",
    "session_stats": f"""WITH {SESSIONS}
SELECT host, COUNT(*) AS n_sessions, CAST(SUM(n_events) AS DOUBLE) / COUNT(*) AS avg_events_per_session,
       MAX(n_events) AS max_events
FROM closed GROUP BY ROLLUP (host)""",
    "sliced_sessions": f"WITH {SESSIONS} SELECT session_start, session_end, ip, host, n_events FROM closed",
    "stream_fan_out": f"""WITH {WEBS},
hit AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, host, referrer FROM we)
SELECT CASE WHEN GROUPING(referrer) = 1 THEN 'hosts' ELSE 'referrers' END AS sink, window_start,
       window_start + INTERVAL 5 MINUTE AS window_end, host, referrer, COUNT(host) AS num_hits
FROM hit WHERE window_start + INTERVAL 5 MINUTE <= (SELECT w FROM wm)
GROUP BY GROUPING SETS ((window_start, host, referrer), (window_start, host))""",
    "stream_late_rows": """WITH ev AS (SELECT event_id % 3 AS part, event_id, ts FROM events),
top AS (SELECT part, MAX(date_trunc('millisecond', ts)) - INTERVAL 15 SECOND AS w FROM ev GROUP BY part),
mark AS (SELECT e.part, e.event_id, e.ts, (SELECT MAX(t.w) FROM top t WHERE t.part < e.part) AS w FROM ev e)
SELECT part, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE ts <= w) AS n_late,
       COUNT(DISTINCT (event_id, ts)) FILTER (WHERE w IS NULL OR ts > w) AS n_kept
FROM mark GROUP BY part""",
    "stream_ingest": f"""WITH {WEBS}, {GEO}
SELECT we.ip, date_trunc('millisecond', we.ts) AS event_timestamp, we.referrer, we.host, we.url,
       g.country, g.state, g.city
FROM we LEFT JOIN geo g ON {IPNUM.format(c='we.ip')} BETWEEN g.ip_start AND g.ip_end
QUALIFY row_number() OVER (PARTITION BY we.event_id ORDER BY g.ip_start DESC) = 1""",
    "geo_enrich": f"""WITH {WEBS}, {GEO}
SELECT we.event_id, we.ip, g.country, g.state, g.city
FROM we LEFT JOIN geo g ON {IPNUM.format(c='we.ip')} BETWEEN g.ip_start AND g.ip_end
QUALIFY row_number() OVER (PARTITION BY we.event_id ORDER BY g.ip_start DESC) = 1""",
}
