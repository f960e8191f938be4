"""Stream sources: a file stream over the driver's events table, and a Kafka JSON source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import adapters
from ..sources.tables import Tables

# Fixed value: the raw event-time text format of the stream.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

RAW_EVENT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("url", "referrer", "user_agent", "host", "ip", "headers", "event_time")]
)


def events_file_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the ``events.parquet`` table; new files in its folder arrive as new batches.

    A table of several files is a folder, and is read as one. A table that is a single file is read
    by its folder and name, as the file source takes folders only."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path) if is_folder else reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def web_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events as a stream: the batch adapter's derivation on the streaming events, and a
    stream-static join with the whole page dimension."""
    ev = events_file_stream(spark, sf_dir).select(
        "event_id", "user_id", F.col("ts").alias("event_ts"), F.col("event_type").alias("url"), "props")
    ev = adapters.with_web_keys(ev)
    return ev.join(adapters.page_urls(Tables(spark, sf_dir)), "page_id", "left").drop("page_id")


def with_event_time(df: DataFrame, ts_col: str = "event_ts", out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (with local time zone); the tables hold TIMESTAMP_NTZ."""
    return df.withColumn(out, F.col(ts_col).cast("timestamp"))


def encode_json(df: DataFrame) -> DataFrame:
    """Kafka value encoder: every column as one JSON object in ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def kafka_source(spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None) -> DataFrame:
    """Kafka topic as a stream (needs the Kafka connector on the cluster; security options,
    e.g. SASL, are passed through ``options``)."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    r = r.option("startingOffsets", "latest")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def parse_raw_events(values: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON values -> typed raw events; malformed event times become NULL (not a failure)."""
    parsed = values.select(F.from_json(F.col(value_col).cast("string"), RAW_EVENT_SCHEMA).alias("e")).select("e.*")
    return parsed.withColumn("event_timestamp", F.try_to_timestamp(F.col("event_time"), F.lit(EVENT_TIME_FORMAT)))
