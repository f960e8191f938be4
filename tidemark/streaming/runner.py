"""Running streaming queries: checkpointed, restartable, exactly-once file or batch sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import stream_paths

DEFAULT_TRIGGER = "10 seconds"  # the reference checkpointed every 10 ms in one job (D18)


def start_parquet_sink(
    df: DataFrame, sink: str, checkpoint: str, mode: str = "append", available_now: bool = False,
    processing_time: str = DEFAULT_TRIGGER, name: str | None = None,
) -> StreamingQuery:
    """File sink: its commit log makes output exactly-once across restarts from ``checkpoint``."""
    w = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def start_batch_sink(
    df: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    available_now: bool = False, processing_time: str = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """``foreachBatch`` sink (JDBC and other batch writers). ``write_batch(df, batch_id)`` must
    be idempotent per batch id: a batch is re-run after a failure before its commit."""
    w = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).outputMode(mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def run_to_completion(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything available (``availableNow``), then return the sink as a batch frame.
    Failures propagate (the reference printed and swallowed them, D19)."""
    sink, ckpt = stream_paths(spark, name)
    q = start_parquet_sink(df, sink, ckpt, mode=mode, available_now=True, name=None)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return spark.read.schema(df.schema).parquet(sink)


def folder_writer(path: str, transform: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Batch writer for a transformation that streams cannot run themselves (range partitioning,
    windows): each micro-batch has a folder of its own, which a replay overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_batches_to_completion(
    spark: SparkSession, df: DataFrame, transform: Callable[[DataFrame], DataFrame], name: str
) -> DataFrame:
    """Process everything available batch by batch through ``transform``, then return all batches."""
    sink, ckpt = stream_paths(spark, name)
    schema = transform(spark.createDataFrame([], df.schema)).schema
    spark.createDataFrame([], schema).write.parquet(f"{sink}/batch_id=-1")  # a stream without rows has no batch
    q = start_batch_sink(df, folder_writer(sink, transform), ckpt, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return spark.read.schema(schema).parquet(sink).select(*schema.names)


def jdbc_writer(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """Batch writer for a JDBC table; credentials come from the caller. Rows carry the batch id,
    and a batch first deletes the rows of its own id, so that one replayed after a failure is
    stored once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        jvm = batch.sparkSession._jvm
        settings = jvm.java.util.Properties()
        for key, value in properties.items():
            settings.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            if connection.getMetaData().getTables(None, None, table, None).next():  # else this is the first batch
                statement = connection.prepareStatement(f"DELETE FROM {table} WHERE batch_id = ?")
                statement.setLong(1, batch_id)
                statement.executeUpdate()
        finally:
            connection.close()
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.jdbc(url, table, mode="append", properties=properties)

    return write


def fan_out(queries: dict[str, tuple[DataFrame, str, str]], processing_time: str = DEFAULT_TRIGGER) -> list[StreamingQuery]:
    """One source, several sinks: an independent query (own checkpoint) per sink, as
    ``{name: (aggregated_stream, sink_path, checkpoint_path)}``. Each query keeps its own
    offsets and state, so one sink failing or lagging does not block the others."""
    return [
        start_parquet_sink(df, sink, ckpt, processing_time=processing_time, name=name)
        for name, (df, sink, ckpt) in queries.items()
    ]


def start_kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str,
                     options: dict[str, str] | None = None) -> StreamingQuery:
    """Kafka sink for a frame with a ``value`` column (see ``sources.encode_json``)."""
    w = (
        df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start()
