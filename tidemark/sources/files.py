"""File sources and sinks: CSV with header, re-runnable partition writes, insert by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema=None, infer: bool = False) -> DataFrame:
    """CSV with a header row. Pass an explicit schema in production; inference is a full
    extra pass over the data and is meant for exploration."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_csv_text(spark: SparkSession, path: str, ts_col: str, day_col: str = "event_date") -> DataFrame:
    """All-string CSV (no inference) plus a day column derived from a timestamp text column;
    unparsable text gives NULL rather than failing the job."""
    from pyspark.sql import functions as F

    df = spark.read.option("header", True).csv(path)
    return df.withColumn(day_col, F.to_date(F.try_to_timestamp(F.col(ts_col))))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Append-or-replace the partitions present in ``df`` (dynamic partition overwrite), so a
    re-run of one as-of date replaces that date instead of appending it twice."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def insert_into(df: DataFrame, table: str, overwrite: bool = True) -> None:
    """``insertInto`` is positional: select the target's columns by name first."""
    target_cols = df.sparkSession.table(table).columns
    df.select(*target_cols).write.insertInto(table, overwrite=overwrite)
