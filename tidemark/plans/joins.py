"""Join strategy helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType


#: Bytes of rows in memory up to which one side of a join may be broadcast.
BROADCAST_BYTES = 32 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its rows take ``max_bytes`` in memory at most, else join it by sort-merge."""
    return F.broadcast(df) if _fits(df, max_bytes) else df.hint("merge")


def bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` for a join that the planner picks, but by sort-merge if its rows take more than ``max_bytes``."""
    return df if _fits(df, max_bytes) else df.hint("merge")


def _fits(df: DataFrame, max_bytes: int) -> bool:
    """Whether the rows of ``df`` take ``max_bytes`` at most. The optimizer's estimate (no job) rules out
    what is large in files already. It is of compressed files, and all that the planner holds against its
    threshold: a few MB of Parquet may be millions of rows, which the driver would collect and hash. So
    what passes is counted."""
    return estimated_bytes(df) <= max_bytes and row_bytes(df) <= max_bytes


def row_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df`` as Spark holds them in memory, from one job that counts the rows and the
    bytes of their texts: 8 for the nulls of 64 columns, 8 for each column, and what a text takes besides.
    Nested columns count as their text."""
    df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # names may repeat
    texts = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType)) or not isinstance(f.dataType, AtomicType)]
    held = [F.coalesce(F.sum(F.ceil(F.octet_length(F.col(c).cast("string")) / 8) * 8), F.lit(0)) for c in texts]
    n, *long = df.agg(F.count(F.lit(1)), *held).first()
    return n * 8 * (-(-len(df.columns) // 64) + len(df.columns)) + sum(long)


@contextlib.contextmanager
def scoped_setting(spark: SparkSession, key: str, value: str):
    """One session setting for a block; it is read when a plan is executed, so run the action inside."""
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old)


#: Shuffled and scanned bytes to a task of ``in_small_tasks``.
SHUFFLED, SCANNED = 16 << 20, 16 << 20


def in_small_tasks(source: DataFrame, make: Callable[[], DataFrame], path: str) -> DataFrame:
    """What ``make`` gives, written to ``path`` by tasks of few rows, however large ``source`` is: there are
    as many shuffle partitions as its bytes want, so that the memory of a task's sorts and hash tables
    does not follow the size of the input."""
    spark = source.sparkSession
    key = "spark.sql.shuffle.partitions"
    n = max(int(spark.conf.get(key)), -(-estimated_bytes(source) // SHUFFLED))
    with (
        scoped_setting(spark, key, str(n)),
        scoped_setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLED)),
        scoped_setting(spark, "spark.sql.files.maxPartitionBytes", str(SCANNED)),
    ):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def broadcast_threshold(spark: SparkSession, value: str):
    """Scope ``spark.sql.autoBroadcastJoinThreshold`` (e.g. "-1" to show sort-merge plans)."""
    return scoped_setting(spark, "spark.sql.autoBroadcastJoinThreshold", value)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size, from its plan's statistics (no job runs)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
