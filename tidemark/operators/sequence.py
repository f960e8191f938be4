"""Positions and running sums within ordered groups of any size.

A running-sum window over a group puts the group in one task. Here the rows are range partitioned
on (group, order) and written once, each with the number of its partition, so that a group holding
a large share of the rows is spread over many. Windows then run within (partition, group), and one
row of totals per (partition, group) gives each partition's offset. The result is exact, and the
same plan serves every size; a NULL group is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staging_path


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the result has the left frame's keys once."""
    named = right.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_of_{k}" for k in keys])


def ranged(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` range partitioned on ``keys``, with its partition's number ``_pid``, written to the
    shared staging folder and read back, so that the numbers stay as they are."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = staging_path(spark, "ranged")
    df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, partitions: int | None = None
) -> DataFrame:
    """``df`` with ``position`` (1-based within the group) and ``running`` (sum of ``value`` up to and
    including the row). ``order`` must be a total order within the group; ``value`` is an integral
    column (NULL counts as 0)."""
    group, order = list(group), list(order)
    amount = F.coalesce(F.col(value), F.lit(0)).cast("long")
    rows = ranged(df.withColumn(value, amount), [*group, *order], partitions)
    own = ["_pid", *group]
    within = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select("*", F.count(F.lit(1)).over(within).alias("_position"), F.sum(value).over(within).alias("_running"))
    totals = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *own,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_sum_before"),
    )
    return null_safe_join(local, offsets, own).select(
        *df.columns,
        (F.col("_rows_before") + F.col("_position")).alias("position"),
        (F.col("_sum_before") + F.col("_running")).alias("running"),
    )
