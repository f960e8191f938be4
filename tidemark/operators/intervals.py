"""Point-in-range search by predecessor: no range is exploded, and no theta join is planned.

Ranges become change points: wherever a range starts or ends, the range that holds from there on (the
one that started last; of those, the one that ends first), or none. Nested and overlapping ranges
give one owner at each point. A probe's answer is its predecessor among the change points.

Both steps range partition their rows on the position. The sweep over the ranges runs partition by
partition with the ranges that are open at its border (found by each range's own first and last
partition); the predecessor is a window within the partition, and the last change point of the
partitions before is carried over, one row a partition. Positions are of any type that sorts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staging_path
from .sequence import ranged

# Order of the rows at one position: a range that starts there holds the probe, one that ends there, too.
STARTS, PROBES, ENDS = 0, 1, 2


def numbered(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """The ranges (NULL borders and start > end are none) with a number ``_rid``, written once."""
    path = staging_path(ranges.sparkSession, "ranges")
    kept = ranges.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    kept.withColumn("_rid", F.monotonically_increasing_id()).write.parquet(path)
    return ranges.sparkSession.read.parquet(path)


def change_points(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """(at, after, rid) of numbered ranges: from (at, after) on, range ``rid`` holds, or none (NULL)."""
    bare = ranges.select(F.col("_rid").alias("rid"), F.col(start).alias("low"), F.col(end).alias("high"))
    borders = bare.withColumn("at", F.col("low")).withColumn("after", F.lit(STARTS)).unionAll(
        bare.withColumn("at", F.col("high")).withColumn("after", F.lit(ENDS)))
    rows = ranged(borders, ["at", "after"])
    spread = rows.groupBy("rid", "low", "high").agg(F.min("_pid").alias("first"), F.max("_pid").alias("last"))
    carried = spread.where(F.col("last") > F.col("first")).select(
        "rid", "low", "high", F.col("low").alias("at"), F.lit(-1).alias("after"),
        F.explode(F.sequence(F.col("first") + 1, F.col("last"))).alias("_pid"))
    kind = bare.schema["low"].dataType.simpleString()
    return rows.unionByName(carried).groupBy("_pid").applyInPandas(_sweep, f"at {kind}, after int, rid long")


def _sweep(rows: pd.DataFrame) -> pd.DataFrame:
    """The change points of a partition's borders; ``after`` = -1: open before its first one."""
    carried = rows[rows["after"] < 0].sort_values(["low", "high", "rid"], ascending=[True, False, False])
    own = rows[rows["after"] >= 0].sort_values(["at", "after", "high", "rid"], ascending=[True, True, False, False])
    open_ranges, ended = carried["rid"].tolist(), set()
    out: list[tuple] = []
    for at, after, rid in zip(own["at"].tolist(), own["after"].tolist(), own["rid"].tolist()):
        if after == STARTS:
            open_ranges.append(rid)
        else:
            ended.add(rid)
        while open_ranges and open_ranges[-1] in ended:
            ended.remove(open_ranges.pop())
        point = (at, after, open_ranges[-1] if open_ranges else None)
        if out and out[-1][:2] == point[:2]:
            out[-1] = point
        else:
            out.append(point)
    return pd.DataFrame({"at": [x[0] for x in out], "after": pd.array([x[1] for x in out], "int32"),
                         "rid": pd.array([x[2] for x in out], "Int64")})


def predecessors(probes: DataFrame, points: DataFrame) -> DataFrame:
    """(at, rid) of the distinct positions ``probes`` (one column): the range that holds there, if any."""
    none = F.lit(None).cast("struct<rid: bigint>")
    both = points.select("at", "after", F.struct("rid").alias("point")).unionAll(
        probes.toDF("at").select("at", F.lit(PROBES).alias("after"), none.alias("point")))
    rows = ranged(both, ["at", "after"])
    so_far = Window.partitionBy("_pid").orderBy("at", "after").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select("*", F.last("point", ignorenulls=True).over(so_far).alias("here"))
    last = rows.groupBy("_pid").agg(F.max_by("point", F.when(F.col("point").isNotNull(), F.struct("at", "after"))).alias("point"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    carried = last.select("_pid", F.last("point", ignorenulls=True).over(before).alias("carried"))
    return local.where(F.col("after") == PROBES).join(carried, "_pid").select(
        "at", F.coalesce("here", "carried")["rid"].alias("rid"))


class RangeIndex:
    """Ranges made ready once for any number of searches, e.g. of a stream's micro-batches."""

    def __init__(self, ranges: DataFrame, start: str, end: str):
        self.owners = [c for c in ranges.columns if c not in (start, end)]
        self.ranges = numbered(ranges, start, end)
        path = staging_path(ranges.sparkSession, "change-points")
        change_points(self.ranges, start, end).write.parquet(path)
        self.points = ranges.sparkSession.read.parquet(path)

    def attach(self, df: DataFrame, position: str) -> DataFrame:
        """``df`` with the columns of the range that holds ``position`` (NULL where none does). Distinct
        positions are searched, so a frequent one is searched once."""
        found = predecessors(df.select(position).where(F.col(position).isNotNull()).distinct(), self.points)
        owned = found.join(self.ranges.select(F.col("_rid").alias("rid"), *self.owners), "rid").drop("rid")
        return df.join(owned.withColumnRenamed("at", "_at"), F.col(position) == F.col("_at"), "left").drop("_at")
