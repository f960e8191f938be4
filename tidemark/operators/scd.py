"""Type-2 slowly changing dimensions: one-pass backfill and one-period increment.

Tracked attributes are compared null-safely, so a change to or from NULL opens a new row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def scd_backfill(
    snapshots: DataFrame,
    keys: Sequence[str],
    time_col: str,
    tracked: Sequence[str],
    as_of: int | None = None,
    start_col: str = "start_season",
    end_col: str = "end_season",
    as_of_col: str = "current_season",
) -> DataFrame:
    """Streaks of unchanged ``tracked`` values between consecutive snapshot rows.

    Plan: one hash exchange on the keys feeds both windows (one sort) and the final
    aggregate, which reuses that distribution. A group holds one entity's snapshots, so its
    size is bounded by the number of periods.
    """
    if as_of is None:
        as_of = snapshots.agg(F.max(time_col)).first()[0]  # one scalar to the driver
    snaps = snapshots.where(F.col(time_col) <= as_of)
    w = Window.partitionBy(*keys).orderBy(time_col)
    is_first = F.lag(F.col(time_col)).over(w).isNull()
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in tracked])
    flagged = snaps.select(*keys, time_col, *tracked, (is_first | changed).cast("int").alias("_chg"))
    streaks = flagged.withColumn(
        "_streak", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # Tracked values are constant (null-safe) within a streak, so they join the grouping key:
    # the aggregate is then min/max of the period only (hash aggregation, no extra sort).
    out = streaks.groupBy(*keys, "_streak", *tracked).agg(
        F.min(time_col).alias(start_col),
        F.max(time_col).alias(end_col),
    )
    return out.drop("_streak").withColumn(as_of_col, F.lit(as_of).cast("int"))


def scd_increment(
    scd: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: int,
    previous: int | None = None,
    time_col: str = "current_season",
    start_col: str = "start_season",
    end_col: str = "end_season",
    as_of_col: str = "current_season",
) -> DataFrame:
    """SCD as of ``previous`` + snapshot at ``as_of`` -> SCD as of ``as_of``.

    Only open rows (end = previous) are compared. Unchanged -> end moves to ``as_of``;
    changed -> old row kept closed and a new [as_of, as_of] row opened; new or returning
    entity -> [as_of, as_of]; entity missing from the snapshot -> its row is kept closed.
    Closed history is passed through untouched (no shuffle). One full join, no 4-way union.
    """
    previous = as_of - 1 if previous is None else previous
    cols = [*keys, *tracked, start_col, end_col]
    closed = scd.where(F.col(end_col) < previous).select(*cols)
    open_rows = scd.where(F.col(end_col) == previous).select(
        *keys, *[F.col(c).alias(f"_o_{c}") for c in tracked], F.col(start_col).alias("_o_start"),
        F.col(end_col).alias("_o_end"),
    )
    snap = snapshot.where(F.col(time_col) == as_of).select(
        *keys, *[F.col(c).alias(f"_s_{c}") for c in tracked], F.lit(True).alias("_s_here")
    )
    j = open_rows.join(snap, list(keys), "full")
    in_open = F.col("_o_start").isNotNull()
    in_snap = F.col("_s_here").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"_o_{c}").eqNullSafe(F.col(f"_s_{c}")) for c in tracked])

    def rec(prefix: str, start, end):
        return F.struct(
            *[F.col(f"{prefix}{c}").alias(c) for c in tracked],
            F.lit(start).cast("int").alias(start_col) if not hasattr(start, "alias") else start.cast("int").alias(start_col),
            F.lit(end).cast("int").alias(end_col) if not hasattr(end, "alias") else end.cast("int").alias(end_col),
        )

    old_end = F.when(in_snap & same, F.lit(as_of)).otherwise(F.col("_o_end"))
    first = F.when(in_open, rec("_o_", F.col("_o_start"), old_end)).otherwise(rec("_s_", F.lit(as_of), F.lit(as_of)))
    second = F.when(in_open & in_snap & ~same, rec("_s_", F.lit(as_of), F.lit(as_of)))
    records = F.filter(F.array(first, second), lambda r: r.isNotNull())
    current = j.select(*keys, F.inline(records))
    return closed.unionByName(current).withColumn(as_of_col, F.lit(as_of).cast("int"))
