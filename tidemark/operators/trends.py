"""Rolling trends, best N-row stretch, longest streak (windows over pre-aggregated rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import null_safe_join, running_totals


def rolling_counts(
    daily: DataFrame, group: Sequence[str], date_col: str, count_col: str, min_total: int | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Trend smoothing on one row per (group, day).

    month_total (whole month), running_total (default RANGE frame), total (whole group),
    weekly_rolling_count (rows -6..0), previous_week_count (rows -13..-7: the reference's
    -13..-6 overlapped the current week by one row), pct_of_month, pct_of_total. With ``calendar``
    both weekly frames count days instead of rows, so that a missing day does not stretch a week.
    Each window partition is one group's days, bounded by the calendar, not by events.
    """
    c = F.col(count_col)
    base = Window.partitionBy(*group).orderBy(date_col)
    whole = Window.partitionBy(*group)
    month = Window.partitionBy(*group, F.trunc(F.col(date_col), "month"))
    by_day = Window.partitionBy(*group).orderBy(F.unix_date(F.col(date_col)))
    week = by_day.rangeBetween(-6, 0) if calendar else base.rowsBetween(-6, 0)
    week_before = by_day.rangeBetween(-13, -7) if calendar else base.rowsBetween(-13, -7)
    out = daily.select(
        "*",
        F.sum(c).over(month).alias("month_total"),
        F.sum(c).over(base).alias("running_total"),
        F.sum(c).over(whole).alias("total"),
        F.sum(c).over(week).alias("weekly_rolling_count"),
        F.sum(c).over(week_before).alias("previous_week_count"),
    )
    out = out.withColumn("pct_of_month", c.cast("double") / F.col("month_total")).withColumn(
        "pct_of_total", c.cast("double") / F.col("total")
    )
    return out if min_total is None else out.where(F.col("total") > min_total)


def best_stretch(rows: DataFrame, group: Sequence[str], order: Sequence[str], flag: Column, n: int) -> DataFrame:
    """Most flagged rows in any ``n`` consecutive rows per group (fewer at a group's start).

    With C the running count of flags by position, rows (i-n, i] hold C[i] - C[i-n]; C[i-n] comes
    from a null-safe equi-join on (group, position), so a group of any size is spread over tasks.
    """
    base = rows.select(*group, *order, flag.cast("long").alias("_flag"))
    c = running_totals(base, group, order, "_flag").select(*group, "position", "running")
    back = c.select(*group, (F.col("position") + n).alias("position"), F.col("running").alias("_back"))
    hits = null_safe_join(c, back, [*group, "position"], "left").select(
        *group, (F.col("running") - F.coalesce(F.col("_back"), F.lit(0))).alias("_in_window")
    )
    return hits.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), F.max("_in_window").alias(f"best_{n}"))


def longest_streak(rows: DataFrame, group: Sequence[str], order: Sequence[str], cond: Column) -> DataFrame:
    """Longest run of consecutive rows meeting ``cond`` per group (gaps and islands: the running
    count of misses is constant within a run, so runs are groups of (group, misses so far))."""
    base = rows.select(*group, *order, F.when(cond, 0).otherwise(1).cast("long").alias("_miss"))
    marked = running_totals(base, group, order, "_miss")
    hit = F.col("_miss") == 0
    runs = marked.groupBy(*group, "running").agg(F.count(F.lit(1)).alias("_rows"), F.count_if(hit).alias("_len"))
    return runs.groupBy(*group).agg(
        F.sum("_rows").cast("long").alias("rows"), F.max("_len").cast("long").alias("longest_streak"))
