"""Pipeline health checks, one row per check: counts, keys, nulls, orphans, volume and freshness.

Rates are whole millionths, so that every value is an exact integer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _rows(table: str, agg: DataFrame) -> DataFrame:
    cols = agg.columns
    stacked = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in cols)
    return agg.select(F.lit(table).alias("table_name"), F.expr(f"stack({len(cols)}, {stacked}) AS (check_name, value)"))


def table_checks(df: DataFrame, table: str, key: str, not_null: tuple[str, ...] = ()) -> DataFrame:
    """Row count, duplicate keys, null counts and null rates in a single aggregate."""
    agg = df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.countDistinct(key)).alias(f"duplicate_{key}"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
        *[F.floor(F.try_divide(F.count_if(F.col(c).isNull()) * 1_000_000, F.count(F.lit(1)))).alias(f"null_ppm_{c}")
          for c in not_null],
    )
    return _rows(table, agg)


def orphan_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, table: str) -> DataFrame:
    """Child rows whose foreign key has no parent: counted per distinct key (which combines before
    the shuffle, however hot a key is), then a left anti join of the keys."""
    keys = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti")
    return _rows(table, orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(f"orphan_{child_key}")))


def volume_checks(df: DataFrame, time_col: str, table: str) -> DataFrame:
    """Daily volume range, missing days, and the largest change from one day to the next, in rows
    and in millionths of the earlier day."""
    daily = df.groupBy(F.to_date(time_col).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    days = Window.partitionBy(F.lit(0)).orderBy("_d")  # one row a day: bounded by the calendar
    daily = daily.where(F.col("_d").isNotNull()).withColumn("_before", F.lag("_n").over(days))
    shift = F.abs(F.col("_n") - F.col("_before"))
    return _rows(
        table,
        daily.agg(
            F.min("_n").alias("min_daily_rows"), F.max("_n").alias("max_daily_rows"),
            F.count(F.lit(1)).alias("days_present"),
            (F.datediff(F.max("_d"), F.min("_d")) + 1 - F.count(F.lit(1))).alias("days_missing"),
            F.max(shift).alias("max_daily_shift"),
            F.max(F.floor(shift * 1_000_000 / F.col("_before"))).alias("max_daily_shift_ppm"),
        ),
    )


def freshness_check(df: DataFrame, time_col: str, table: str, as_of: dt.date) -> DataFrame:
    """Days between the latest row and the as-of day."""
    return _rows(table, df.agg(F.datediff(F.lit(as_of), F.max(F.col(time_col).cast("date"))).alias("days_stale")))
