"""Growth accounting (daily and weekly user states) and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays

# The five growth states of the reference.
NEW, RETAINED, RESURRECTED, CHURNED, STALE = "New", "Retained", "Resurrected", "Churned", "Stale"
ACTIVE_STATES = (NEW, RETAINED, RESURRECTED)


def _d(value) -> Column:
    return F.lit(value).cast("date")


def _daily_state(is_new: Column, active: Column, y_last: Column, day: Column) -> Column:
    return (
        F.when(is_new, NEW)
        .when(active & (y_last == F.date_sub(day, 1)), RETAINED)
        .when(active & (y_last < F.date_sub(day, 1)), RESURRECTED)
        .when(~active & (y_last == F.date_sub(day, 1)), CHURNED)
        .otherwise(STALE)
    )


def _weekly_state(is_new: Column, active: Column, y_last: Column, last: Column, day: Column) -> Column:
    return (
        F.when(is_new, NEW)
        .when(active & (y_last < F.date_sub(day, 7)), RESURRECTED)
        .when(~active & (y_last == F.date_sub(day, 8)), CHURNED)
        .when(F.date_add(last, 7) >= F.date_sub(day, 1), RETAINED)
        .otherwise(STALE)
    )


def growth_accounting_backfill(
    activity: DataFrame, key: str, date_col: str, as_of: dt.date, with_dates: bool = True
) -> DataFrame:
    """Every (user, day) from the user's first active day to ``as_of`` in one pass.

    One shuffle: the distinct active dates per user are gathered (bounded by days of history,
    combined map-side), then each active date d_i expands to the days until the next active
    date, with d_{i-1} as "yesterday's last active". No per-day join, no window.
    ``dates_active`` on every row makes the output quadratic in days per user (the reference's
    table model); ``with_dates=False`` leaves it out when only the states are needed.
    """
    per_user = activity.where(F.col(date_col) <= _d(as_of)).groupBy(key).agg(
        F.array_sort(F.collect_set(F.col(date_col).cast("date"))).alias("_d")
    )
    runs = per_user.select(key, "_d", F.posexplode("_d").alias("_i", "_active"))
    runs = runs.select(
        key,
        F.get(F.col("_d"), 0).alias("first_active_date"),
        "_active",
        F.get(F.col("_d"), F.col("_i") - 1).alias("_prev"),
        F.slice(F.col("_d"), 1, F.col("_i") + 1).alias("dates_active"),
        F.coalesce(F.date_sub(F.get(F.col("_d"), F.col("_i") + 1), 1), _d(as_of)).alias("_until"),
    )
    days = runs.select("*", F.explode(F.sequence(F.col("_active"), F.col("_until"))).alias("date"))
    active = F.col("date") == F.col("_active")
    y_last = F.when(active, F.col("_prev")).otherwise(F.col("_active"))
    is_new = F.col("date") == F.col("first_active_date")
    out = days.select(
        key,
        "first_active_date",
        F.col("_active").alias("last_active_date"),
        _daily_state(is_new, active, y_last, F.col("date")).alias("daily_active_state"),
        _weekly_state(is_new, active, y_last, F.col("_active"), F.col("date")).alias("weekly_active_state"),
        "dates_active",
        "date",
    )
    return out if with_dates else out.drop("dates_active")


def growth_accounting_step(previous: DataFrame, activity: DataFrame, key: str, date_col: str, as_of: dt.date) -> DataFrame:
    """Yesterday's state rows + today's activity -> today's rows (the reference's full join)."""
    today = activity.where(F.col(date_col) == _d(as_of)).select(key).distinct().withColumn("_here", F.lit(True))
    y = previous.select(
        key,
        F.col("first_active_date").alias("_y_first"),
        F.col("last_active_date").alias("_y_last"),
        F.col("dates_active").alias("_y_dates"),
    )
    j = y.join(today, [key], "full")
    active = F.col("_here").isNotNull()
    is_new = F.col("_y_first").isNull()
    last = F.when(active, _d(as_of)).otherwise(F.col("_y_last"))
    return j.select(
        key,
        F.coalesce(F.col("_y_first"), _d(as_of)).alias("first_active_date"),
        last.alias("last_active_date"),
        _daily_state(is_new, active, F.col("_y_last"), _d(as_of)).alias("daily_active_state"),
        _weekly_state(is_new, active, F.col("_y_last"), last, _d(as_of)).alias("weekly_active_state"),
        arrays.append_if(F.col("_y_dates"), active, _d(as_of), "date").alias("dates_active"),
        _d(as_of).alias("date"),
    )


def retention_curve(growth: DataFrame) -> DataFrame:
    """J-curve: share of users active (New/Retained/Resurrected) by days since first activity."""
    days_since = F.datediff(F.col("date"), F.col("first_active_date"))
    return growth.groupBy(days_since.alias("days_since_first_active")).agg(
        (F.count_if(F.col("daily_active_state").isin(*ACTIVE_STATES)).cast("double") / F.count(F.lit(1))).alias(
            "pct_active"
        ),
        F.count(F.lit(1)).alias("n_users"),
    )
