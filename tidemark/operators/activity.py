"""Activity datelists (cumulative arrays of active dates) and their 32-bit packing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, bits


def _as_date(value) -> F.Column:
    return F.lit(value).cast("date") if not isinstance(value, F.Column) else value.cast("date")


def datelist_backfill(
    activity: DataFrame, keys: Sequence[str], date_col: str, as_of: dt.date, out: str = "dates_active"
) -> DataFrame:
    """Snapshot as of ``as_of``: keys, sorted distinct active dates, ``date``.

    ``collect_set`` combines map-side, so a hot key ships at most one set of dates per task;
    the per-key array is bounded by the number of days of history.
    """
    return (
        activity.where(F.col(date_col) <= _as_date(as_of))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set(F.col(date_col).cast("date"))).alias(out))
        .withColumn("date", _as_date(as_of))
    )


def datelist_step(
    previous: DataFrame, activity: DataFrame, keys: Sequence[str], date_col: str, as_of: dt.date,
    out: str = "dates_active",
) -> DataFrame:
    """Yesterday's snapshot + today's activity -> today's snapshot (inactive keys carried)."""
    today = (
        activity.where(F.col(date_col) == _as_date(as_of)).select(*keys).distinct().withColumn("_here", F.lit(True))
    )
    prev = previous.select(*keys, out)
    j = prev.join(today, list(keys), "full")
    return j.select(
        *keys,
        arrays.append_if(F.col(out), F.col("_here").isNotNull(), _as_date(as_of), "date").alias(out),
        _as_date(as_of).alias("date"),
    )


def datelist_int(snapshot: DataFrame, dates: str = "dates_active", date: str = "date") -> DataFrame:
    """Pack the last 32 days into a long: bit 31 = as-of day, bit 0 = 31 days before."""
    return snapshot.withColumn("datelist_int", bits.datelist_to_int(F.col(dates), F.col(date)))


def datelist_activity(packed: DataFrame, col: str = "datelist_int") -> DataFrame:
    """Monthly/weekly activity flags and counts from the packed int (codegen'd bit ops)."""
    m = F.col(col)
    return packed.select(
        "*",
        (bits.count_bits(m) > 0).alias("monthly_active"),
        bits.count_bits(m).alias("l32"),
        (bits.count_bits(m, bits.LAST_7_DAYS_MASK) > 0).alias("weekly_active"),
        bits.count_bits(m, bits.LAST_7_DAYS_MASK).alias("l7"),
        (bits.count_bits(m, bits.PREVIOUS_7_DAYS_MASK) > 0).alias("weekly_active_previous_week"),
    )


def datelist_map_step(previous: DataFrame, activity: DataFrame, key: str, dim: str, date_col: str, as_of: dt.date,
                      out: str) -> DataFrame:
    """Yesterday's maps (key, ``out`` as ``MAP<dim, ARRAY<DATE>>``) + today's activity -> today's maps.

    Today's values of a key become a map, too (bounded by the number of values of ``dim``), and one
    full join merges the two entry by entry; values without activity today keep their dates. Running
    the step again for the same day changes nothing."""
    today = activity.where(F.col(date_col) == _as_date(as_of)).groupBy(key).agg(
        F.map_from_entries(F.transform(F.array_sort(F.collect_set(dim)), lambda d: F.struct(d, F.array(_as_date(as_of))))).alias("_today"))
    nothing = F.create_map().cast(f"map<{dict(activity.dtypes)[dim]},array<date>>")
    merged = F.map_zip_with(
        F.coalesce(F.col(out), nothing), F.coalesce(F.col("_today"), nothing),
        lambda _, before, now: F.array_union(F.coalesce(before, F.array().cast("array<date>")), F.coalesce(now, F.array().cast("array<date>"))))
    return previous.select(key, out).join(today, key, "full").select(key, merged.alias(out), _as_date(as_of).alias("date"))


def datelist_map_int(maps: DataFrame, dates: str, date: str = "date", out: str = "datelist_ints") -> DataFrame:
    """The maps' date arrays as 32-bit masks: ``MAP<dim, BIGINT>``."""
    return maps.withColumn(out, F.transform_values(dates, lambda _, days: bits.datelist_to_int(days, F.col(date))))


def datelist_map(per_dimension: DataFrame, key: str, dim: str, dates: str = "dates_active") -> DataFrame:
    """``MAP<dim, ARRAY<DATE>>`` per key from one row per (key, dim); the map is bounded by the
    number of distinct dimension values (e.g. browser types)."""
    return per_dimension.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(dim), F.col(dates))))).alias(f"{dim}_{dates}")
    )
