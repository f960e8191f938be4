"""Monthly array metrics: one array per (entity, month), element i = value of day i + 1."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _d(value) -> Column:
    return F.lit(value).cast("date")


def monthly_array_backfill(
    daily: DataFrame,
    keys: Sequence[str],
    date_col: str,
    value_cols: Sequence[str],
    as_of: dt.date,
    fill=None,
    value_type: str = "long",
) -> DataFrame:
    """Arrays of the month of ``as_of`` through ``as_of`` in one pass.

    ``daily`` has one row per (keys, day). Days without a row get ``fill`` (NULL for hit arrays,
    0 for metric arrays). The per-entity map holds at most 31 entries.
    """
    month_start = F.trunc(_d(as_of), "month")
    n_days = F.dayofmonth(_d(as_of))
    in_month = daily.where((F.col(date_col) >= month_start) & (F.col(date_col) <= _d(as_of)))
    day_idx = F.datediff(F.col(date_col), month_start)
    per_key = in_month.groupBy(*keys).agg(
        *[
            F.map_from_entries(F.collect_list(F.struct(day_idx, F.col(c).cast(value_type)))).alias(f"_m_{c}")
            for c in value_cols
        ],
        F.min(date_col).cast("date").alias("first_found_date"),
    )
    filler = F.lit(fill).cast(value_type)

    def by_day(c: str) -> Column:
        slots = F.sequence(F.lit(0), n_days - 1)
        return F.transform(slots, lambda i: F.coalesce(F.try_element_at(F.col(f"_m_{c}"), i), filler)).alias(c)

    return per_key.select(
        *keys,
        *[by_day(c) for c in value_cols],
        month_start.alias("month_start"),
        "first_found_date",
        _d(as_of).alias("date_partition"),
    )


def monthly_arrays_step(
    previous: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    value_cols: Sequence[str],
    as_of: dt.date,
    fill=None,
    value_type: str = "long",
) -> DataFrame:
    """Previous partition + today's values -> partition ``as_of`` (day by day), one array per value.

    Values are placed by day index: a previous array shorter than the day index (a missed
    day) is padded with ``fill`` first, so a skipped run never shifts later days. Rows of
    another month in ``previous`` are ignored, so the 1st of a month starts fresh.
    """
    month_start = F.trunc(_d(as_of), "month")
    idx = F.datediff(_d(as_of), month_start)
    prev = previous.where(F.col("month_start") == month_start).select(
        *keys, *[F.col(c).alias(f"_prev_{c}") for c in value_cols], F.col("first_found_date").alias("_first")
    )
    cur = today.select(*keys, *[F.col(c).cast(value_type).alias(f"_today_{c}") for c in value_cols], F.lit(True).alias("_here"))
    j = prev.join(cur, list(keys), "full")
    filler = F.lit(fill).cast(value_type)
    here = F.col("_here").isNotNull()

    def extended(c: str) -> Column:
        base = F.coalesce(F.col(f"_prev_{c}"), F.array().cast(f"array<{value_type}>"))
        pad = F.array_repeat(filler, F.greatest(idx - F.size(base), F.lit(0)))
        head = F.slice(F.concat(base, pad), 1, idx)  # a re-run of the same day replaces, not appends
        value = F.when(here, F.coalesce(F.col(f"_today_{c}"), filler)).otherwise(filler)
        return F.concat(head, F.array(value)).alias(c)

    return j.select(
        *keys,
        *[extended(c) for c in value_cols],
        month_start.alias("month_start"),
        F.least(F.col("_first"), F.when(here, _d(as_of))).alias("first_found_date"),
        _d(as_of).alias("date_partition"),
    )


def monthly_array_step(
    previous: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    value_col: str,
    as_of: dt.date,
    fill=None,
    value_type: str = "long",
    out: str | None = None,
) -> DataFrame:
    """``monthly_arrays_step`` for one value, whose array is named ``out``."""
    out = out or value_col
    return monthly_arrays_step(previous, today.withColumnRenamed(value_col, out), keys, [out], as_of, fill, value_type)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert without a MERGE-capable format: target rows not in updates + updates.

    Write the result into the affected partition with dynamic partition overwrite.
    """
    return target.join(updates.select(*keys).distinct(), list(keys), "left_anti").unionByName(updates)


def array_to_daily(df: DataFrame, group: Sequence[str], array_col: str, month_col: str = "month_start") -> DataFrame:
    """Element-wise sum of arrays per group, as one row per day (``UNNEST ... WITH ORDINALITY``)."""
    exploded = df.select(*group, month_col, F.posexplode(array_col).alias("pos", "value"))
    return exploded.groupBy(*group, month_col, "pos").agg(F.sum("value").alias("value")).select(
        *group, F.date_add(F.col(month_col), F.col("pos")).alias("date"), "value"
    )


def first_days_totals(df: DataFrame, array_col: str, n: int = 3, month_col: str = "month_start") -> DataFrame:
    """``SUM(COALESCE(get(a, i), 0))`` for the first ``n`` day slots, per month."""
    names = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh"]
    return df.groupBy(month_col).agg(
        *[
            F.sum(F.coalesce(F.get(F.col(array_col), i), F.lit(0))).cast("long").alias(f"num_hits_{names[i]}_day")
            for i in range(n)
        ]
    )
