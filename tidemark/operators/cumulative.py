"""Cumulative (snapshot-per-period) dimension tables.

``cumulative_backfill`` builds every snapshot in one pass; ``cumulative_step`` merges one
period into the previous snapshot. Both follow one rule, so folding the step over the periods
equals the backfill: static attributes take the first non-null value by period, history
appends one struct per active period, and activity is derived from the last history entry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays


def _history_struct(time_col: str, fields: Sequence[str]) -> Column:
    return F.struct(F.col(time_col), *[F.col(c) for c in fields])


def cumulative_backfill(
    facts: DataFrame,
    keys: Sequence[str],
    time_col: str,
    history_fields: Sequence[str],
    static_cols: Sequence[str] = (),
    through: int | None = None,
    history: str = "history",
    keep_last: int | None = None,
) -> DataFrame:
    """All snapshots at once: one row per (keys, period) from the entity's first period to ``through``.

    ``facts`` has at most one row per (keys, period); periods are integers (seasons, years).
    One shuffle (group by entity); the per-entity array is bounded by the number of periods.
    Output: keys, statics, ``time_col``, ``history`` (array of structs, oldest first),
    ``last_active``, ``is_active``, ``periods_since_last_active``.
    Every row carries its history, so storage is quadratic in periods per entity; ``keep_last``
    keeps only the latest N entries per row (default: the whole history).
    """
    if through is None:
        through = facts.agg(F.max(time_col)).first()[0]  # one scalar to the driver
    aggs = [F.array_sort(F.collect_list(_history_struct(time_col, history_fields))).alias("_all")]
    aggs += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time_col))).alias(c) for c in static_cols]
    per_entity = facts.groupBy(*keys).agg(*aggs)
    first_period = F.get(F.col("_all"), 0)[time_col]
    spine = per_entity.select(
        *keys, *static_cols, "_all", F.explode(F.sequence(first_period, F.lit(through))).alias(time_col)
    )
    out = spine.select(
        *keys,
        *static_cols,
        F.col(time_col).cast("int").alias(time_col),
        _keep(F.filter("_all", lambda r: r[time_col] <= F.col(time_col)), keep_last).alias(history),
    )
    return _with_activity(out, time_col, history)


def _keep(hist: Column, keep_last: int | None) -> Column:
    """Last ``keep_last`` entries (a negative ``slice`` start past the front gives [], so the
    start is computed from the size)."""
    if keep_last is None:
        return hist
    return F.slice(hist, F.greatest(F.size(hist) - keep_last + 1, F.lit(1)), F.lit(keep_last))


def _with_activity(df: DataFrame, time_col: str, history: str) -> DataFrame:
    last_active = arrays.last(F.col(history))[time_col]
    return (
        df.withColumn("last_active", last_active)
        .withColumn("is_active", F.coalesce(F.col("last_active") == F.col(time_col), F.lit(False)))
        .withColumn("periods_since_last_active", F.col(time_col) - F.col("last_active"))
    )


def cumulative_step(
    previous: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    time_col: str,
    history_fields: Sequence[str],
    static_cols: Sequence[str],
    as_of: int,
    history: str = "history",
    keep_last: int | None = None,
) -> DataFrame:
    """Merge period ``as_of`` (rows of ``today`` with ``time_col == as_of``) into ``previous``.

    Full outer join on the keys; statics prefer the previous snapshot; an inactive entity is
    carried with its history unchanged; ``is_active`` = present in ``today``.
    """
    prev = previous.select(
        *keys, *[F.col(c).alias(f"_p_{c}") for c in static_cols], F.col(history).alias("_p_hist")
    )
    cur = today.where(F.col(time_col) == as_of).select(
        *keys,
        *[F.col(c).alias(f"_t_{c}") for c in static_cols],
        _history_struct(time_col, history_fields).alias("_t_rec"),
    )
    joined = prev.join(cur, list(keys), "full")
    present = F.col("_t_rec").isNotNull()
    # The appended struct must carry the history's element type (int period).
    rec = F.col("_t_rec").withField(time_col, F.col("_t_rec")[time_col].cast("int"))
    hist_type = _element_type(previous, history)
    out = joined.select(
        *keys,
        *[F.coalesce(f"_p_{c}", f"_t_{c}").alias(c) for c in static_cols],
        F.lit(as_of).cast("int").alias(time_col),
        _keep(arrays.append_if(F.col("_p_hist"), present, rec, hist_type), keep_last).alias(history),
    )
    return _with_activity(out, time_col, history)


def _element_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.elementType.simpleString()


def history_rows(snapshot: DataFrame, keys: Sequence[str], history: str = "history") -> DataFrame:
    """Expand the history array back into one row per period (``UNNEST``)."""
    return snapshot.select(*keys, F.inline(history))
