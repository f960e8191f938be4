"""Exact and keyed de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicates removed (``GROUP BY`` all columns); partial aggregation runs map-side."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False, method: str = "aggregate"
) -> DataFrame:
    """One row per key: the first by ``order`` (a total order is required; D10).

    ``method="aggregate"`` (default): ``min_by``/``max_by`` over a struct of the row. The
    aggregate combines map-side, so a key holding a large share of the rows never lands whole
    in one task. When ``order`` names every other column, the row is its own order: a plain ``min`` or
    ``max`` of one struct, whose rows are half as wide in both sorts of the aggregate. ``method="window"``: ``row_number`` over (keys, order) — one sort, somewhat
    faster when keys are known to be small groups, but each key is sorted in one task.
    """
    if not order:
        raise ValueError("keep_first needs a tie-break order; row_number without one is arbitrary")
    if method == "window":
        from pyspark.sql import Window

        ordering = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
        w = Window.partitionBy(*keys).orderBy(*ordering)
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn").select(
            *keys, *[c for c in df.columns if c not in keys]
        )
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    value_cols = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in value_cols])
    ordering = F.struct(*[F.col(c) for c in order])
    if set(order) == set(value_cols):
        pick = F.max(ordering) if descending else F.min(ordering)
    else:
        pick = F.max_by(row, ordering) if descending else F.min_by(row, ordering)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in value_cols])
