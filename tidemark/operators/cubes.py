"""Grouping-set reports with level labels (one scan, one Expand node)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _gid(dims: Sequence[str], grouped: Sequence[str]) -> int:
    """``grouping_id()`` value of a set: bit set for every dimension rolled up."""
    n = len(dims)
    return sum(1 << (n - 1 - i) for i, d in enumerate(dims) if d not in grouped)


def grouping_sets_report(
    df: DataFrame,
    dims: Sequence[str],
    sets: Sequence[Sequence[str]],
    measures: Sequence[Column],
    labels: Sequence[str] | None = None,
    fill: str | None = None,
    level_col: str = "aggregation_level",
) -> DataFrame:
    """``GROUP BY GROUPING SETS`` with a level label from ``grouping_id`` (not from null tests,
    since real nulls may have been filled). Rolled-up dimensions are filled with ``fill``.

    For many sets over large inputs, pre-aggregate to the finest set first and pass the
    additive measures (sum of counts), so the Expand multiplies small rows.
    """
    labels = labels or ["__".join(s) for s in sets]
    gid = F.grouping_id(*dims)
    label = None
    for s, name in zip(sets, labels):
        cond = gid == _gid(dims, s)
        label = F.when(cond, name) if label is None else label.when(cond, name)
    grouped = df.groupingSets([list(s) for s in sets], *dims).agg(*measures, label.alias(level_col))
    if fill is None:
        return grouped
    return grouped.select(
        level_col, *[F.coalesce(F.col(d), F.lit(fill)).alias(d) for d in dims],
        *[c for c in grouped.columns if c not in dims and c != level_col],
    )


def cube_report(df: DataFrame, dims: Sequence[str], measures: Sequence[Column], level_col: str = "grouping_level") -> DataFrame:
    """Full ``CUBE`` with ``grouping_id`` as the level (filterable dashboard extract)."""
    return df.cube(*dims).agg(*measures, F.grouping_id(*dims).cast("int").alias(level_col))
