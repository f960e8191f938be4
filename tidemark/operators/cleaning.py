"""Cleaning: column-name standardisation, date parsing with a failure count, median imputation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import running_totals


def standard_name(name: str) -> str:
    return re.sub(r"\s+", "_", name.strip().lower())


def standardise_columns(df: DataFrame) -> DataFrame:
    """Lower-case, whitespace -> '_' ; fails on collisions instead of silently shadowing."""
    new = [standard_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after standardisation: {new}")
    return df.withColumnsRenamed({old: n for old, n in zip(df.columns, new) if old != n})


def parse_dates(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Parse text columns to timestamps (bad input -> NULL) and flag rows where parsing failed."""
    failed = None
    parsed_cols = {}
    for c in cols:
        parsed = F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(c))
        bad = F.col(c).isNotNull() & parsed.isNull()
        failed = bad if failed is None else failed | bad
        parsed_cols[c] = parsed
    # flag from the raw text first, then replace the text by the parsed value
    return df.withColumn("parse_failed", failed).withColumns(parsed_cols)


def order_statistics(df: DataFrame, cols: Sequence[str], positions: Column) -> DataFrame:
    """(column, total, values): of each numeric column the values at ``positions`` (an array that may
    use ``total``, the column's number of values) in rising order; NULL and NaN do not count.

    All columns go together: they are melted to (column, value) and counted (which combines before
    the shuffle); the counts are range partitioned by (column, value) and summed up in order. A value
    stands at every position between the running counts before and after it."""
    melted = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("x")).select("x.*")
    counts = melted.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    running = running_totals(counts, ["column"], ["value"], "n")
    totals = running.groupBy("column").agg(F.sum("n").alias("total"))
    at = running.join(totals, "column").withColumn("position", F.explode(positions))
    held = at.where((F.col("position") > F.col("running") - F.col("n")) & (F.col("position") <= F.col("running")))
    return held.groupBy("column", "total").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "value"))), lambda x: x["value"]).alias("values"))


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians of numeric columns; a column without values has none. One row a column comes to the driver."""
    middle = F.array(F.expr("(total + 1) div 2"), F.expr("total div 2 + 1"))
    found = order_statistics(df, cols, middle).select("column", (F.get("values", 0) + F.get("values", 1)) / 2)
    return {r[0]: r[1] for r in found.collect()}


def exact_median(df: DataFrame, col: str) -> float | None:
    """Exact median of a numeric column (NULL and NaN do not count), without gathering its values."""
    return exact_medians(df, [col]).get(col)


def impute_median(df: DataFrame, cols: Sequence[str], approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Fill nulls of numeric columns with their median.

    ``approx=True`` takes one pass over all columns with a bounded quantile sketch per task (it
    returns an observed value, e.g. 2 where the exact median of 1, 2, 4, 9 is 3.0).
    """
    casted = df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    if approx:
        medians = casted.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in cols]).first().asDict()
    else:
        medians = exact_medians(casted, cols)
    return casted.fillna({c: m for c, m in medians.items() if m is not None})
