"""Tables partitioned by a transform of a date, and predicates on the date that prune partitions.

Parquet folders know only the derived column, so a filter on the date reads every folder. Here a range
of the date also becomes a range of the derived column, and an equality with another table's date
also becomes an equality of the transforms, in a filter or in a join's condition. Spark then prunes
folders when it plans (literals) or when it runs (dynamic partition pruning by the other side).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DERIVED = "_part"
#: Transforms that rise with the date: as a column and of a Python date.
TRANSFORMS: dict[str, tuple[Callable[[Column], Column], Callable[[dt.date], int]]] = {
    "year": (F.year, lambda d: d.year),
    "month": (lambda c: F.year(c) * 12 + F.month(c) - 1, lambda d: d.year * 12 + d.month - 1),
    "day": (F.unix_date, lambda d: (dt.date(d.year, d.month, d.day) - dt.date(1970, 1, 1)).days),
}


class DatedTable:
    """A Parquet table in folders of ``transform(column)``. Rows without a date have a folder of their own."""

    def __init__(self, spark: SparkSession, path: str, column: str, transform: str = "year"):
        self.spark, self.path, self.column = spark, path, column
        self.of_column, self.of_date = TRANSFORMS[transform]

    def _derived(self, date: Column) -> Column:
        return self.of_column(date.cast("date")).cast("int")

    def write(self, df: DataFrame, tasks: int = 1) -> DatedTable:
        """``tasks`` write each folder (so that a large one is split), replacing the folders in ``df``."""
        part = df.withColumn(DERIVED, self._derived(F.col(self.column)))
        salted = part.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(tasks)))
        salted.repartition(DERIVED, "_salt").drop("_salt").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(DERIVED).parquet(self.path)
        return self

    def all(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def within(self, date: Column, derived: Column, low: dt.date | None, high: dt.date | None) -> Column:
        """``low <= date < high`` on the date and on the derived column (either border may be open)."""
        found = F.lit(True)
        if low is not None:
            found = found & (date >= F.lit(low)) & (derived >= self.of_date(low))
        if high is not None:
            last = high - (dt.timedelta(microseconds=1) if isinstance(high, dt.datetime) else dt.timedelta(days=1))
            found = found & (date < F.lit(high)) & (derived <= self.of_date(last))
        return found

    def between(self, low: dt.date | None, high: dt.date | None) -> DataFrame:
        return self.all().where(self.within(F.col(self.column), F.col(DERIVED), low, high)).drop(DERIVED)

    def join(self, other: DataFrame, on: Sequence[str], date: str | None = None, low: dt.date | None = None,
             high: dt.date | None = None, how: str = "inner") -> DataFrame:
        """The table joined to ``other`` on ``on``; the rest of the condition stands in ON as well: a range of
        the table's date, and equality with ``other``'s ``date``, whose folders alone are read then."""
        own = self.all()
        condition = self.within(own[self.column], own[DERIVED], low, high)
        for key in on:
            condition = condition & (own[key] == other[key])
        if date is not None:
            condition = condition & (own[self.column].cast("date") == other[date].cast("date")) & (
                own[DERIVED] == self._derived(other[date]))
        joined = own.join(other, condition, how)
        return joined.drop(own[DERIVED], *[other[k] for k in on])
