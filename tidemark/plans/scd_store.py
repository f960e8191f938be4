"""A type-2 dimension stored so that a period's run touches what is open, and nothing else.

``<path>/open/as_of=P`` holds the rows open after period P, ``<path>/closed/closed_in=P`` those that
period P closed. A run reads the open rows of the period before and the period's snapshot, compares
them (``scd_increment``), and writes one folder of either kind: closed history is neither read nor
written again, so the work of a period follows the open rows and not the history. Both writes replace
their folder, so a run can be repeated; the open one comes last and marks the period as done.

A period without a row of an entity ends what is open of it, in the first run over all history as in
the later ones; on cumulative snapshots, which have none missing, this is the SCD backfill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..operators.scd import scd_backfill, scd_increment


class ScdStore:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], tracked: Sequence[str],
                 time_col: str = "current_season", start_col: str = "start_season", end_col: str = "end_season"):
        self.spark, self.path, self.keys, self.tracked = spark, path.rstrip("/"), list(keys), list(tracked)
        self.time_col, self.start_col, self.end_col = time_col, start_col, end_col

    def _folder(self, kind: str, period: int) -> str:
        return f"{self.path}/open/as_of={period}" if kind == "open" else f"{self.path}/closed/closed_in={period}"

    def periods(self) -> list[int]:
        """The periods that are done, from the folders' names (one a period). Only a missing table is
        empty: a folder without its mark of success is a run that failed and is not done."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/open")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        done = []
        for status in files.listStatus(path):
            folder = status.getPath()
            if folder.getName().startswith("as_of=") and files.exists(folder.suffix("/_SUCCESS")):
                done.append(int(folder.getName().removeprefix("as_of=")))
        return sorted(done)

    def _write(self, rows: DataFrame, kind: str, period: int) -> None:
        rows.select(*self.keys, *self.tracked, self.start_col, self.end_col).write.mode("overwrite").parquet(
            self._folder(kind, period))

    def run(self, snapshots: DataFrame, period: int) -> list[int]:
        """Bring the table up to ``period`` and return the periods that were run. The first run takes
        all history up to it at once; missed periods are run first; a period that is run again
        takes the later ones along, as they build on it."""
        done = self.periods()
        earlier = [p for p in done if p < period]
        if not earlier:
            self._first(snapshots, period)
            todo = list(range(period + 1, max([period, *done]) + 1))
        else:
            todo = list(range(earlier[-1] + 1, max([period, *done]) + 1))
        for p in todo:
            self._next(snapshots, p)
        return todo if earlier else [period, *todo]

    def _first(self, snapshots: DataFrame, period: int) -> None:
        in_order = Window.partitionBy(*self.keys).orderBy(self.time_col)
        unbroken = (F.col(self.time_col) - F.row_number().over(in_order)).alias("_run")  # one number a run of periods
        history = scd_backfill(snapshots.select("*", unbroken), self.keys, self.time_col, [*self.tracked, "_run"], as_of=period,
                               start_col=self.start_col, end_col=self.end_col, as_of_col="_as_of").drop("_as_of", "_run")
        history = history.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ended = history.where(F.col(self.end_col) < period)
            ended.withColumn("closed_in", F.col(self.end_col) + 1).write.mode("overwrite").partitionBy("closed_in").parquet(
                f"{self.path}/closed")
            self._write(history.where(F.col(self.end_col) == period), "open", period)
        finally:
            history.unpersist()

    def _next(self, snapshots: DataFrame, period: int) -> None:
        before = self.spark.read.parquet(self._folder("open", period - 1))
        rows = scd_increment(before, snapshots, self.keys, self.tracked, as_of=period, time_col=self.time_col,
                             start_col=self.start_col, end_col=self.end_col, as_of_col="_as_of")
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(rows.where(F.col(self.end_col) < period), "closed", period)
            self._write(rows.where(F.col(self.end_col) == period), "open", period)
        finally:
            rows.unpersist()

    def table(self, as_of: int | None = None) -> DataFrame:
        """The whole dimension as of a period (the latest one): what closed up to it, and what is open."""
        as_of = self.periods()[-1] if as_of is None else as_of
        columns = [*self.keys, *self.tracked, self.start_col, self.end_col]
        held = self.spark.read.parquet(self._folder("open", as_of)).select(*columns)
        ended = self.spark.read.schema(held.schema.add("closed_in", IntegerType())).parquet(f"{self.path}/closed")
        return ended.where(F.col("closed_in") <= as_of).select(*columns).unionByName(held).withColumn(
            "as_of", F.lit(as_of))
