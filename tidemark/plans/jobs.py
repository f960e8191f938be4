"""Daily incremental jobs: read the latest earlier partition, apply a step per day, write the days.

Writes use dynamic partition overwrite keyed by the as-of date, so re-running a day replaces
that day's partition instead of appending it twice (the reference's INSERT would duplicate
rows or violate its key). Inputs and outputs are parquet folders partitioned by ``date``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import activity as act
from ..operators import array_metrics as am
from ..operators import growth as gr
from ..operators import scd
from ..sources.files import write_partitions


def _table_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def run_days(
    spark: SparkSession, path: str, day: dt.date, column: str, schema: str, step: Callable[[DataFrame, dt.date], DataFrame]
) -> list[dt.date]:
    """Bring the table at ``path`` up to ``day`` and return the days that were run.

    A table that does not exist starts empty with ``day``. Otherwise the latest partition before
    ``day`` is the previous state, and each missed day in between is run first, so that no history
    is lost. Only a missing folder means a first run: any failure to read the table is raised.
    """
    last = None
    if _table_exists(spark, path):
        earlier = spark.read.parquet(path).where(F.col(column) < F.lit(day).cast("date"))
        last = earlier.agg(F.max(column)).first()[0]
    days = [day] if last is None else [last + dt.timedelta(days=i + 1) for i in range((day - last).days)]
    for now in days:
        if last is None:
            previous = spark.createDataFrame([], schema)
        else:
            previous = spark.read.parquet(path).where(F.col(column) == F.lit(last).cast("date"))
        write_partitions(step(previous, now), path, [column])
        last = now
    return days


def users_cumulated_job(spark: SparkSession, activity: DataFrame, out_path: str, day: dt.date) -> None:
    """C14: users_cumulated(date = day) = the day before + activity of ``day``."""
    run_days(
        spark, out_path, day, "date", "user_id long, dates_active array<date>, date date",
        lambda previous, now: act.datelist_step(previous, activity, ["user_id"], "event_date", now))


def growth_accounting_job(spark: SparkSession, activity: DataFrame, out_path: str, day: dt.date) -> None:
    """A1: one day of growth accounting from the day before."""
    run_days(
        spark, out_path, day, "date",
        "user_id long, first_active_date date, last_active_date date, daily_active_state string, "
        "weekly_active_state string, dates_active array<date>, date date",
        lambda previous, now: gr.growth_accounting_step(previous, activity, "user_id", "event_date", now))


def monthly_hits_job(spark: SparkSession, daily_hits: DataFrame, out_path: str, day: dt.date) -> None:
    """C17: monthly hit arrays, partition ``date_partition = day`` from the day before."""
    run_days(
        spark, out_path, day, "date_partition",
        "user_id long, num_hits array<bigint>, month_start date, first_found_date date, date_partition date",
        lambda previous, now: am.monthly_array_step(
            previous, daily_hits.where(F.col("event_date") == F.lit(now).cast("date")), ["user_id"], "num_hits", now))


def scd_job(spark: SparkSession, snapshots: DataFrame, out_path: str, season: int, entity: str, tracked: list[str],
            season_col: str = "current_season") -> None:
    """S8 for the SCD: partition ``as_of = season`` of the whole type-2 history up to ``season``,
    rebuilt from the snapshots, so that a re-run replaces it."""
    history = scd.scd_backfill(snapshots.where(F.col(season_col) <= season), [entity], season_col, tracked)
    history = history.withColumn("as_of", F.lit(season))
    write_partitions(history, out_path, ["as_of"])
