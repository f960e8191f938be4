"""Daily jobs: partitions are re-runnable and the fold of daily runs equals the backfill."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tidemark.operators.activity import datelist_backfill
from tidemark.plans import q_events as qe
from tidemark.plans.jobs import scd_job, users_cumulated_job


def test_users_cumulated_job_is_rerunnable(spark, tables):
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-job-"), "users_cumulated")
    ua = qe.user_activity(tables)
    d0 = ua.agg(F.min("event_date")).first()[0]
    days = [d0 + dt.timedelta(days=i) for i in range(4)]
    for d in days:
        users_cumulated_job(spark, ua, out, d)
    users_cumulated_job(spark, ua, out, days[-1])  # re-run of the last day replaces it
    table = spark.read.parquet(out)
    assert table.select("date").distinct().count() == len(days)
    last = table.where(F.col("date") == F.lit(days[-1])).select("user_id", "dates_active", "date")
    assertDataFrameEqual(last, datelist_backfill(ua, ["user_id"], "event_date", days[-1]))


def _activity(spark, rows):
    return spark.createDataFrame(rows, "user_id long, event_date date")


def test_a_missed_day_is_run_first(spark):
    d = dt.date(2024, 3, 1)
    rows = [(1, d), (2, d), (1, d + dt.timedelta(days=1)), (3, d + dt.timedelta(days=2)), (1, d + dt.timedelta(days=3))]
    ua = _activity(spark, rows)
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-job-"), "users_cumulated")
    for days in (0, 1, 3):  # day 2 is missed
        users_cumulated_job(spark, ua, out, d + dt.timedelta(days=days))
    table = spark.read.parquet(out)
    assert table.select("date").distinct().count() == 4
    last = d + dt.timedelta(days=3)
    got = table.where(F.col("date") == F.lit(last)).select("user_id", "dates_active", "date")
    assertDataFrameEqual(got, datelist_backfill(ua, ["user_id"], "event_date", last))


def test_an_unreadable_table_is_an_error_not_a_first_run(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-job-"), "users_cumulated")
    os.makedirs(out)
    with open(os.path.join(out, "part-0.parquet"), "w") as f:
        f.write("not a table")
    with pytest.raises(Exception):
        users_cumulated_job(spark, _activity(spark, [(1, dt.date(2024, 3, 1))]), out, dt.date(2024, 3, 1))
    assert os.listdir(out) == ["part-0.parquet"]


def test_scd_job_is_rerunnable(spark):
    rows = [("a", 2001, "x"), ("a", 2002, "x"), ("a", 2003, "y"), ("b", 2002, "x")]
    snapshots = spark.createDataFrame(rows, "player_name string, current_season int, scoring_class string")
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-job-"), "scd")
    for season in (2002, 2003, 2003):
        scd_job(spark, snapshots, out, season, "player_name", ["scoring_class"])
    table = spark.read.parquet(out)
    assert table.groupBy("as_of").count().orderBy("as_of").collect() == [(2002, 2), (2003, 3)]
