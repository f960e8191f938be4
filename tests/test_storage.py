"""Stored dimensions, partition transforms, salted buckets, sort orders, order statistics, map datelists."""

import datetime as dt
import glob
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tidemark.operators import activity as act
from tidemark.operators import layout
from tidemark.operators.cleaning import exact_medians, impute_median, order_statistics
from tidemark.operators.matches import SALT, salted_join, write_salted
from tidemark.operators.partitions import DatedTable
from tidemark.operators.scd import scd_backfill
from tidemark.plans.joins import broadcast_threshold
from tidemark.plans.scd_store import ScdStore

from .test_plans import plan


def folder(name: str) -> str:
    return os.path.join(tempfile.mkdtemp(prefix="tidemark-store-"), name)


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(1)
    rows = [(f"p{p}", season, str(rng.choice(["star", "good", None])), bool(rng.random() < 0.7))
            for p in range(40) for season in range(2000, 2006) if rng.random() < 0.8]
    rows = [(a, b, None if c == "None" else c, d) for a, b, c, d in rows]
    return spark.createDataFrame(rows, "player string, season int, class string, active boolean")


def expected(history, as_of):
    """By hand: a row ends where a value changes or a season is missing."""
    found, last = [], None
    for r in sorted(history.where(F.col("season") <= as_of).collect(), key=lambda r: (r["player"], r["season"])):
        now = (r["player"], r["class"], r["active"])
        if last == (now, r["season"] - 1):
            found[-1][4] = r["season"]
        else:
            found.append([*now, r["season"], r["season"]])
        last = (now, r["season"])
    return history.sparkSession.createDataFrame(
        [(*r, as_of) for r in found], "player string, class string, active boolean, start_season int, end_season int, as_of int")


def test_without_gaps_it_is_the_backfill(spark, history):
    spine = history.groupBy("player").agg(F.min("season").alias("first")).select(
        "player", F.explode(F.sequence("first", F.lit(2005))).alias("season"))
    whole = spine.join(history, ["player", "season"], "left").select("player", "season", "class", "active")
    store = ScdStore(spark, folder("scd"), ["player"], ["class", "active"], time_col="season")
    store.run(whole, 2001)
    store.run(whole, 2005)
    assertDataFrameEqual(store.table(), scd_backfill(whole, ["player"], "season", ["class", "active"], as_of_col="as_of"))


def times(path: str) -> dict[str, float]:
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_stored_scd_equals_the_backfill_and_closed_folders_stay(spark, history):
    path = folder("scd")
    store = ScdStore(spark, path, ["player"], ["class", "active"], time_col="season")
    assert store.run(history, 2000) == [2000]
    for season in range(2001, 2006):
        before = times(f"{path}/closed")
        assert store.run(history, season) == [season]
        after = times(f"{path}/closed")
        assert all(after[f] == t for f, t in before.items())  # no closed folder is written again
        assertDataFrameEqual(store.table(), expected(history, season))
    assert store.run(history, 2005) == [2005]  # run again
    assertDataFrameEqual(store.table(), expected(history, 2005))
    assertDataFrameEqual(store.table(2003), expected(history, 2003))  # as of an earlier period


def test_stored_scd_catches_up_and_runs_later_periods_again(spark, history):
    store = ScdStore(spark, folder("scd"), ["player"], ["class", "active"], time_col="season")
    assert store.run(history, 2002) == [2002]  # all history up to it at once
    assert store.run(history, 2005) == [2003, 2004, 2005]
    corrected = history.withColumn("class", F.when(F.col("season") == 2004, F.lit("new")).otherwise(F.col("class")))
    assert store.run(corrected, 2004) == [2004, 2005]
    assertDataFrameEqual(store.table(), expected(corrected, 2005))
    assert store.run(corrected, 2001) == [2001, 2002, 2003, 2004, 2005]
    assertDataFrameEqual(store.table(), expected(corrected, 2005))


def test_a_run_that_failed_is_not_a_period(spark, history):
    path = folder("scd")
    store = ScdStore(spark, path, ["player"], ["class", "active"], time_col="season")
    store.run(history, 2003)
    os.makedirs(f"{path}/open/as_of=2004")  # no mark of success
    assert store.periods() == [2003]
    assert store.run(history, 2004) == [2004]
    assertDataFrameEqual(store.table(), expected(history, 2004))


@pytest.fixture(scope="module")
def dated(spark):
    first = dt.datetime(2019, 1, 1)
    rows = [(i, first + dt.timedelta(days=i, hours=i % 24)) for i in range(0, 2550, 3)] + [(9999, None)]
    df = spark.createDataFrame(rows, "id long, at timestamp_ntz")
    return {t: DatedTable(spark, folder(t), "at", t).write(df, tasks=2) for t in ("year", "month", "day")} | {"df": df}


@pytest.mark.parametrize("transform", ["year", "month", "day"])
def test_ranges_of_the_date_prune_folders(spark, dated, transform):
    low, high = dt.date(2020, 5, 1), dt.date(2022, 1, 1)
    got = dated[transform].between(low, high)
    want = dated["df"].where((F.col("at") >= F.lit(low)) & (F.col("at") < F.lit(high)))
    assertDataFrameEqual(got, want)
    filters = [line for line in plan(got).splitlines() if "PartitionFilters" in line]
    assert filters and "_part" in filters[0]
    read = {int(f.split("_part=")[1].split("/")[0]) for f in got.inputFiles() if "HIVE_DEFAULT" not in f}
    kept = {r[0] for r in got.select(F.input_file_name()).distinct().collect()}
    assert len(kept) <= len(read)
    if transform == "year":
        assert {f.split("_part=")[1].split("/")[0] for f in kept} == {"2020", "2021"}  # two of seven years
    assertDataFrameEqual(dated[transform].between(None, None), dated["df"])


def test_range_in_the_joins_condition_prunes_and_keeps_outer_rows(spark, dated):
    other = spark.createDataFrame([(i, f"n{i}") for i in range(0, 2600, 5)], "id long, name string")
    low, high = dt.datetime(2020, 3, 1, 5), dt.datetime(2021, 6, 1, 7)
    got = dated["year"].join(other, ["id"], low=low, high=high)
    want = dated["df"].where((F.col("at") >= F.lit(low)) & (F.col("at") < F.lit(high))).join(other, "id")
    assertDataFrameEqual(got.select("id", "at", "name"), want.select("id", "at", "name"))
    scan = [line for line in plan(got).splitlines() if "PartitionFilters" in line and "_part" in line]
    assert scan and ">= 2020" in scan[0] and "<= 2021" in scan[0]


def test_dates_of_the_other_side_prune_while_running(spark, dated):
    days = spark.createDataFrame([(dt.date(2021, 3, i), i) for i in range(1, 20)], "day date, k int")
    path = folder("days")
    days.write.parquet(path)
    days = spark.read.parquet(path).where("k < 9")
    got = dated["year"].join(days, [], date="day")
    want = dated["df"].join(days, F.to_date("at") == F.col("day"))
    assertDataFrameEqual(got.select("id", "day"), want.select("id", "day"))
    assert "dynamicpruning" in plan(got).lower()


def test_a_match_of_a_third_of_the_rows_lies_in_several_buckets(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("match_id"),
        F.concat(F.lit("p"), "id").alias("player"))
    other = spark.range(3000).select(F.col("id").alias("match_id"), (F.col("id") % 5).alias("playlist"))
    a, b = write_salted(spark, rows, other, ("salted_rows", "salted_other"), spread="player", most=100)
    hot = a.where("match_id = 7").withColumn("file", F.input_file_name())
    assert hot.select(SALT).distinct().count() >= 10
    per_file = [r["count"] for r in hot.groupBy("file").count().collect()]
    assert len(per_file) >= 5 and max(per_file) < 500
    assert b.count() == 3000 + b.where("match_id = 7").count() - 1 and a.count() == 3000
    with broadcast_threshold(spark, "-1"):
        joined = salted_join(a, b)
        p = plan(joined)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assertDataFrameEqual(joined, rows.join(other, "match_id"))


def test_the_order_of_the_smallest_runs_makes_the_smallest_file(spark):
    rng = np.random.default_rng(3)
    rows = [(f"country number {rng.integers(4)}", f"city {rng.integers(40)}", int(rng.integers(3000))) for _ in range(6000)]
    df = spark.createDataFrame(rows, "country string, city string, person long")
    ranked = layout.rank_orders(df, ["person", "city", "country"]).orderBy("place").collect()
    want = {}
    for r in ranked:
        order = r["sort_order"].split(",")
        pos = [["country", "city", "person"].index(c) for c in order]
        want[r["sort_order"]] = [len({tuple(x[p] for p in pos[: i + 1]) for x in rows}) for i in range(3)]
        assert r["runs"] == want[r["sort_order"]]
    assert [r["cost"] for r in ranked] == sorted(r["cost"] for r in ranked) and len(ranked) == 6
    sizes = {}
    for r in (ranked[0], ranked[-1]):
        path = folder("layout")
        df.repartition(1).sortWithinPartitions(*r["sort_order"].split(",")).write.option("compression", "none").parquet(path)
        sizes[r["place"]] = layout.storage_size(spark, path, "x").first()["total_bytes"]
    assert sizes[1] < sizes[6]
    path = folder("smallest")
    assert layout.write_smallest(spark, df, ["person", "city", "country"], path) == ranked[0]["sort_order"].split(",")
    assert spark.read.parquet(path).count() == 6000


def test_a_keyed_sample_keeps_whole_runs(spark):
    df = spark.range(20000).select((F.col("id") % 500).alias("k"), (F.col("id") % 7).alias("v"))
    sampled = layout.rank_orders(df, ["k", "v"], every=5, key="k").where("sort_order = 'k,v'").first()["runs"]
    assert sampled[1] == 7 * sampled[0] and 50 < sampled[0] < 150


def test_medians_of_many_columns_in_one_pass(spark):
    rng = np.random.default_rng(5)
    table = {f"c{i}": rng.integers(-50, 50, 301 + 1).astype(float) for i in range(6)}
    table["c3"][:100] = 7.0  # a value that holds a third of the rows
    rows = [tuple(float(table[c][j]) for c in table) + (None, float("nan") if j % 2 else 1.5) for j in range(302)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*table, "empty", "odd"]))
    got = exact_medians(df, df.columns)
    assert got == {**{c: float(np.median(v)) for c, v in table.items()}, "odd": 1.5}
    quartiles = order_statistics(df, ["c0", "c3"], F.expr("array(1, total div 4, total)"))
    for r in quartiles.collect():
        values = np.sort(table[r["column"]])
        assert r["total"] == 302 and r["values"] == [values[0], values[74], values[-1]]
    filled = impute_median(spark.createDataFrame([(1.0, None), (None, 2), (4.0, 8)], "a double, b int"), ["a", "b"])
    assert sorted(tuple(r) for r in filled.collect()) == [(1.0, 5.0), (2.5, 2.0), (4.0, 8.0)]


def test_map_datelists_step_by_step_equal_the_rows(spark):
    d0 = dt.date(2024, 1, 1)
    rng = np.random.default_rng(7)
    rows = [(int(rng.integers(8)), str(rng.choice(["a", "b", "c"])), d0 + dt.timedelta(days=int(rng.integers(6)))) for _ in range(60)]
    activity = spark.createDataFrame(rows, "user_id long, browser string, day date")
    maps = spark.createDataFrame([], "user_id long, dates map<string,array<date>>")
    for i in (*range(6), 5):  # the last day twice
        day = d0 + dt.timedelta(days=i)
        maps = act.datelist_map_step(maps.select("user_id", "dates"), activity, "user_id", "browser", "day", day, "dates").checkpoint()
        flat = maps.select("user_id", F.explode("dates").alias("browser", "dates_active"), "date")
        assertDataFrameEqual(flat, act.datelist_backfill(activity, ["user_id", "browser"], "day", day))
    masks = act.datelist_map_int(maps, "dates").select("user_id", F.explode("datelist_ints").alias("browser", "datelist_int"))
    rows_form = act.datelist_int(act.datelist_backfill(activity, ["user_id", "browser"], "day", d0 + dt.timedelta(days=5)))
    assertDataFrameEqual(masks, rows_form.select("user_id", "browser", "datelist_int"))
