"""Physical plans: the shapes the operators promise (exchanges, Expand, pushdown, no windows)."""

import contextlib
import io

from pyspark.sql import functions as F

from tidemark.operators.funnel import funnel
from tidemark.operators.scd import scd_backfill
from tidemark.plans import q_analytics, q_matches
from tidemark.operators.matches import match_facts
from tidemark.plans.joins import bounded, bounded_broadcast, broadcast_threshold, estimated_bytes, row_bytes
from tidemark.sources import adapters

from .conftest import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_bucketed_join_has_no_exchange(spark):
    with broadcast_threshold(spark, "-1"):
        p = plan(q_matches.q_bucketed_match_join(spark, SF_SMALL))
        assert "SortMergeJoin" in p
        assert "Exchange" not in p


def test_grouping_sets_single_expand(spark):
    p = plan(q_analytics.q_device_hits_grouping_sets(spark, SF_SMALL))
    tree = p.split("\n\n")[0]
    assert tree.count("Expand") == 1
    # events and part read once each; the unused left join to pages is eliminated
    assert tree.count("Scan parquet") == 2


def test_scd_backfill_one_exchange(spark):
    src = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "name string, season int, cls string")
    p = plan(scd_backfill(src, ["name"], "season", ["cls"], as_of=2), "simple")
    assert p.count("Exchange hashpartitioning") == 1


def test_funnel_has_no_window_and_no_nested_loop(spark, tables):
    p = plan(funnel(adapters.web_events(tables), "user_id", "event_time", "url", "signup"))
    assert "Window" not in p
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_projection_and_filter_reach_the_scan(spark, tables):
    p = plan(adapters.purchase_activity(tables))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    p2 = plan(adapters.player_seasons(tables))
    assert "o_orderstatus" not in p2  # unused column pruned from the orders scan


def test_bounded_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = spark.range(100)
    joined_small = spark.range(1000).join(bounded_broadcast(small, 400), "id")
    with broadcast_threshold(spark, "-1"):
        assert "BroadcastHashJoin" in plan(joined_small)
        assert "BroadcastHashJoin" not in plan(spark.range(1000).join(bounded_broadcast(big, 400), "id"))


def test_row_bytes_are_those_of_rows_in_memory(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, "nine char", b"12"), (None, None, b"")], "a long, `b.c` string, b binary")
    assert row_bytes(rows) == 3 * 32 + 8 + 16 + 8
    assert row_bytes(rows.select("a", F.col("a").cast("int").alias("a"))) == 3 * 24
    assert row_bytes(rows.limit(0)) == 0


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path):
    spark.range(100_000).withColumn("name", F.lit("a name of some length")).write.parquet(str(tmp_path / "dim"))
    dim, bound = spark.read.parquet(str(tmp_path / "dim")), 2 << 20
    assert estimated_bytes(dim) < bound < row_bytes(dim) == 100_000 * 48
    for mark in (bounded_broadcast, bounded):  # whatever the planner's threshold
        for threshold in ("-1", "100m"):
            with broadcast_threshold(spark, threshold):
                assert "SortMergeJoin" in plan(spark.range(10_000_000).join(mark(dim, bound), "id"))
    with broadcast_threshold(spark, "-1"):
        assert "SortMergeJoin" in plan(spark.range(10_000_000).join(bounded(dim), "id"))
    with broadcast_threshold(spark, "100m"):
        assert "BroadcastHashJoin" in plan(spark.range(10_000_000).join(bounded(dim), "id"))


def test_match_facts_of_many_medals(spark, tmp_path):
    """More medals than may be broadcast, in files of a few MB: the facts are those of a small table."""
    few = [(1, "PROMO"), (2, "OTHER"), (2, "PROMO"), (3, None)]  # medal 2 stands twice
    few = spark.createDataFrame(few, "medal_id long, name string")
    few.unionByName(spark.range(10, 1_500_010, numPartitions=4).select(F.col("id").alias("medal_id"), F.lit("OTHER").alias("name"))).write.parquet(
        str(tmp_path / "medals"))
    many = spark.read.parquet(str(tmp_path / "medals"))
    matches = spark.createDataFrame([(7, "p", 1, None), (8, "q", 9, None)], "match_id long, playlist_id string, mapid long, completion_date timestamp")
    details = spark.createDataFrame(
        [(7, "a", 5, 1), (7, "b", 6, 1), (8, "a", 7, 2)],
        "match_id long, player_gamertag string, player_total_kills long, player_total_deaths long")
    rows = spark.createDataFrame(
        [(7, "a", 1, 4), (7, "a", 2, 3), (7, "a", 3, 2), (7, "a", 5, 100), (7, "a", None, 100), (7, "b", 10, None), (8, "a", 11, 1)],
        "match_id long, player_gamertag string, medal_id long, count long")
    maps = spark.createDataFrame([(1, "m")], "mapid long, name string")

    def facts(medals):
        return match_facts(matches, details, rows, medals, maps)

    with broadcast_threshold(spark, "100m"):
        assert "Broadcast" not in plan(facts(many))
    said = sorted(tuple(r)[:8] for r in facts(many).collect())
    assert said == [(7, "a", "p", "m", 5, 1, 12, 7), (7, "b", "p", "m", 6, 1, 0, 0), (8, "a", "q", None, 7, 2, 1, 0)]
    assert said[0] == next(tuple(r)[:8] for r in facts(few).where("player_gamertag = 'a' AND match_id = 7").collect())


def test_predicate_in_join_condition_reaches_the_scan(spark, tables):
    orders = tables.orders.select("o_orderkey", "o_orderdate")
    items = tables.lineitem.select("l_orderkey", "l_quantity")
    cond = (items.l_orderkey == orders.o_orderkey) & (orders.o_orderdate >= F.lit("1998-01-01").cast("timestamp_ntz"))
    p = plan(items.join(orders, cond))
    assert "GreaterThanOrEqual(o_orderdate" in p  # pushed into the orders scan (J11)
