"""Registered queries: bucketed match facts, broadcast dimensions, the four questions, layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import cents
from ..operators import layout
from ..operators.matches import buckets_for, match_facts, match_questions, salted_join, write_bucketed, write_salted
from ..operators.partitions import DatedTable
from ..plans.joins import estimated_bytes
from ..session import staging_path
from ..sources import adapters
from ..sources.tables import Tables


def bucketed_sources(spark: SparkSession, t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three match tables, written bucketed alike; the number of buckets follows the largest."""
    sources = adapters.matches(t), adapters.match_details(t), adapters.medals_matches_players(t)
    buckets = buckets_for(max(estimated_bytes(x) for x in (t.orders, t.lineitem)))
    names = "matches", "match_details", "medals_matches_players"
    matches, details, medals = (write_bucketed(spark, x, n, buckets=buckets) for x, n in zip(sources, names))
    return matches, details, medals


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    m, md, mmp = bucketed_sources(spark, t)
    return match_facts(m, md, mmp, adapters.medals(t), adapters.maps(t))


def staged_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match facts written once, for reports that read them several times."""
    path = staging_path(spark, "match-facts")
    facts(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def q_bucketed_match_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """matches x match_details on match_id, both bucketed alike on (match_id, salt): a sort-merge join
    with no exchange on either side, and a match of very many players in several buckets."""
    t = Tables(spark, sf_dir)
    buckets = buckets_for(max(estimated_bytes(x) for x in (t.orders, t.lineitem)))
    md, m = write_salted(
        spark, adapters.match_details(t), adapters.matches(t), ("match_details", "matches"), spread="player_gamertag",
        buckets=buckets)
    return salted_join(md, m).select(
        "match_id", "player_gamertag", "playlist_id", "mapid", "player_total_kills", "player_total_deaths"
    )


def q_match_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).drop("completion_date")


def q_match_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_questions(staged_facts(spark, sf_dir))


def q_layout_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match facts under candidate sort orders and a year partitioning: what each layout holds
    when it is read back. Its bytes and files (``layout.write_layouts``) differ from run to run and
    stay out of the registered columns; ``has_files`` says that they were counted."""
    report = layout.write_layouts(
        spark,
        facts(spark, sf_dir),
        {
            "unsorted": [],
            "playlist_map": ["playlist_id", "map_name"],
            "map_playlist": ["map_name", "playlist_id"],
            "match_id": ["match_id"],
        },
        partition_by={"year": F.year("completion_date")},
        checksum=F.sum("kills"),
    )
    return report.select("layout", "n_rows", "checksum", (F.col("total_bytes") > F.col("n_files")).alias("has_files"))


def q_best_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sort orders of the match details (playlist, map, match) by the bytes of their runs, and the
    one to write."""
    t = Tables(spark, sf_dir)
    details = t.lineitem.select(F.col("l_orderkey").alias("match_id"))
    rows = details.join(adapters.matches(t).select("match_id", "playlist_id", "mapid"), "match_id")
    ranked = layout.rank_orders(rows, ["playlist_id", "mapid", "match_id"])
    return ranked.select(
        "sort_order", F.concat_ws(",", F.col("runs").cast("array<string>")).alias("runs"), "cost", "place",
        (F.col("place") == 1).alias("chosen"))


def dated_orders(spark: SparkSession, t: Tables) -> DatedTable:
    """Orders in folders of the year of their date."""
    return DatedTable(spark, staging_path(spark, "orders-by-year"), "o_orderdate").write(t.orders)


def q_year_pruned_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of 1996-03 to 1997-09 per nation, from a table in yearly folders: the range of the date
    stands in the join's condition, and only the folders of two years are read."""
    t = Tables(spark, sf_dir)
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = dated_orders(spark, t).join(customers, ["o_custkey"], low=dt.date(1996, 3, 1), high=dt.date(1997, 10, 1))
    return orders.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(cents(F.col("o_totalprice"))).alias("cents"),
        F.min(F.to_date("o_orderdate")).cast("string").alias("first_day"), F.max(F.to_date("o_orderdate")).cast("string").alias("last_day"))


def q_date_pruned_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on the days of 1998 that shipped a full line at the highest discount, joined by date: the
    folders are chosen while the query runs, by the other side's dates."""
    t = Tables(spark, sf_dir)
    days = t.lineitem.where("l_quantity = 50 AND l_discount = 0.1").select(
        F.to_date("l_shipdate").alias("day")).where("year(day) = 1998").distinct()
    orders = dated_orders(spark, t).join(days, [], date="day")
    return orders.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(cents(F.col("o_totalprice"))).alias("cents"))


QUERIES = {
    "bucketed_match_join": q_bucketed_match_join,
    "match_facts": q_match_facts,
    "match_questions": q_match_questions,
    "layout_sizes": q_layout_sizes,
    "best_layout": q_best_layout,
    "year_pruned_join": q_year_pruned_join,
    "date_pruned_join": q_date_pruned_join,
}

MATCH = """
mt AS (SELECT o.o_orderkey AS match_id, o.o_orderpriority AS playlist_id, CAST(c.c_nationkey AS BIGINT) AS mapid
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
md AS (SELECT l_orderkey AS match_id, 'player_' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
              CAST(SUM(l_quantity) AS BIGINT) AS kills, COUNT(*) AS deaths FROM lineitem GROUP BY 1, 2),
mm AS (SELECT l.l_orderkey AS match_id, 'player_' || CAST(l.l_suppkey AS VARCHAR) AS player_gamertag,
              CAST(SUM(l.l_quantity) AS BIGINT) AS n_medals,
              CAST(SUM(CASE WHEN p.p_type = 'PROMO' THEN l.l_quantity ELSE 0 END) AS BIGINT) AS killing_sprees
       FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2),
mf AS (SELECT md.match_id, md.player_gamertag, mt.playlist_id, n.n_name AS map_name, md.kills, md.deaths,
              COALESCE(mm.n_medals, 0) AS n_medals, COALESCE(mm.killing_sprees, 0) AS killing_sprees
       FROM md JOIN mt ON mt.match_id = md.match_id
       LEFT JOIN mm ON mm.match_id = md.match_id AND mm.player_gamertag = md.player_gamertag
       LEFT JOIN nation n ON n.n_nationkey = mt.mapid)"""

ORACLES = {
    "bucketed_match_join": """
SELECT l.l_orderkey AS match_id, 'player_' || CAST(l.l_suppkey AS VARCHAR) AS player_gamertag,
       o.o_orderpriority AS playlist_id, CAST(c.c_nationkey AS BIGINT) AS mapid,
       CAST(SUM(l.l_quantity) AS BIGINT) AS player_total_kills, COUNT(*) AS player_total_deaths
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY 1, 2, 3, 4""",
    "match_facts": f"WITH {MATCH} SELECT * FROM mf",
    "layout_sizes": f"""WITH {MATCH}
SELECT layout, COUNT(*) AS n_rows, CAST(SUM(kills) AS BIGINT) AS checksum, TRUE AS has_files
FROM mf, (VALUES ('unsorted'), ('playlist_map'), ('map_playlist'), ('match_id'), ('year')) AS l(layout) GROUP BY layout""",
    "best_layout": """
WITH r AS (SELECT l.l_orderkey AS match_id, o.o_orderpriority AS playlist_id, c.c_nationkey AS mapid
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey),
w AS (SELECT CAST(ceil(SUM(strlen(playlist_id)) / COUNT(*)) AS BIGINT) AS wp, CAST(ceil(SUM(strlen(mapid::VARCHAR)) / COUNT(*)) AS BIGINT) AS wm,
             CAST(ceil(SUM(strlen(match_id::VARCHAR)) / COUNT(*)) AS BIGINT) AS wi FROM r),
d AS (SELECT COUNT(DISTINCT playlist_id) AS p, COUNT(DISTINCT mapid) AS m, COUNT(DISTINCT match_id) AS i,
             COUNT(DISTINCT (playlist_id, mapid)) AS pm, COUNT(DISTINCT (playlist_id, match_id)) AS pi,
             COUNT(DISTINCT (mapid, match_id)) AS mi, COUNT(DISTINCT (playlist_id, mapid, match_id)) AS a FROM r),
o AS (
  SELECT 'playlist_id,mapid,match_id' AS sort_order, [p, pm, a] AS runs, p * wp + pm * wm + a * wi AS cost FROM d, w
  UNION ALL SELECT 'playlist_id,match_id,mapid', [p, pi, a], p * wp + pi * wi + a * wm FROM d, w
  UNION ALL SELECT 'mapid,playlist_id,match_id', [m, pm, a], m * wm + pm * wp + a * wi FROM d, w
  UNION ALL SELECT 'mapid,match_id,playlist_id', [m, mi, a], m * wm + mi * wi + a * wp FROM d, w
  UNION ALL SELECT 'match_id,playlist_id,mapid', [i, pi, a], i * wi + pi * wp + a * wm FROM d, w
  UNION ALL SELECT 'match_id,mapid,playlist_id', [i, mi, a], i * wi + mi * wm + a * wp FROM d, w)
SELECT sort_order, array_to_string(runs, ',') AS runs, CAST(cost AS BIGINT) AS cost,
       CAST(row_number() OVER (ORDER BY cost, sort_order) AS INTEGER) AS place,
       row_number() OVER (ORDER BY cost, sort_order) = 1 AS chosen
FROM o""",
    "year_pruned_join": """
SELECT c.c_nationkey, COUNT(*) AS n_orders, CAST(SUM(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
       strftime(MIN(o.o_orderdate), '%Y-%m-%d') AS first_day, strftime(MAX(o.o_orderdate), '%Y-%m-%d') AS last_day
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_orderdate >= DATE '1996-03-01' AND o.o_orderdate < DATE '1997-10-01' GROUP BY 1""",
    "date_pruned_join": """
WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem
              WHERE l_quantity = 50 AND l_discount = 0.1 AND year(l_shipdate) = 1998)
SELECT strftime(day, '%Y-%m-%d') AS day, COUNT(*) AS n_orders,
       CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders JOIN days ON CAST(o_orderdate AS DATE) = day GROUP BY day""",
    "match_questions": f"""WITH {MATCH}
(SELECT 'player_most_kills_per_game' AS question, player_gamertag AS answer, AVG(kills) AS value
 FROM mf GROUP BY player_gamertag ORDER BY value DESC, answer LIMIT 1)
UNION ALL
(SELECT 'playlist_most_played', playlist_id, CAST(COUNT(DISTINCT match_id) AS DOUBLE) AS value
 FROM mf GROUP BY playlist_id ORDER BY value DESC, playlist_id LIMIT 1)
UNION ALL
(SELECT 'map_most_played', map_name, CAST(COUNT(DISTINCT match_id) AS DOUBLE) AS value
 FROM mf GROUP BY map_name ORDER BY value DESC, map_name LIMIT 1)
UNION ALL
(SELECT 'map_most_killing_sprees', map_name, CAST(SUM(killing_sprees) AS DOUBLE) AS value
 FROM mf GROUP BY map_name ORDER BY value DESC, map_name LIMIT 1)""",
}
