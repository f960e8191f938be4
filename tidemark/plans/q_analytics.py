"""Registered queries: dashboards, trends, funnel, game analytics, graph, joins, rollups, dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import STANDIN_REFERRER_RULES, pattern_class
from ..functions.numeric import cents
from ..operators import cubes, graph, rollups, trends
from ..operators.dedupe import dedupe_rows, keep_first
from ..operators.funnel import funnel
from ..plans.joins import in_small_tasks
from ..session import staging_path
from ..sources import adapters
from ..sources.tables import Tables

FUNNEL_TARGET = "signup"
FUNNEL_MIN_EVENTS = 100
TREND_MIN_TOTAL = 30  # the reference's 500 leaves nothing at these scales
STREAK_POINTS = 10
STRETCH_GAMES = 90
# Total order for the keyed dedupe: line numbers repeat within an order in the stand-in data,
# and rows equal on all of these give identical outputs.
DETAILS_ORDER = ("l_linenumber", "l_partkey", "l_shipdate", "pts", "start_position")


def _s(c: str) -> F.Column:
    return F.col(c).cast("string").alias(c)


def events_devices(t: Tables, how: str = "inner") -> DataFrame:
    return adapters.web_events(t).join(adapters.devices(t), "device_id", how)


# --- A3 device dashboard ---

def q_device_hits_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ("os_type", "device_type", "browser_type")
    ev = events_devices(Tables(spark, sf_dir)).select(*[F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in dims])
    # Pre-aggregate to the finest set, so the Expand multiplies one row per combination.
    finest = ev.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    return cubes.grouping_sets_report(
        finest,
        dims=list(dims),
        sets=[("os_type", "device_type", "browser_type"), ("browser_type",), ("os_type",), ("device_type",)],
        labels=["os_type__device_type__browser", "browser_type", "os_type", "device_type"],
        measures=[F.sum("n").cast("long").alias("number_of_hits")],
        fill="(overall)",
    )


# --- A4 trends, P11 referrer channel ---

def channel_events(t: Tables, how: str = "inner") -> DataFrame:
    ev = events_devices(t, how)
    return ev.withColumn("referrer", pattern_class(F.col("referrer"), STANDIN_REFERRER_RULES))


def rolling_hits(spark: SparkSession, sf_dir: str, calendar: bool) -> DataFrame:
    ev = channel_events(Tables(spark, sf_dir))
    daily = ev.groupBy("referrer", "url", "event_date").agg(F.count(F.lit(1)).alias("num_hits"))
    out = trends.rolling_counts(daily, ["referrer", "url"], "event_date", "num_hits", TREND_MIN_TOTAL, calendar)
    # previous_week_count is NULL for the first week (no rows in the frame): carried as a
    # double so missing values stay NULL/NaN rather than turning a count column into floats
    # on some rows only.
    return out.where(F.col("referrer").isNotNull()).select(
        "referrer", "url", _s("event_date"), "num_hits", "month_total", "running_total", "total",
        "weekly_rolling_count", F.col("previous_week_count").cast("double").alias("previous_week_count"),
        "pct_of_month", "pct_of_total",
    )


def q_rolling_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_hits(spark, sf_dir, calendar=False)


def q_rolling_hits_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_hits(spark, sf_dir, calendar=True)


def q_referrer_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = adapters.web_events(Tables(spark, sf_dir))
    ch = ev.select("referrer", pattern_class(F.col("referrer"), STANDIN_REFERRER_RULES).alias("channel"))
    return ch.groupBy("channel").agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("referrer").alias("n_referrers"))


# --- A5 funnel ---

def q_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = adapters.web_events(Tables(spark, sf_dir))
    return funnel(ev, "user_id", "event_time", "url", FUNNEL_TARGET, FUNNEL_MIN_EVENTS)


# --- game facts: dedupe, cube, stretch, streak ---

def deduped_details(t: Tables) -> DataFrame:
    """Details are read by several parts of most queries: they are written once."""
    def details() -> DataFrame:
        one = keep_first(adapters.box_scores(t), ["player_id", "game_id"], list(DETAILS_ORDER))
        return adapters.with_player_team(t, one)

    return in_small_tasks(t.lineitem, details, staging_path(t.spark, "game-details"))


def game_facts(t: Tables) -> DataFrame:
    return deduped_details(t).join(adapters.game_dates(t), "game_id")


def team_games(facts: DataFrame) -> DataFrame:
    """Team-game grain: a team won when its summed points are the game's maximum (ties: all win).
    Aggregated before the per-game window, so a game's window holds at most one row per team."""
    from pyspark.sql import Window

    tg = facts.groupBy("game_id", "team_id", "team_abbreviation", "game_date").agg(
        F.sum("pts").alias("team_pts"), F.min("player_id").alias("rep_player")
    )
    return tg.withColumn("won", F.col("team_pts") == F.max("team_pts").over(Window.partitionBy("game_id")))


def q_game_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return in_small_tasks(t.lineitem, lambda: game_cube(game_facts(t)), staging_path(spark, "game-cube"))


def game_cube(facts: DataFrame) -> DataFrame:
    tg = team_games(facts).select("game_id", "team_id", "won", "rep_player")
    # a player wins each game that the team wins; a team's win counts once, at its first player
    won = F.col("won").cast("int")
    once = F.when(F.col("player_id") == F.col("rep_player"), won).otherwise(0)
    f = facts.join(tg, ["game_id", "team_id"]).withColumn("player_win", won).withColumn("team_win", once)
    dims = ["player_name", "team_abbreviation", "season"]
    # Pre-aggregate to the finest grain of all sets (player, team, season) before the Expand.
    # Dimensions are labels: season as text, rolled-up dimensions shown as '(overall)'.
    f = f.withColumn("season", F.col("season").cast("string"))
    finest = f.groupBy(*dims).agg(
        F.sum("pts").alias("pts"), F.count(F.lit(1)).alias("n"),
        F.sum("player_win").alias("player_wins"), F.sum("team_win").alias("team_wins"),
    )
    wins = F.when(F.grouping("player_name") == 0, F.sum("player_wins")).otherwise(F.sum("team_wins"))
    return cubes.grouping_sets_report(
        finest,
        dims=dims,
        sets=[("player_name", "team_abbreviation"), ("player_name", "season"), ("team_abbreviation",)],
        labels=["player_team", "player_season", "team"],
        measures=[
            F.sum("pts").alias("total_points"),
            F.sum("n").cast("long").alias("games"),
            wins.cast("long").alias("team_wins"),
        ],
        fill="(overall)",
    )


def q_best_90_game_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    out = in_small_tasks(t.lineitem, lambda: trends.best_stretch(
        team_games(game_facts(t)), ["team_abbreviation"], ["game_date", "game_id"], F.col("won"), STRETCH_GAMES,
    ), staging_path(spark, "best-stretch"))
    return out.select("team_abbreviation", F.col("rows").alias("games"), F.col(f"best_{STRETCH_GAMES}").alias("best_90_game_wins"))


def q_longest_scoring_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    out = in_small_tasks(t.lineitem, lambda: trends.longest_streak(
        game_facts(t), ["player_name"], ["game_date", "game_id"], F.col("pts") > STREAK_POINTS,
    ), staging_path(spark, "longest-streak"))
    return out.select("player_name", F.col("rows").alias("games"), "longest_streak")


def q_dedupe_game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduped_details(Tables(spark, sf_dir)).select(
        "game_id", "player_id", "player_name", "team_id", "team_abbreviation", "pts", "start_position", "l_linenumber"
    )


def q_dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    gd = adapters.game_details(Tables(spark, sf_dir))
    return dedupe_rows(gd.select("game_id", "player_id", "team_abbreviation", "start_position", "pts"))


# --- graph ---

def q_team_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = graph.team_vertices(adapters.teams(Tables(spark, sf_dir)))
    p = F.col("properties")
    return v.select(
        "identifier", "type",
        *[p[k].alias(k) for k in ("abbreviation", "nickname", "city", "arena", "year_founded")],
    )


def q_player_game_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = graph.player_game_edges(deduped_details(Tables(spark, sf_dir)))
    p = F.col("properties")
    return e.select(
        "subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type",
        *[p[k].alias(k) for k in ("start_position", "pts", "team_id", "team_abbreviation")],
    )


def q_player_player_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = graph.player_player_edges(deduped_details(Tables(spark, sf_dir)))
    return e.select("subject_identifier", "object_identifier", "edge_type", "num_games", "subject_points", "object_points")


def graph_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of the whole graph: player, game and team vertices; plays_in,
    shares_team and plays_against edges."""
    details = deduped_details(t)  # read by five parts of the graph
    facts = details.join(adapters.game_dates(t), "game_id")
    players = details.groupBy("player_id").agg(
        F.min("player_name").alias("player_name"), F.count(F.lit(1)).alias("games"), F.sum("pts").alias("pts")
    )
    games = facts.groupBy("game_id").agg(
        F.min("season").alias("season"), F.count(F.lit(1)).alias("players"), F.sum("pts").alias("pts")
    )
    v = (
        graph.vertices(players, "player_id", "player", graph.properties(player_name="player_name", games="games", pts="pts"))
        .unionByName(graph.vertices(games, "game_id", "game", graph.properties(season="season", players="players", pts="pts")))
        .unionByName(graph.team_vertices(adapters.teams(t)))
        .withColumn("identifier", F.col("identifier").cast("string"))
    )
    cols = ["subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type", "properties"]
    e = (
        graph.player_game_edges(details).select(*cols)
        .unionByName(graph.player_player_edges(details).select(*cols))
        .unionByName(graph.plays_on_edges(details).select(*cols))
    )
    return v, e


def _props(df: DataFrame, *names: str) -> DataFrame:
    """The map of properties as one text of ``name=value`` in the order of ``names``."""
    parts = [F.concat(F.lit(f"{n}="), F.col("properties")[n]) for n in names]
    return df.withColumn("properties", F.concat_ws(";", *parts))


VERTEX_PROPERTIES = ("player_name", "games", "pts", "season", "players", "abbreviation", "nickname", "city", "arena", "year_founded")
EDGE_PROPERTIES = ("start_position", "pts", "team_id", "team_abbreviation", "num_games", "subject_points", "object_points")


def q_graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _props(graph_tables(Tables(spark, sf_dir))[0], *VERTEX_PROPERTIES)


def q_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _props(graph_tables(Tables(spark, sf_dir))[1], *EDGE_PROPERTIES)


def q_graph_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and key counts per vertex and edge type (the key uniqueness check of the DDL)."""
    t = Tables(spark, sf_dir)
    return in_small_tasks(t.lineitem, lambda: graph_counts(*graph_tables(t)), staging_path(spark, "graph-counts"))


def graph_counts(v: DataFrame, e: DataFrame) -> DataFrame:
    vk = v.select(F.lit("vertex").alias("kind"), "type", F.concat_ws("|", "identifier", "type").alias("key"))
    ek = e.select(
        F.lit("edge").alias("kind"), F.col("edge_type").alias("type"),
        F.concat_ws("|", "subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type").alias("key"),
    )
    return vk.unionByName(ek).groupBy("kind", "type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("key").alias("n_keys")
    )


# --- joins, projections, G1 ---

def q_events_with_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events_devices(Tables(spark, sf_dir))
    return ev.select(
        "event_id", "user_id", "device_id", F.upper("browser_type").alias("browser"), "os_type", "device_type",
        F.coalesce(F.col("referrer"), F.lit("unknown")).alias("referrer"), "url",
    )


def q_left_join_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events_devices(Tables(spark, sf_dir), "left")
    return ev.select("event_id", "device_id", "browser_type", "os_type", "device_type")


def q_daily_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = adapters.web_events(Tables(spark, sf_dir))
    return ev.groupBy(F.col("event_date").cast("string").alias("event_date"), "host").agg(
        F.count(F.lit(1)).alias("num_hits"),
        F.countDistinct("user_id").alias("n_users"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.sum(cents(F.col("value"))).alias("value_cents"),
    )


def q_top_k(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Top-k customers by revenue (a limit that is the feature; ties broken by key).
    Revenue in 1e-4 units from integer cents x integer discount percent (exact)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_extendedprice", "l_discount")
    rev = cents(F.col("l_extendedprice")) * (100 - F.round(F.col("l_discount") * 100).cast("long"))
    per_order = li.groupBy("l_orderkey").agg(F.sum(rev).alias("revenue_e4"))
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    per_cust = per_order.join(o, "l_orderkey").groupBy("o_custkey").agg(F.sum("revenue_e4").alias("revenue_e4"))
    top = per_cust.orderBy(F.desc("revenue_e4"), F.asc("o_custkey")).limit(k)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return top.join(c, "o_custkey").select(F.col("o_custkey").alias("c_custkey"), "c_name", "revenue_e4")


# --- A10 rollups ---

def q_events_aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = rollups.events_aggregated(adapters.web_events(Tables(spark, sf_dir)))
    return agg.select("user_id", "device_id", "event_counts", F.array_join("host_array", ",").alias("host_array"))


def q_user_device_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = rollups.events_aggregated(adapters.web_events(Tables(spark, sf_dir)))
    r = rollups.user_device_rollup(agg)
    return r.select("user_id", "total_hits", "max_device_hits", "n_devices", "first_device_id")


def q_device_user_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    agg = rollups.events_aggregated(adapters.web_events(t))
    return rollups.device_user_rollup(agg, adapters.devices(t)).select("device_id", "device_type", "n_users", "total_hits")


def q_shared_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rollups of one persisted aggregate, stored before it is let go, as one list of totals."""
    t = Tables(spark, sf_dir)
    users, devices = staging_path(spark, "user-rollup"), staging_path(spark, "device-rollup")
    with rollups.Rollups(adapters.web_events(t), adapters.devices(t)) as both:
        both.write(users, devices)
    of_users = spark.read.parquet(users).select(
        F.lit("user").alias("kind"), F.col("user_id").alias("id"), "total_hits", F.col("n_devices").alias("n_others"))
    of_devices = spark.read.parquet(devices).select(
        F.lit("device").alias("kind"), F.col("device_id").alias("id"), "total_hits", F.col("n_users").alias("n_others"))
    return of_users.unionByName(of_devices)


QUERIES = {
    "device_hits_grouping_sets": q_device_hits_grouping_sets,
    "rolling_hits": q_rolling_hits,
    "rolling_hits_calendar": q_rolling_hits_calendar,
    "referrer_channel": q_referrer_channel,
    "funnel": q_funnel,
    "game_grouping_sets": q_game_grouping_sets,
    "best_90_game_stretch": q_best_90_game_stretch,
    "longest_scoring_streak": q_longest_scoring_streak,
    "dedupe_game_details": q_dedupe_game_details,
    "dedupe_rows": q_dedupe_rows,
    "team_vertices": q_team_vertices,
    "player_game_edges": q_player_game_edges,
    "player_player_edges": q_player_player_edges,
    "graph_tables": q_graph_tables,
    "graph_vertices": q_graph_vertices,
    "graph_edges": q_graph_edges,
    "events_with_devices": q_events_with_devices,
    "left_join_devices": q_left_join_devices,
    "daily_hits": q_daily_hits,
    "top_k": q_top_k,
    "events_aggregated": q_events_aggregated,
    "user_device_rollup": q_user_device_rollup,
    "device_user_rollup": q_device_user_rollup,
    "shared_rollups": q_shared_rollups,
}

# ----------------------------------------------------------------------------------------------
# Oracles
# ----------------------------------------------------------------------------------------------

WEB = """
pg AS (SELECT page_id, MIN(url) AS referrer FROM pages GROUP BY 1),
we AS (
  SELECT e.event_id, e.user_id, e.ts AS event_time, e.event_type AS url, e.value,
         e.user_id * 14 + CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS device_id,
         'host_' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS VARCHAR) AS host,
         CAST(e.ts AS DATE) AS event_date, pg.referrer
  FROM events e LEFT JOIN pg ON pg.page_id = e.user_id * 2 + CAST(json_extract_string(e.props, '$.k') AS BIGINT)
),
dev AS (SELECT p_partkey AS device_id, p_brand AS browser_type, p_type AS os_type,
               split_part(p_name, ' ', 2) AS device_type FROM part)"""

CHANNEL = """CASE WHEN {c} LIKE '%//m.%' THEN 'Mobile' WHEN {c} LIKE '%//blog.%' THEN 'Blog'
     WHEN {c} LIKE '%example.com%' THEN 'Example COM' WHEN {c} LIKE '%example.net%' THEN 'Example NET'
     ELSE {c} END"""

GAMES = """
gd AS (
  SELECT l.l_orderkey AS game_id, l.l_suppkey AS player_id, s.s_name AS player_name, s.s_nationkey AS team_id,
         n.n_name AS team_abbreviation, l.l_quantity AS pts, l.l_linestatus AS start_position, l.l_linenumber,
         ROW_NUMBER() OVER (PARTITION BY l.l_suppkey, l.l_orderkey
                            ORDER BY l.l_linenumber, l.l_partkey, l.l_shipdate, l.l_quantity, l.l_linestatus) AS rn
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
),
facts AS (
  SELECT g.*, CAST(o.o_orderdate AS DATE) AS game_date, CAST(year(o.o_orderdate) AS INTEGER) AS season
  FROM gd g JOIN orders o ON o.o_orderkey = g.game_id WHERE g.rn = 1
),
tg AS (
  SELECT game_id, team_id, team_abbreviation, game_date, SUM(pts) AS team_pts, MIN(player_id) AS rep
  FROM facts GROUP BY 1, 2, 3, 4
),
tgw AS (SELECT *, team_pts = MAX(team_pts) OVER (PARTITION BY game_id) AS won FROM tg)"""

TEAMS = """
teams AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS team_id, n.n_name AS abbreviation, s.s_name AS nickname, r.r_name AS city,
         n.n_name || ' Arena' AS arena, 1900 + s.s_suppkey % 100 AS yearfounded,
         ROW_NUMBER() OVER (PARTITION BY n.n_nationkey ORDER BY s.s_name DESC) AS rn
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

PAIRS = """
pairs AS (
  SELECT a.player_id AS sid, b.player_id AS oid,
         CASE WHEN a.team_abbreviation = b.team_abbreviation THEN 'shares_team' ELSE 'plays_against' END AS edge_type,
         COUNT(*) AS num_games, SUM(a.pts) AS subject_points, SUM(b.pts) AS object_points
  FROM facts a JOIN facts b ON a.game_id = b.game_id AND a.player_id > b.player_id AND a.player_name <> b.player_name
  GROUP BY 1, 2, 3
)"""

AGG = """
agg AS (SELECT user_id, device_id, COUNT(*) AS event_counts,
               string_agg(DISTINCT host, ',' ORDER BY host) AS host_array FROM we GROUP BY 1, 2)"""

ORACLES = {
    # Four plain counts, one for each level. Level names and '(overall)' are fixed values.
    "device_hits_grouping_sets": f"""WITH {WEB},
seen AS (SELECT d.os_type AS os, d.device_type AS kind, d.browser_type AS browser FROM we JOIN dev d USING (device_id)),
named AS (SELECT COALESCE(os, 'unknown') AS os, COALESCE(kind, 'unknown') AS kind, COALESCE(browser, 'unknown') AS browser
          FROM seen)
SELECT 'os_type__device_type__browser' AS aggregation_level, os AS os_type, kind AS device_type, browser AS browser_type,
       COUNT(*) AS number_of_hits FROM named GROUP BY os, kind, browser
UNION ALL SELECT 'os_type', os, '(overall)', '(overall)', COUNT(*) FROM named GROUP BY os
UNION ALL SELECT 'device_type', '(overall)', kind, '(overall)', COUNT(*) FROM named GROUP BY kind
UNION ALL SELECT 'browser_type', '(overall)', '(overall)', browser, COUNT(*) FROM named GROUP BY browser""",
    # Each day of a (channel, page) against the others of its pair: by month, and by its place among them.
    "rolling_hits": f"""WITH {WEB},
hits AS (SELECT {CHANNEL.format(c='we.referrer')} AS channel, we.url AS page, we.event_date AS day, COUNT(*) AS n
         FROM we SEMI JOIN dev USING (device_id) WHERE we.referrer IS NOT NULL GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY channel, page ORDER BY day) AS place FROM hits)
SELECT x.channel AS referrer, x.page AS url, CAST(x.day AS VARCHAR) AS event_date, x.n AS num_hits,
       CAST(SUM(o.n) FILTER (WHERE year(o.day) = year(x.day) AND month(o.day) = month(x.day)) AS BIGINT) AS month_total,
       CAST(SUM(o.n) FILTER (WHERE o.day <= x.day) AS BIGINT) AS running_total,
       CAST(SUM(o.n) AS BIGINT) AS total,
       CAST(SUM(o.n) FILTER (WHERE x.place - o.place BETWEEN 0 AND 6) AS BIGINT) AS weekly_rolling_count,
       CAST(SUM(o.n) FILTER (WHERE x.place - o.place BETWEEN 7 AND 13) AS DOUBLE) AS previous_week_count,
       x.n / CAST(SUM(o.n) FILTER (WHERE year(o.day) = year(x.day) AND month(o.day) = month(x.day)) AS DOUBLE)
         AS pct_of_month,
       x.n / CAST(SUM(o.n) AS DOUBLE) AS pct_of_total
FROM placed x JOIN placed o ON o.channel = x.channel AND o.page = x.page
GROUP BY x.channel, x.page, x.day, x.n, x.place HAVING SUM(o.n) > 30""",
    # The same with days in place of rows.
    "rolling_hits_calendar": f"""WITH {WEB},
hits AS (SELECT {CHANNEL.format(c='we.referrer')} AS channel, we.url AS page, we.event_date AS day, COUNT(*) AS n
         FROM we SEMI JOIN dev USING (device_id) WHERE we.referrer IS NOT NULL GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY channel, page ORDER BY day) AS place FROM hits)
SELECT x.channel AS referrer, x.page AS url, CAST(x.day AS VARCHAR) AS event_date, x.n AS num_hits,
       CAST(SUM(o.n) FILTER (WHERE year(o.day) = year(x.day) AND month(o.day) = month(x.day)) AS BIGINT) AS month_total,
       CAST(SUM(o.n) FILTER (WHERE o.day <= x.day) AS BIGINT) AS running_total,
       CAST(SUM(o.n) AS BIGINT) AS total,
       CAST(SUM(o.n) FILTER (WHERE x.day - o.day BETWEEN 0 AND 6) AS BIGINT) AS weekly_rolling_count,
       CAST(SUM(o.n) FILTER (WHERE x.day - o.day BETWEEN 7 AND 13) AS DOUBLE) AS previous_week_count,
       x.n / CAST(SUM(o.n) FILTER (WHERE year(o.day) = year(x.day) AND month(o.day) = month(x.day)) AS DOUBLE)
         AS pct_of_month,
       x.n / CAST(SUM(o.n) AS DOUBLE) AS pct_of_total
FROM placed x JOIN placed o ON o.channel = x.channel AND o.page = x.page
GROUP BY x.channel, x.page, x.day, x.n, x.place HAVING SUM(o.n) > 30""",
    "referrer_channel": f"""WITH {WEB}
SELECT {CHANNEL.format(c='referrer')} AS channel, COUNT(*) AS n_events, COUNT(DISTINCT referrer) AS n_referrers
FROM we GROUP BY 1""",
    # An event counts if a later one follows on its day; it converts if a later one there is the target.
    "funnel": """WITH
visits AS (SELECT DISTINCT user_id AS who, event_type AS page, ts AS at FROM events WHERE user_id IS NOT NULL),
judged AS (
  SELECT page,
         EXISTS (SELECT 1 FROM visits l WHERE l.who = v.who AND l.at > v.at AND l.at::DATE = v.at::DATE) AS followed,
         EXISTS (SELECT 1 FROM visits l WHERE l.who = v.who AND l.at > v.at AND l.at::DATE = v.at::DATE
                                          AND l.page = 'signup') AS signed_up
  FROM visits v
)
SELECT page AS url, COUNT(*) AS n_events, CAST(COUNT(*) FILTER (WHERE signed_up) AS DOUBLE) / COUNT(*) AS conversion_rate
FROM judged WHERE followed GROUP BY page
HAVING COUNT(*) > 100 AND COUNT(*) FILTER (WHERE signed_up) > 0""",
    # Wins are distinct games won at every level, counted apart for each.
    "game_grouping_sets": f"""WITH {GAMES},
played AS (SELECT f.player_name AS player, f.team_abbreviation AS team, CAST(f.season AS VARCHAR) AS season, f.pts, f.game_id,
                  CASE WHEN t.won THEN f.game_id END AS won_game
           FROM facts f JOIN tgw t USING (game_id, team_id))
SELECT 'player_team' AS aggregation_level, player AS player_name, team AS team_abbreviation, '(overall)' AS season,
       SUM(pts) AS total_points, COUNT(*) AS games, COUNT(DISTINCT won_game) AS team_wins FROM played GROUP BY player, team
UNION ALL SELECT 'player_season', player, '(overall)', season, SUM(pts), COUNT(*), COUNT(DISTINCT won_game)
  FROM played GROUP BY player, season
UNION ALL SELECT 'team', '(overall)', team, '(overall)', SUM(pts), COUNT(*), COUNT(DISTINCT won_game)
  FROM played GROUP BY team""",
    "best_90_game_stretch": f"""WITH {GAMES}
SELECT team_abbreviation, COUNT(*) AS games, CAST(MAX(w) AS BIGINT) AS best_90_game_wins FROM (
  SELECT team_abbreviation,
         SUM(CASE WHEN won THEN 1 ELSE 0 END) OVER (PARTITION BY team_abbreviation ORDER BY game_date, game_id
                                                    ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS w
  FROM tgw) GROUP BY 1""",
    "longest_scoring_streak": f"""WITH {GAMES},
s AS (SELECT player_name, pts > 10 AS hit,
             ROW_NUMBER() OVER (PARTITION BY player_name ORDER BY game_date, game_id)
           - ROW_NUMBER() OVER (PARTITION BY player_name, pts > 10 ORDER BY game_date, game_id) AS grp
      FROM facts),
runs AS (SELECT player_name, grp, COUNT(*) AS n FROM s WHERE hit GROUP BY 1, 2)
SELECT p.player_name, p.games, CAST(COALESCE(r.longest, 0) AS BIGINT) AS longest_streak
FROM (SELECT player_name, COUNT(*) AS games FROM facts GROUP BY 1) p
LEFT JOIN (SELECT player_name, MAX(n) AS longest FROM runs GROUP BY 1) r USING (player_name)""",
    "dedupe_game_details": f"""WITH {GAMES}
SELECT game_id, player_id, player_name, team_id, team_abbreviation, pts, start_position, l_linenumber
FROM gd WHERE rn = 1""",
    "dedupe_rows": f"""WITH {GAMES}
SELECT DISTINCT game_id, player_id, team_abbreviation, start_position, pts FROM gd""",
    "team_vertices": f"""WITH {TEAMS}
SELECT team_id AS identifier, 'team' AS type, abbreviation, nickname, city, arena,
       CAST(yearfounded AS VARCHAR) AS year_founded
FROM teams WHERE rn = 1""",
    "player_game_edges": f"""WITH {GAMES}
SELECT CAST(player_id AS VARCHAR) AS subject_identifier, 'player' AS subject_type,
       CAST(game_id AS VARCHAR) AS object_identifier, 'game' AS object_type, 'plays_in' AS edge_type,
       start_position, CAST(pts AS VARCHAR) AS pts, CAST(team_id AS VARCHAR) AS team_id, team_abbreviation
FROM gd WHERE rn = 1""",
    "player_player_edges": f"""WITH {GAMES}, {PAIRS}
SELECT CAST(sid AS VARCHAR) AS subject_identifier, CAST(oid AS VARCHAR) AS object_identifier, edge_type,
       num_games, subject_points, object_points FROM pairs""",
    "graph_tables": f"""WITH {GAMES}, {PAIRS}, {TEAMS}
SELECT 'vertex' AS kind, 'player' AS type, COUNT(DISTINCT player_id) AS n_rows, COUNT(DISTINCT player_id) AS n_keys
FROM facts
UNION ALL SELECT 'vertex', 'game', COUNT(DISTINCT game_id), COUNT(DISTINCT game_id) FROM facts
UNION ALL SELECT 'vertex', 'team', COUNT(*), COUNT(*) FROM teams WHERE rn = 1
UNION ALL SELECT 'edge', 'plays_in', COUNT(*), COUNT(*) FROM facts
UNION ALL SELECT 'edge', 'plays_on', COUNT(*), COUNT(*) FROM (SELECT DISTINCT player_id, team_id FROM facts)
UNION ALL SELECT 'edge', edge_type, COUNT(*), COUNT(*) FROM pairs GROUP BY edge_type""",
    "graph_vertices": f"""WITH {GAMES}, {TEAMS}
SELECT CAST(player_id AS VARCHAR) AS identifier, 'player' AS type,
       'player_name=' || MIN(player_name) || ';games=' || COUNT(*) || ';pts=' || CAST(SUM(pts) AS VARCHAR) AS properties
FROM facts GROUP BY player_id
UNION ALL SELECT CAST(game_id AS VARCHAR), 'game',
       'pts=' || CAST(SUM(pts) AS VARCHAR) || ';season=' || MIN(season) || ';players=' || COUNT(*) FROM facts GROUP BY game_id
UNION ALL SELECT CAST(team_id AS VARCHAR), 'team', 'abbreviation=' || abbreviation || ';nickname=' || nickname || ';city=' || city
       || ';arena=' || arena || ';year_founded=' || yearfounded FROM teams WHERE rn = 1""",
    "graph_edges": f"""WITH {GAMES}, {PAIRS}
SELECT CAST(player_id AS VARCHAR) AS subject_identifier, 'player' AS subject_type, CAST(game_id AS VARCHAR) AS object_identifier,
       'game' AS object_type, 'plays_in' AS edge_type,
       'start_position=' || start_position || ';pts=' || CAST(pts AS VARCHAR) || ';team_id=' || team_id
         || ';team_abbreviation=' || team_abbreviation AS properties
FROM facts
UNION ALL SELECT CAST(sid AS VARCHAR), 'player', CAST(oid AS VARCHAR), 'player', edge_type,
       'num_games=' || num_games || ';subject_points=' || CAST(subject_points AS VARCHAR) || ';object_points='
         || CAST(object_points AS VARCHAR) FROM pairs
UNION ALL SELECT CAST(player_id AS VARCHAR), 'player', CAST(team_id AS VARCHAR), 'team', 'plays_on',
       'pts=' || CAST(SUM(pts) AS VARCHAR) || ';team_abbreviation=' || MIN(team_abbreviation) || ';num_games=' || COUNT(*)
FROM facts GROUP BY player_id, team_id""",
    "events_with_devices": f"""WITH {WEB}
SELECT we.event_id, we.user_id, we.device_id, upper(d.browser_type) AS browser, d.os_type, d.device_type,
       COALESCE(we.referrer, 'unknown') AS referrer, we.url
FROM we JOIN dev d ON d.device_id = we.device_id""",
    "left_join_devices": f"""WITH {WEB}
SELECT we.event_id, we.device_id, d.browser_type, d.os_type, d.device_type
FROM we LEFT JOIN dev d ON d.device_id = we.device_id""",
    "daily_hits": f"""WITH {WEB}
SELECT CAST(event_date AS VARCHAR) AS event_date, host, COUNT(*) AS num_hits, COUNT(DISTINCT user_id) AS n_users,
       MIN(event_time) AS first_event, MAX(event_time) AS last_event,
       CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents
FROM we GROUP BY 1, 2""",
    "top_k": """WITH
li AS (SELECT l_orderkey,
              CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS r
       FROM lineitem),
pc AS (SELECT o.o_custkey, CAST(SUM(li.r) AS BIGINT) AS revenue_e4
       FROM li JOIN orders o ON o.o_orderkey = li.l_orderkey GROUP BY 1)
SELECT pc.o_custkey AS c_custkey, c.c_name, pc.revenue_e4
FROM pc JOIN customer c ON c.c_custkey = pc.o_custkey
ORDER BY pc.revenue_e4 DESC, pc.o_custkey LIMIT 10""",
    "events_aggregated": f"WITH {WEB}, {AGG} SELECT * FROM agg",
    "user_device_rollup": f"""WITH {WEB}, {AGG}
SELECT user_id, CAST(SUM(event_counts) AS BIGINT) AS total_hits, MAX(event_counts) AS max_device_hits,
       COUNT(*) AS n_devices, MIN(device_id) AS first_device_id
FROM agg GROUP BY 1""",
    "device_user_rollup": f"""WITH {WEB}, {AGG}
SELECT a.device_id, d.device_type, COUNT(*) AS n_users, CAST(SUM(a.event_counts) AS BIGINT) AS total_hits
FROM agg a JOIN dev d ON d.device_id = a.device_id GROUP BY 1, 2""",
    "shared_rollups": f"""WITH {WEB}, {AGG}
SELECT 'user' AS kind, user_id AS id, CAST(SUM(event_counts) AS BIGINT) AS total_hits, COUNT(*) AS n_others
FROM agg GROUP BY user_id
UNION ALL
SELECT 'device', a.device_id, CAST(SUM(a.event_counts) AS BIGINT), COUNT(*)
FROM agg a WHERE EXISTS (SELECT 1 FROM dev d WHERE d.device_id = a.device_id) GROUP BY a.device_id""",
}
