"""Registered queries: cumulative dimensions, SCD type 2, player states (players / actors stand-ins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays
from ..functions.classify import ACTOR_THRESHOLDS, STANDIN_PLAYER_THRESHOLDS, threshold_class
from ..functions.numeric import idiv
from ..operators.cumulative import cumulative_backfill, cumulative_step, history_rows
from ..operators.scd import scd_backfill, scd_increment
from ..operators.states import player_state_changes
from ..session import staging_path
from ..sources import adapters
from ..sources.tables import Tables
from .scd_store import ScdStore

PLAYER_STATS = ("gp", "pts", "ast", "reb")
PLAYER_STATICS = ("college", "country")
PLAYER_TRACKED = ("scoring_class", "is_active")


def last_season(t: Tables) -> int:
    """The league's last season: max order year (one-column scan, one scalar to the driver)."""
    return t.orders.agg(F.max(F.year("o_orderdate"))).first()[0]


def players_snapshots(t: Tables, through: int | None = None) -> DataFrame:
    ps = adapters.player_seasons(t)
    through = last_season(t) if through is None else through
    snap = cumulative_backfill(ps, ["player_name"], "season", PLAYER_STATS, PLAYER_STATICS, through=through)
    return with_scoring_class(snap)


def with_scoring_class(snap: DataFrame) -> DataFrame:
    last_pts = arrays.last(F.col("history"))["pts"]
    return snap.withColumn("scoring_class", threshold_class(last_pts, STANDIN_PLAYER_THRESHOLDS))


def _flat_players(snap: DataFrame) -> DataFrame:
    return snap.select(
        "player_name",
        "college",
        "country",
        F.col("season").cast("int").alias("season"),
        F.size("history").cast("long").alias("n_seasons"),
        arrays.join_values(F.transform("history", lambda h: h["season"])).alias("seasons_played"),
        arrays.last(F.col("history"))["pts"].alias("last_pts"),
        "scoring_class",
        F.col("periods_since_last_active").cast("int").alias("years_since_last_active"),
        "is_active",
    )


def q_players_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_players(players_snapshots(Tables(spark, sf_dir)))


def q_players_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of the last season = previous season's snapshot + that season's rows (C1)."""
    t = Tables(spark, sf_dir)
    ps = adapters.player_seasons(t)
    last = last_season(t)
    prev = cumulative_backfill(ps, ["player_name"], "season", PLAYER_STATS, PLAYER_STATICS, through=last - 1)
    prev = prev.where(F.col("season") == last - 1)
    step = cumulative_step(prev, ps, ["player_name"], "season", PLAYER_STATS, PLAYER_STATICS, as_of=last)
    return _flat_players(with_scoring_class(step))


def _scd_out(df: DataFrame) -> DataFrame:
    return df.select(
        "player_name", "scoring_class", "is_active",
        F.col("start_season").cast("int"), F.col("end_season").cast("int"), F.col("current_season").cast("int"),
    )


def q_scd_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    last = last_season(t)
    snaps = players_snapshots(t, last)
    return _scd_out(scd_backfill(snaps, ["player_name"], "season", PLAYER_TRACKED, as_of=last))


def q_scd_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    last = last_season(t)
    snaps = players_snapshots(t, last)
    prior = scd_backfill(snaps, ["player_name"], "season", PLAYER_TRACKED, as_of=last - 1)
    current = snaps.where(F.col("season") == last).withColumnRenamed("season", "current_season")
    return _scd_out(scd_increment(prior, current, ["player_name"], PLAYER_TRACKED, as_of=last))


def q_scd_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SCD kept in open and closed folders: the first run takes the history up to four seasons
    before the last, then each season's run adds to it."""
    t = Tables(spark, sf_dir)
    last = last_season(t)
    path = staging_path(spark, "scd-snapshots")
    players_snapshots(t, last).select("player_name", "season", *PLAYER_TRACKED).write.parquet(path)
    snaps = spark.read.parquet(path)  # each season's run reads its own rows
    store = ScdStore(spark, staging_path(spark, "scd-store"), ["player_name"], PLAYER_TRACKED, time_col="season")
    for season in (last - 4, last):
        store.run(snaps, season)
    return _scd_out(store.table().withColumnRenamed("as_of", "current_season"))


def q_player_state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = players_snapshots(Tables(spark, sf_dir))
    return player_state_changes(snaps, ["player_name"], "season").select(
        "player_name", F.col("season").cast("int"), "is_active", "state"
    )


def q_scoring_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = adapters.player_seasons(Tables(spark, sf_dir))
    return ps.select(
        "player_name", "season", "pts", threshold_class(F.col("pts"), STANDIN_PLAYER_THRESHOLDS).alias("scoring_class")
    )


def q_season_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity x every season from its first to the last (range join as explode(sequence))."""
    t = Tables(spark, sf_dir)
    ps = adapters.player_seasons(t)
    last = last_season(t)
    first = ps.groupBy("player_name").agg(F.min("season").alias("first_season"))
    spine = first.select("player_name", F.explode(F.sequence("first_season", F.lit(last))).alias("season"))
    return spine.select("player_name", F.col("season").cast("int"))


def q_unnest_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    last = last_season(t)
    last_snap = players_snapshots(t, last).where(F.col("season") == last)
    return history_rows(last_snap, ["player_name"]).select("player_name", F.col("season").cast("int"), *PLAYER_STATS)


def q_scoring_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest season's points over the first season's (a zero first value counts as 1)."""
    t = Tables(spark, sf_dir)
    last = last_season(t)
    snap = players_snapshots(t, last).where(F.col("season") == last)
    first_pts = arrays.first(F.col("history"))["pts"]
    last_pts = arrays.last(F.col("history"))["pts"]
    return snap.select(
        "player_name",
        first_pts.alias("first_pts"),
        last_pts.alias("last_pts"),
        (last_pts / F.when(first_pts == 0, F.lit(1.0)).otherwise(first_pts)).alias("improvement"),
    )


# --- actors (C7-C9): yearly film summary, quality class from the latest year's average rating ---
# The reference keeps every film in an array on the actor row. One actor-year can hold a large
# share of all films, so the history keeps a bounded summary per year (count, average rating,
# top-rated film); the film rows themselves stay in actor_films, keyed by (actorid, filmid).

ACTOR_TRACKED = ("quality_class", "is_active")


def q_actor_films_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The films of the actors' history as a child frame keyed by (actorid, year, filmid): every
    film with its votes and rating, where the reference keeps an unbounded array per actor."""
    films = adapters.actor_films(Tables(spark, sf_dir))
    return films.groupBy("actorid", "year", "filmid").agg(
        F.min("actor").alias("actor"), F.min("film").alias("film"), F.max("votes").alias("votes"), F.max("rating").alias("rating"))


def actor_years(t: Tables) -> DataFrame:
    films = adapters.actor_films(t)
    rating_milli = F.round(F.col("rating") * 1000).cast("long")
    return films.groupBy("actorid", "actor", "year").agg(
        F.max_by("filmid", F.struct(rating_milli, F.col("filmid").cast("long"))).alias("top_film"),
        F.count(F.lit(1)).alias("n_films"),
        F.sum(rating_milli).alias("_rating_sum"),
    ).select(
        "actorid", "actor", "year", "top_film", "n_films",
        (idiv(F.col("_rating_sum"), F.col("n_films")).cast("double") / 1000).alias("avg_rating"),
    )


def actors_snapshots(t: Tables, through: int | None = None) -> DataFrame:
    through = last_season(t) if through is None else through
    snap = cumulative_backfill(
        actor_years(t), ["actorid"], "year", ("top_film", "n_films", "avg_rating"), ("actor",), through=through
    )
    last = arrays.last(F.col("history"))
    return snap.withColumn("quality_class", threshold_class(last["avg_rating"], ACTOR_THRESHOLDS))


def q_actors_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = actors_snapshots(Tables(spark, sf_dir))
    last = arrays.last(F.col("history"))
    return snap.select(
        "actorid",
        "actor",
        F.col("year").cast("int"),
        F.aggregate("history", F.lit(0).cast("long"), lambda acc, h: acc + h["n_films"]).alias("n_films"),
        last["top_film"].alias("last_year_top_film"),
        last["avg_rating"].alias("last_avg_rating"),
        "quality_class",
        "is_active",
    )


def _actor_scd_out(df: DataFrame) -> DataFrame:
    return df.select(
        "actorid", "quality_class", "is_active",
        F.col("start_season").cast("int").alias("start_year"), F.col("end_season").cast("int").alias("end_year"),
        F.col("current_season").cast("int").alias("current_year"),
    )


def q_actors_scd_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    last = last_season(t)
    snaps = actors_snapshots(t, last)
    return _actor_scd_out(scd_backfill(snaps, ["actorid"], "year", ACTOR_TRACKED, as_of=last))


def q_actors_scd_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    last = last_season(t)
    snaps = actors_snapshots(t, last)
    prior = scd_backfill(snaps, ["actorid"], "year", ACTOR_TRACKED, as_of=last - 1)
    current = snaps.where(F.col("year") == last).withColumnRenamed("year", "current_season")
    return _actor_scd_out(scd_increment(prior, current, ["actorid"], ACTOR_TRACKED, as_of=last))


QUERIES = {
    "players_backfill": q_players_backfill,
    "players_step": q_players_step,
    "scd_backfill": q_scd_backfill,
    "scd_incremental": q_scd_incremental,
    "scd_store": q_scd_store,
    "player_state_changes": q_player_state_changes,
    "scoring_class": q_scoring_class,
    "season_spine": q_season_spine,
    "unnest_seasons": q_unnest_seasons,
    "scoring_improvement": q_scoring_improvement,
    "actors_cumulative": q_actors_cumulative,
    "actor_films_rows": q_actor_films_rows,
    "actors_scd_backfill": q_actors_scd_backfill,
    "actors_scd_incremental": q_actors_scd_incremental,
}

# ----------------------------------------------------------------------------------------------
# Oracles (DuckDB SQL), written from the meaning: range joins and islands, not windows of arrays.
# ----------------------------------------------------------------------------------------------

PS_CTE = """
ps AS (
  SELECT c.c_name AS player_name, c.c_mktsegment AS college, CAST(c.c_nationkey AS VARCHAR) AS country,
         CAST(year(o.o_orderdate) AS INTEGER) AS season,
         COUNT(*) AS gp,
         CAST(SUM(CAST(round(o.o_totalprice * 100) AS BIGINT)) // (COUNT(*) * 1000) AS DOUBLE) / 1000 AS pts,
         COUNT(*) FILTER (WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH')) AS ast,
         CAST(MAX(CAST(round(o.o_totalprice * 100) AS BIGINT)) // 1000 AS DOUBLE) / 1000 AS reb
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY 1, 2, 3, 4
)"""

SNAP_CTE = PS_CTE + """,
last_season AS (SELECT MAX(season) AS s FROM ps),
spine AS (
  SELECT f.player_name, CAST(g.season AS INTEGER) AS season
  FROM (SELECT player_name, MIN(season) AS first_season FROM ps GROUP BY 1) f,
       last_season l,
       LATERAL (SELECT unnest(generate_series(f.first_season, l.s)) AS season) g
),
played AS (
  SELECT s.player_name, s.season, COUNT(*) AS n_seasons,
         string_agg(CAST(p.season AS VARCHAR), ',' ORDER BY p.season) AS seasons_played,
         MAX(p.season) AS last_played, MIN(p.season) AS first_played
  FROM spine s JOIN ps p ON p.player_name = s.player_name AND p.season <= s.season
  GROUP BY 1, 2
),
snap AS (
  SELECT pl.player_name, lp.college, lp.country, pl.season, pl.n_seasons, pl.seasons_played,
         lp.pts AS last_pts,
         CASE WHEN lp.pts > 35 THEN 'star' WHEN lp.pts > 25 THEN 'good' WHEN lp.pts > 15 THEN 'average'
              ELSE 'bad' END AS scoring_class,
         pl.season - pl.last_played AS years_since_last_active,
         pl.season = pl.last_played AS is_active,
         fp.pts AS first_pts
  FROM played pl
  JOIN ps lp ON lp.player_name = pl.player_name AND lp.season = pl.last_played
  JOIN ps fp ON fp.player_name = pl.player_name AND fp.season = pl.first_played
)"""

_SNAP_COLS = ("player_name, college, country, season, n_seasons, seasons_played, last_pts, scoring_class, "
              "CAST(years_since_last_active AS INTEGER) AS years_since_last_active, is_active")

ISLANDS = """
islands AS (
  SELECT {key}, {tracked}, {time},
         ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {time})
       - ROW_NUMBER() OVER (PARTITION BY {key}, {tracked} ORDER BY {time}) AS grp
  FROM {src}
)"""

SCD_PLAYERS = "WITH " + SNAP_CTE + "," + ISLANDS.format(
    key="player_name", tracked="scoring_class, is_active", time="season", src="snap") + """
SELECT player_name, scoring_class, is_active, CAST(MIN(season) AS INTEGER) AS start_season,
       CAST(MAX(season) AS INTEGER) AS end_season, (SELECT s FROM last_season) AS current_season
FROM islands GROUP BY player_name, scoring_class, is_active, grp"""

ACTOR_YEARS_CTE = """
af AS (
  SELECT o.o_custkey AS actorid, c.c_name AS actor, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(o.o_orderkey AS VARCHAR) AS filmid,
         CAST(round(o.o_totalprice * 100) AS BIGINT) // 5000 AS rating_milli
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
),
top AS (
  SELECT actorid, year, filmid AS top_film FROM (
    SELECT actorid, year, filmid,
           ROW_NUMBER() OVER (PARTITION BY actorid, year ORDER BY rating_milli DESC, CAST(filmid AS BIGINT) DESC) AS rn
    FROM af) WHERE rn = 1
),
ay AS (
  SELECT a.actorid, a.actor, a.year, COUNT(*) AS n_films,
         CAST(SUM(a.rating_milli) // COUNT(*) AS DOUBLE) / 1000 AS avg_rating, t.top_film
  FROM af a JOIN top t ON t.actorid = a.actorid AND t.year = a.year GROUP BY a.actorid, a.actor, a.year, t.top_film
),
last_year AS (SELECT MAX(year) AS y FROM ay),
aspine AS (
  SELECT f.actorid, CAST(g.year AS INTEGER) AS year
  FROM (SELECT actorid, MIN(year) AS first_year FROM ay GROUP BY 1) f, last_year l,
       LATERAL (SELECT unnest(generate_series(f.first_year, l.y)) AS year) g
),
aplayed AS (
  SELECT s.actorid, s.year, SUM(a.n_films) AS n_films, MAX(a.year) AS last_played
  FROM aspine s JOIN ay a ON a.actorid = s.actorid AND a.year <= s.year GROUP BY 1, 2
),
asnap AS (
  SELECT p.actorid, l.actor, p.year, CAST(p.n_films AS BIGINT) AS n_films, l.top_film AS last_year_top_film,
         l.avg_rating AS last_avg_rating,
         CASE WHEN l.avg_rating > 8 THEN 'star' WHEN l.avg_rating > 7 THEN 'good'
              WHEN l.avg_rating > 6 THEN 'average' ELSE 'bad' END AS quality_class,
         p.year = p.last_played AS is_active
  FROM aplayed p JOIN ay l ON l.actorid = p.actorid AND l.year = p.last_played
)"""

SCD_ACTORS = "WITH " + ACTOR_YEARS_CTE + "," + ISLANDS.format(
    key="actorid", tracked="quality_class, is_active", time="year", src="asnap") + """
SELECT actorid, quality_class, is_active, CAST(MIN(year) AS INTEGER) AS start_year,
       CAST(MAX(year) AS INTEGER) AS end_year, (SELECT y FROM last_year) AS current_year
FROM islands GROUP BY actorid, quality_class, is_active, grp"""

ORACLES = {
    "actor_films_rows": """
SELECT o.o_custkey AS actorid, CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(o.o_orderkey AS VARCHAR) AS filmid,
       c.c_name AS actor, 'film_' || CAST(o.o_orderkey AS VARCHAR) AS film, o.o_orderkey % 1000 AS votes,
       CAST(CAST(round(o.o_totalprice * 100) AS BIGINT) // 5000 AS DOUBLE) / 1000 AS rating
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "players_backfill": f"WITH {SNAP_CTE} SELECT {_SNAP_COLS} FROM snap",
    "players_step": f"WITH {SNAP_CTE} SELECT {_SNAP_COLS} FROM snap WHERE season = (SELECT s FROM last_season)",
    "scd_backfill": SCD_PLAYERS,
    "scd_incremental": SCD_PLAYERS,
    "scd_store": SCD_PLAYERS,
    "player_state_changes": f"""WITH {SNAP_CTE}
SELECT cur.player_name, cur.season, cur.is_active,
       CASE WHEN prev.player_name IS NULL THEN 'New'
            WHEN prev.is_active AND cur.is_active THEN 'Continued Playing'
            WHEN prev.is_active AND NOT cur.is_active THEN 'Retired'
            WHEN NOT prev.is_active AND cur.is_active THEN 'Returned from Retirement'
            ELSE 'Stayed Retired' END AS state
FROM snap cur LEFT JOIN snap prev ON prev.player_name = cur.player_name AND prev.season = cur.season - 1""",
    "scoring_class": f"""WITH {PS_CTE}
SELECT player_name, season, pts,
       CASE WHEN pts > 35 THEN 'star' WHEN pts > 25 THEN 'good' WHEN pts > 15 THEN 'average' ELSE 'bad' END
         AS scoring_class
FROM ps""",
    "season_spine": f"""WITH {PS_CTE},
years AS (SELECT CAST(unnest(generate_series(MIN(season), MAX(season))) AS INTEGER) AS season FROM ps)
SELECT f.player_name, y.season
FROM (SELECT player_name, MIN(season) AS first_season FROM ps GROUP BY 1) f
JOIN years y ON y.season >= f.first_season""",
    "unnest_seasons": f"WITH {PS_CTE} SELECT player_name, season, gp, pts, ast, reb FROM ps",
    "scoring_improvement": f"""WITH {SNAP_CTE}
SELECT player_name, first_pts, last_pts,
       last_pts / CASE WHEN first_pts = 0 THEN 1.0 ELSE first_pts END AS improvement
FROM snap WHERE season = (SELECT s FROM last_season)""",
    "actors_cumulative": f"""WITH {ACTOR_YEARS_CTE}
SELECT actorid, actor, year, n_films, last_year_top_film, last_avg_rating, quality_class, is_active FROM asnap""",
    "actors_scd_backfill": SCD_ACTORS,
    "actors_scd_incremental": SCD_ACTORS,
}
