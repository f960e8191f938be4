"""Map the driver's star-schema tables onto the shapes the operators consume.

Each stand-in is derived from the given tables with DataFrame operations only, so its
size grows with the data. Sides are broadcast only behind a check of their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cents, milli
from ..operators.geo import BASE_IP, long_to_ip
from ..plans.joins import bounded, bounded_broadcast
from .tables import Tables

# Fixed values of the stand-in mapping.
# host = 'host_' || k, where k is the key in the event's props
PAGES_PER_USER = 2  # page = user_id * 2 + k: all pages, and some ids beyond the last page
# ip = 10.0.0.0 + user_id * 104729 % (28 * 65536): over the /16 of each of 25 nations, and three /16 of none
IP_STRIDE, IP_SPAN = 104729, 28 << 16
DEVICES_PER_USER = 14  # device = part user_id * 14 + k: all parts, and some ids beyond the last part
ASSIST_PRIORITIES = ("1-URGENT", "2-HIGH")


def player_seasons(t: Tables) -> DataFrame:
    """(player_name, college, country, season, gp, pts, ast, reb): customers x order years.

    Orders are aggregated per (customer, year) before the join, so a hot customer is
    collapsed map-side and the join sees one row per customer-season.
    """
    orders = t.orders.select(
        "o_custkey", F.year("o_orderdate").alias("season"), cents(F.col("o_totalprice")).alias("c"), "o_orderpriority"
    )
    per_season = orders.groupBy("o_custkey", "season").agg(
        F.count(F.lit(1)).alias("gp"),
        F.sum("c").alias("sum_c"),
        F.count_if(F.col("o_orderpriority").isin(*ASSIST_PRIORITIES)).alias("ast"),
        F.max("c").alias("max_c"),
    )
    # pts = average price / 10000 and reb = max price / 10000, to 0.001 (floor), from integer cents
    per_season = per_season.select(
        "o_custkey", "season", "gp", milli(F.col("sum_c"), F.col("gp") * 1000).alias("pts"), "ast",
        milli(F.col("max_c"), F.lit(1000)).alias("reb"),
    )
    cust = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("college"),
        F.col("c_nationkey").cast("string").alias("country"),
    )
    return per_season.join(cust, "o_custkey").select(
        "player_name", "college", "country", F.col("season").cast("int").alias("season"), "gp", "pts", "ast", "reb"
    )


def actor_films(t: Tables) -> DataFrame:
    """(actor, actorid, film, year, votes, rating, filmid): customer = actor, order = film."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("actor"))
    return o.join(c, "o_custkey").select(
        "actor",
        F.col("o_custkey").alias("actorid"),
        F.concat(F.lit("film_"), F.col("o_orderkey").cast("string")).alias("film"),
        F.year("o_orderdate").cast("int").alias("year"),
        (F.col("o_orderkey") % 1000).alias("votes"),
        milli(cents(F.col("o_totalprice")), F.lit(5000)).alias("rating"),
        F.col("o_orderkey").cast("string").alias("filmid"),
    )


def box_scores(t: Tables) -> DataFrame:
    """Box-score rows without names: game = order, player = supplier, pts = quantity.

    (player, game) repeats, so keyed dedupe is real; de-duplicate on this narrow projection
    and attach names afterwards (``with_player_team``).
    """
    return t.lineitem.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("player_id"),
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").alias("pts"),
        F.col("l_linestatus").alias("start_position"),
        "l_shipdate",
    )


def with_player_team(t: Tables, rows: DataFrame) -> DataFrame:
    """Attach player name and team (the supplier's nation) to box-score rows."""
    sup = t.supplier.select(
        F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_name"), F.col("s_nationkey").alias("team_id")
    )
    nat = t.nation.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_abbreviation"))
    return rows.join(sup, "player_id").join(bounded_broadcast(nat), "team_id")  # nation: 25 rows


def game_details(t: Tables) -> DataFrame:
    """Box-score rows with player and team names (duplicates kept)."""
    return with_player_team(t, box_scores(t))


def game_dates(t: Tables) -> DataFrame:
    """(game_id, game_date, season) from orders."""
    return t.orders.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").cast("int").alias("season"),
    )


def teams(t: Tables) -> DataFrame:
    """Team rows (several per team): team = nation, nickname = supplier name, city = region."""
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    rows = s.join(bounded_broadcast(n), s.s_nationkey == n.n_nationkey).join(
        bounded_broadcast(r), n.n_regionkey == r.r_regionkey
    )
    return rows.select(
        F.col("n_nationkey").cast("long").alias("team_id"),
        F.col("n_name").alias("abbreviation"),
        F.col("s_name").alias("nickname"),
        F.col("r_name").alias("city"),
        F.concat(F.col("n_name"), F.lit(" Arena")).alias("arena"),
        (F.lit(1900) + F.col("s_suppkey") % 100).cast("long").alias("yearfounded"),
    )


def web_events(t: Tables) -> DataFrame:
    """Web events: url = event_type, device_id = props.k, host/referrer/ip derived from keys."""
    ev = with_web_keys(t.events.select(
        "event_id", "user_id", F.col("ts").alias("event_time"), F.col("event_type").alias("url"), "value", "props",
    )).withColumn("event_date", F.to_date("event_time"))
    return ev.join(page_urls(t), "page_id", "left").drop("page_id")


def with_web_keys(events: DataFrame) -> DataFrame:
    """Device, host, ip and page of a batch or stream of events, from ``user_id`` and ``props``."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    return events.select(
        *[c for c in events.columns if c != "props"],
        (F.col("user_id") * DEVICES_PER_USER + k).alias("device_id"),
        F.concat(F.lit("host_"), k.cast("string")).alias("host"),
        F.when(F.col("user_id").isNotNull(), long_to_ip(F.col("user_id") * IP_STRIDE % IP_SPAN + BASE_IP)).alias("ip"),
        (F.col("user_id") * PAGES_PER_USER + k).alias("page_id"),
    )


def page_urls(t: Tables) -> DataFrame:
    """(page_id, referrer) of every page; the planner picks the join by its size."""
    return t.pages.groupBy("page_id").agg(F.min("url").alias("referrer"))


def devices(t: Tables) -> DataFrame:
    """Device dimension: every part, one row a key; the planner picks the join by its size."""
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return p.groupBy(F.col("p_partkey").alias("device_id")).agg(
        F.min("p_brand").alias("browser_type"),
        F.min("p_type").alias("os_type"),
        F.min(F.get(F.split("p_name", " "), 1)).alias("device_type"),
    )


def purchase_activity(t: Tables) -> DataFrame:
    """(user_id, event_date) activity for growth accounting: purchases only."""
    return (
        t.events.where(F.col("event_type") == "purchase")
        .where(F.col("user_id").isNotNull())
        .select("user_id", F.to_date("ts").alias("event_date"))
    )


# --- match stand-ins: match = order, player = supplier, map = customer nation, medal = part ---


def matches(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("mapid"))
    return o.join(bounded(c), "o_custkey").select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderpriority").alias("playlist_id"),
        F.col("mapid").cast("long").alias("mapid"),
        (F.col("o_orderkey") % 2 == 0).alias("is_team_game"),
        F.col("o_orderdate").alias("completion_date"),
    )


def match_details(t: Tables) -> DataFrame:
    """One row per (match, player); kills = summed quantity (partial aggregation map-side)."""
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity")
    return li.groupBy(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("player_"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
    ).agg(
        F.sum("l_quantity").cast("long").alias("player_total_kills"),
        F.count(F.lit(1)).alias("player_total_deaths"),
    )


def medals_matches_players(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity")
    return li.select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("player_"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
        F.col("l_partkey").alias("medal_id"),
        F.col("l_quantity").cast("long").alias("count"),
    )


def medals(t: Tables) -> DataFrame:
    """Medal dimension (one per part). Grows with the data: broadcast only behind a size check."""
    return t.part.select(F.col("p_partkey").alias("medal_id"), F.col("p_type").alias("name"))


def maps(t: Tables) -> DataFrame:
    """Map dimension = nation (25 rows)."""
    return t.nation.select(F.col("n_nationkey").cast("long").alias("mapid"), F.col("n_name").alias("name"))
