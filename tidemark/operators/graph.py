"""Property-graph vertices and edges (identifier, type, properties map<string,string>)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import keep_first


def properties(**cols: Column | str) -> Column:
    """``map(name, value, ...)`` with every value as a string (``json_build_object`` stand-in)."""
    parts = []
    for name, col in cols.items():
        c = F.col(col) if isinstance(col, str) else col
        parts += [F.lit(name), c.cast("string")]
    return F.create_map(*parts)


def vertices(df: DataFrame, id_col: str, vtype: str, props: Column) -> DataFrame:
    return df.select(F.col(id_col).alias("identifier"), F.lit(vtype).alias("type"), props.alias("properties"))


def team_vertices(teams: DataFrame, order: Sequence[str] = ("nickname",), descending: bool = True) -> DataFrame:
    """One vertex per team; the duplicate to keep is chosen by an explicit order (D10)."""
    one = keep_first(teams, ["team_id"], list(order), descending=descending)
    return vertices(
        one, "team_id", "team",
        properties(abbreviation="abbreviation", nickname="nickname", city="city", arena="arena",
                   year_founded="yearfounded"),
    )


def player_game_edges(details: DataFrame) -> DataFrame:
    """``plays_in`` edges from de-duplicated box-score rows (one per player and game)."""
    return details.select(
        F.col("player_id").cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("game_id").cast("string").alias("object_identifier"),
        F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        properties(start_position="start_position", pts="pts", team_id="team_id",
                   team_abbreviation="team_abbreviation").alias("properties"),
    )


def plays_on_edges(details: DataFrame) -> DataFrame:
    """``plays_on`` edges: a player and each team that the player has played for."""
    per_team = details.groupBy("player_id", "team_id").agg(
        F.sum("pts").alias("pts"), F.min("team_abbreviation").alias("team_abbreviation"), F.count(F.lit(1)).alias("num_games"))
    return per_team.select(
        F.col("player_id").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("team_id").cast("string").alias("object_identifier"), F.lit("team").alias("object_type"),
        F.lit("plays_on").alias("edge_type"),
        properties(pts="pts", team_abbreviation="team_abbreviation", num_games="num_games").alias("properties"),
    )


def player_player_edges(details: DataFrame, hot_roster: int | None = None, salt_buckets: int = 16) -> DataFrame:
    """``shares_team`` / ``plays_against`` edges between players of the same game, of different names.

    The edges are pairs by definition, so the join emits, per game, the pairs of its roster
    (sum of squared roster sizes — at most 7 lines per order in the stand-in data), and the
    output itself grows the same way for a game with a huge roster; nothing is capped. What is
    avoided is putting such a game in one task. By default AQE's skew join does it: a join
    partition far above the median is split on both sides and the pieces are joined by
    separate tasks. With ``hot_roster`` set, games with more players than that are salted
    explicitly — the left side's players spread over ``salt_buckets`` salts, the right side
    replicated per salt — at the cost of one more aggregation pass (roster sizes). Pairs are
    then summed per (player, player, edge type) with map-side combining. A pair can get two
    rows, one per edge type, when a player changes team.
    """
    side = details.select("game_id", "player_id", "player_name", "team_abbreviation", "pts")
    if hot_roster is None:
        marked, is_hot = side, F.lit(False)
    else:
        rosters = side.groupBy("game_id").agg(F.count(F.lit(1)).alias("_roster"))
        hot = rosters.where(F.col("_roster") > hot_roster).select("game_id", F.lit(True).alias("_hot"))
        # The hot list is the output of an aggregate: AQE sees its real size at runtime and
        # broadcasts it only when it is small.
        marked = side.join(hot, "game_id", "left")
        is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    a = marked.select(
        "game_id", "player_id", "player_name", "team_abbreviation", "pts",
        F.when(is_hot, F.abs(F.xxhash64("player_id")) % salt_buckets).otherwise(0).alias("_salt"),
    ).alias("a")
    b = marked.select(
        "game_id", "player_id", "player_name", "team_abbreviation", "pts",
        F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))).alias("_salt"),
    ).alias("b")
    pairs = a.join(
        b,
        (F.col("a.game_id") == F.col("b.game_id")) & (F.col("a._salt") == F.col("b._salt"))
        & (F.col("a.player_id") > F.col("b.player_id")) & (F.col("a.player_name") != F.col("b.player_name")),
    )
    edge_type = F.when(F.col("a.team_abbreviation") == F.col("b.team_abbreviation"), "shares_team").otherwise(
        "plays_against"
    )
    return pairs.groupBy(
        F.col("a.player_id").alias("subject_id"), F.col("b.player_id").alias("object_id"), edge_type.alias("edge_type")
    ).agg(
        F.count(F.lit(1)).alias("num_games"),
        F.sum("a.pts").alias("subject_points"),
        F.sum("b.pts").alias("object_points"),
    ).select(
        F.col("subject_id").cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("object_id").cast("string").alias("object_identifier"),
        F.lit("player").alias("object_type"),
        "edge_type",
        properties(num_games="num_games", subject_points="subject_points", object_points="object_points").alias(
            "properties"
        ),
        "num_games",
        "subject_points",
        "object_points",
    )
