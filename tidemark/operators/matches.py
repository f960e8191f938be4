"""Match facts: bucketed fact tables joined without a shuffle, small dimensions broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast
from ..session import staging_path

BUCKETS = 16  # fixed value: bucket count of the reference's bucketed match tables
KILLING_SPREE = "PROMO"  # stand-in medal name that plays "Killing Spree"


def buckets_for(table_bytes: int, target_bytes: int = 1 << 30) -> int:
    """Power-of-two bucket count giving buckets of about ``target_bytes`` (at least 16).
    Tables joined bucket-to-bucket need the same count (or one a multiple of the other)."""
    n = 16
    while table_bytes / n > target_bytes:
        n *= 2
    return n


def write_bucketed(
    spark: SparkSession, df: DataFrame, name: str, key: str = "match_id", buckets: int = BUCKETS,
    table: str | None = None,
) -> DataFrame:
    """Write ``df`` as a bucketed, sorted table under the shared staging folder and read it back.

    Joins and aggregations on ``key`` between tables bucketed alike need no exchange. The rows
    are first hash-partitioned into ``buckets`` tasks on the same key (the same hash as the
    bucketing), so each task writes exactly one file per bucket instead of up to ``buckets``
    files per task. Size ``buckets`` to the table (``buckets_for``): 16 is the reference's
    demonstration value; at 100 TB a bucket should stay around a gigabyte.
    """
    return _write_bucketed_on(spark, df, name, [key], buckets, table)


def _write_bucketed_on(
    spark: SparkSession, df: DataFrame, name: str, keys: list[str], buckets: int, table: str | None = None
) -> DataFrame:
    table = table or f"tidemark_{name}_{uuid.uuid4().hex[:10]}"
    (
        df.repartition(buckets, *keys).write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", staging_path(spark, name))
        .saveAsTable(table)
    )
    return spark.table(table)


SALT = "_salt"


def heavy_keys(rows: DataFrame, key: str, most: int) -> DataFrame:
    """(key, salts) of the keys with more than ``most`` rows: so many salts that a share has ``most`` at
    most, on average. There are fewer than rows / ``most`` of them."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return counts.select(key, F.ceil(F.col("n") / most).cast("int").alias("salts"))


def write_salted(
    spark: SparkSession, rows: DataFrame, other: DataFrame, names: tuple[str, str], spread: str, key: str = "match_id",
    buckets: int = BUCKETS, most: int = 4_000_000,
) -> tuple[DataFrame, DataFrame]:
    """``rows`` and ``other`` bucketed alike on (``key``, salt): joined on both (see ``salted_join``) they
    need no exchange, and the rows of a heavy key lie in several buckets.

    The keys with more than ``most`` rows are counted and written once; their rows are dealt over
    salts by a hash of ``spread``, and ``other``'s rows of these keys alone are repeated for each salt.
    All other rows have salt 0, so that both tables keep their size."""
    path = staging_path(spark, f"{names[0]}-heavy")
    heavy_keys(rows, key, most).write.parquet(path)
    heavy = bounded_broadcast(spark.read.parquet(path))
    salts = F.coalesce(F.col("salts"), F.lit(1))
    dealt = rows.join(heavy, key, "left").withColumn(SALT, F.pmod(F.xxhash64(spread), salts).cast("int")).drop("salts")
    repeated = other.join(heavy, key, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return tuple(  # type: ignore[return-value]
        _write_bucketed_on(spark, df, name, [key, SALT], buckets) for df, name in ((dealt, names[0]), (repeated, names[1])))


def salted_join(rows: DataFrame, other: DataFrame, key: str = "match_id") -> DataFrame:
    """The join of two tables of ``write_salted``: each row meets the copy in its own bucket."""
    return rows.join(other, [key, SALT]).drop(SALT)


def match_facts(
    matches: DataFrame, details: DataFrame, medal_rows: DataFrame, medals: DataFrame, maps: DataFrame
) -> DataFrame:
    """(match, player) facts: kills, deaths, medals, killing sprees, playlist and map name.

    ``matches``, ``details`` and ``medal_rows`` should be bucketed alike on match_id. Medal rows
    are joined to the (size-checked) medal dimension and aggregated per (match, player) before
    the fact join; the 25-row map dimension is broadcast.
    """
    sprees = medals.select("medal_id", (F.col("name") == KILLING_SPREE).alias("is_spree"))  # a flag is shorter than a name
    named = medal_rows.join(bounded_broadcast(sprees), "medal_id")
    # The per-player aggregate reuses the match_id bucketing (no exchange, if the medals are few
    # enough to be broadcast). The (match, player) join then shuffles on both keys: co-partitioning on match_id alone would put a hot match
    # in one task (Spark's default requireAllClusterKeysForCoPartition), and AQE can split a
    # skewed (match, player) partition.
    per_player = named.groupBy("match_id", "player_gamertag").agg(
        F.sum("count").alias("n_medals"),
        F.sum(F.when(F.col("is_spree"), F.col("count")).otherwise(0)).alias("killing_sprees"),
    )
    facts = details.join(matches, "match_id").join(per_player, ["match_id", "player_gamertag"], "left")
    maps_b = bounded_broadcast(maps.select("mapid", F.col("name").alias("map_name")))
    return facts.join(maps_b, "mapid", "left").select(
        "match_id",
        "player_gamertag",
        "playlist_id",
        "map_name",
        F.col("player_total_kills").alias("kills"),
        F.col("player_total_deaths").alias("deaths"),
        F.coalesce(F.col("n_medals"), F.lit(0)).cast("long").alias("n_medals"),
        F.coalesce(F.col("killing_sprees"), F.lit(0)).cast("long").alias("killing_sprees"),
        "completion_date",
    )


def _top1(df: DataFrame, key: str, value: F.Column, question: str) -> DataFrame:
    ranked = df.groupBy(key).agg(value.cast("double").alias("value"))
    return ranked.orderBy(F.desc("value"), F.asc(key)).limit(1).select(
        F.lit(question).alias("question"), F.col(key).cast("string").alias("answer"), "value"
    )


def match_questions(facts: DataFrame) -> DataFrame:
    """The four questions; each is a global top-1 (per-partition top-k, then merge), ties by key."""
    return (
        _top1(facts, "player_gamertag", F.avg("kills"), "player_most_kills_per_game")
        .unionByName(_top1(facts, "playlist_id", F.countDistinct("match_id"), "playlist_most_played"))
        .unionByName(_top1(facts, "map_name", F.countDistinct("match_id"), "map_most_played"))
        .unionByName(_top1(facts, "map_name", F.sum("killing_sprees"), "map_most_killing_sprees"))
    )
