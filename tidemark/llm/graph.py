"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst, both long): root is its component's
    smallest node. Minima combine before the shuffle, so the centre of a large star is one row
    of the joined side; each round is cut off by a reliable checkpoint."""
    checkpoint_dir(edges.sparkSession)
    star = edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("root")).distinct().checkpoint()
    mark = _mark(star)
    while True:
        both = star.unionAll(star.select(F.col("root").alias("node"), F.col("node").alias("root")))
        star = _hook(both, larger=True).distinct()
        star = _hook(star, larger=False).distinct().checkpoint()
        if (now := _mark(star)) == mark:
            return star
        mark = now


def _hook(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: each node's larger neighbours go to the smallest of it and its neighbours.
    Small star: each node and its smaller neighbours do (all edges run downwards there)."""
    low = edges.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("low"))
    met = edges.join(low, "node")
    if larger:
        return met.where("root > node").select(F.col("root").alias("node"), F.col("low").alias("root"))
    return met.select(F.col("root").alias("node"), F.col("low").alias("root")).where("node <> root").unionAll(
        low.select("node", F.col("low").alias("root")))


def _mark(star: DataFrame) -> tuple:
    """Changes whenever the edges do: their number and two sums."""
    hashed = F.xxhash64("node", "root")
    return tuple(star.agg(
        F.count("*"), F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(hashed)).first())
