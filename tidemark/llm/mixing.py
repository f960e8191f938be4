"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

A source with target weight w is to make up the share w of the mixture's size; each of its documents
is repeated at the mean rate (share of the budget) / (the source's size). How often a document
appears is the inverse of a Poisson distribution of that mean at a number in [0, 1) made from the
document's id and a seed: the same on every run and every cluster. The copies are then shuffled
globally by a seeded hash of id and copy.

Per source there is one row with its distribution's cumulative probabilities, whose length follows
from the mean alone. Defined cases: a NULL source is a source like any other; NULL and empty texts
have size 0, so a source of these alone has no rate and appears once each; sources without a
weight get none of the budget and appear not at all; weights of NULL or below 0 count as 0; rows
equal in id and text share their count; with no weights given all sources weigh the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: A Poisson number of a larger rate is the sum of independent ones of equal parts of it, so that
#: exp(-rate) stays a normal number and a source's series short.
LARGEST_PART = 512.0


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the seed and ``parts``."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _cumulative(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... of a Poisson distribution, up to 12 deviations above its mean."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 16).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("all"))
    return F.aggregate(
        F.sequence(F.lit(1), last), start,
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"),
            F.concat(acc["all"], F.array(F.element_at(acc["all"], -1) + acc["p"] * rate / k)).alias("all")),
        lambda acc: acc["all"])


def rates(docs: DataFrame, weights: DataFrame | None, source: str, size: Column, budget: float | None) -> DataFrame:
    """(source, rate, sized, parts, cumulative) of each source; ``weights`` has (source, weight)."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size.cast("double")).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = weights.select(F.col("source").alias("_of"), F.greatest(F.col("weight").cast("double"), F.lit(0.0)).alias("weight"))
        given = given.groupBy("_of").agg(F.sum("weight").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of").na.fill(0.0, ["weight"])
    weighed = staged(weighed, "mixing-sources")  # one row a source
    weights_sum, sizes_sum = weighed.agg(F.sum("weight"), F.sum("size")).first()
    size_wanted = sizes_sum if budget is None else budget
    wanted = F.col("weight") * F.lit(float(size_wanted or 0) / (weights_sum or 1.0))
    rate = F.when(F.col("weight") <= 0, 0.0).when(F.col("size") > 0, wanted / F.col("size")).otherwise(1.0)
    rated = weighed.select("source", rate.alias("rate"), (F.col("size") > 0).alias("sized"))
    rated = rated.withColumn("parts", F.ceil(F.col("rate") / LARGEST_PART).cast("int"))
    part = F.col("rate") / F.greatest("parts", F.lit(1))
    return rated.select("source", "rate", "sized", "parts", _cumulative(part).alias("cumulative"))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, source: str = "source", text: str = "text", doc_id: str = "doc_id",
    budget: float | None = None, seed: int = 7, copy: str = "copy",
) -> DataFrame:
    """``docs``, each as often as its count says, with the number of the copy (from 0) in ``copy``;
    rows are dealt out and sorted by a seeded hash. ``budget`` is the mixture's expected size in
    characters; None: that of ``docs``."""
    size = F.coalesce(F.length(text), F.lit(0))
    rated = rates(docs, weights, source, size, budget)
    rows = docs.select(F.struct(*[c for c in docs.columns if c != copy]).alias("row"))
    # one short row a source: Spark broadcasts it if it is small at run time, and splits a hot
    # source's rows if it is not
    joined = rows.join(rated, F.col(f"row.{source}").eqNullSafe(F.col("source")))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.greatest("parts", F.lit(1))), F.lit(0),
        lambda n, i: n + F.size(F.filter("cumulative", lambda p: p <= uniform(seed, F.col(f"row.{doc_id}"), i))))
    times = F.when(F.col("rate") <= 0, 0).when(~F.col("sized"), 1).otherwise(drawn)
    copies = joined.withColumn("times", times).where("times > 0").select(
        "row", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("copy"))
    place = F.md5(F.concat_ws("|", F.lit(f"{seed}|place"), F.coalesce(F.col(f"row.{doc_id}").cast("string"), F.lit("")), "copy"))
    dealt = copies.withColumn("place", place).repartition("place").sortWithinPartitions("place")
    return dealt.select("row.*", F.col("copy").alias(copy))
