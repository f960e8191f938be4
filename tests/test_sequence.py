"""Distributed positions/running sums equal the window form, across batch and partition edges."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tidemark.operators.sequence import running_totals
from tidemark.operators.trends import best_stretch, longest_streak


def _data(spark):
    # one hot group (g=0, h='a') holding most rows, plus small groups
    hot = spark.range(0, 500).select(F.lit(0).alias("g"), F.lit("a").alias("h"), F.col("id").alias("t"),
                                     (F.col("id") % 3 == 0).cast("long").alias("v"))
    small = spark.range(0, 60).select((F.col("id") % 6 + 1).alias("g"), F.lit("b").alias("h"), F.col("id").alias("t"),
                                      (F.col("id") % 2).cast("long").alias("v"))
    return hot.unionByName(small)


def test_running_totals_match_window(spark):
    df = _data(spark)
    got = running_totals(df, ["g", "h"], ["t"], "v", partitions=8)
    w = Window.partitionBy("g", "h").orderBy("t")
    expected = df.select(
        "g", "h", "t", "v", F.row_number().over(w).cast("long").alias("position"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
    )
    assertDataFrameEqual(got, expected)


def test_stretch_and_streak_match_window_forms(spark):
    """With a hot group and a NULL group, both equal the window forms."""
    df = _data(spark).withColumn("g", F.when(F.col("g") != 3, F.col("g")))
    w = Window.partitionBy("g").orderBy("t")
    exp_stretch = df.select("g", F.sum("v").over(w.rowsBetween(-9, 0)).alias("s")).groupBy("g").agg(
        F.count(F.lit(1)).alias("rows"), F.max("s").alias("best_10"))
    got_stretch = best_stretch(df, ["g"], ["t"], F.col("v") == 1, 10)
    assertDataFrameEqual(got_stretch, exp_stretch)
    assert got_stretch.where("g IS NULL").count() == 1
    island = F.sum(F.when(F.col("v") == 1, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = df.select("g", "v", island.alias("i")).where("v = 1").groupBy("g", "i").count()
    exp_streak = runs.groupBy("g").agg(F.max("count").cast("long").alias("longest_streak"))
    got = longest_streak(df, ["g"], ["t"], F.col("v") == 1)
    assertDataFrameEqual(got.select("g", "longest_streak").where("longest_streak > 0"), exp_streak)
    assert got.where("longest_streak = 0").count() == 3  # groups without a single hit
    assertDataFrameEqual(got.select("g", "rows"), df.groupBy("g").agg(F.count(F.lit(1)).alias("rows")))
