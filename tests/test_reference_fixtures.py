"""The reference's three unit fixtures, compared without row order."""

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tidemark.operators.array_metrics import first_days_totals
from tidemark.operators.graph import team_vertices
from tidemark.operators.scd import scd_backfill


def test_scd_generation(spark):
    src = spark.createDataFrame(
        [("Michael Jordan", 2001, "Good"), ("Michael Jordan", 2002, "Good"), ("Michael Jordan", 2003, "Bad"),
         ("Someone Else", 2003, "Bad")],
        "player_name string, current_season long, scoring_class string",
    )
    out = scd_backfill(src, ["player_name"], "current_season", ["scoring_class"], start_col="start_date",
                       end_col="end_date")
    expected = spark.createDataFrame(
        [("Michael Jordan", "Good", 2001, 2002), ("Michael Jordan", "Bad", 2003, 2003), ("Someone Else", "Bad", 2003, 2003)],
        "player_name string, scoring_class string, start_date long, end_date long",
    )
    assertDataFrameEqual(out.select("player_name", "scoring_class", "start_date", "end_date"), expected)


def test_vertex_generation(spark):
    teams = spark.createDataFrame(
        [(1, "GSW", "Warriors", "San Francisco", "Chase Center", 1900),
         (1, "GSW", "Bad Warriors", "San Francisco", "Chase Center", 1900)],
        "team_id long, abbreviation string, nickname string, city string, arena string, yearfounded long",
    )
    out = team_vertices(teams, order=("nickname",), descending=True)
    expected = spark.createDataFrame(
        [(1, "team", {"abbreviation": "GSW", "nickname": "Warriors", "city": "San Francisco",
                      "arena": "Chase Center", "year_founded": "1900"})],
        "identifier long, type string, properties map<string,string>",
    )
    assertDataFrameEqual(out, expected)


def test_monthly_site_hits(spark):
    ds = "2023-03-01"
    src = spark.createDataFrame(
        [("2023-03-01", [0, 1, 3], "2023-03-01"), ("2023-03-01", [1, 2, 3], "2023-03-01"),
         ("2023-04-01", [], "2023-03-01"), ("2023-04-01", [], "")],
        "month_start string, hit_array array<long>, date_partition string",
    )
    out = first_days_totals(src.where(F.col("date_partition") == ds), "hit_array")
    expected = spark.createDataFrame(
        [("2023-03-01", 1, 3, 6), ("2023-04-01", 0, 0, 0)],
        "month_start string, num_hits_first_day long, num_hits_second_day long, num_hits_third_day long",
    )
    assertDataFrameEqual(out, expected)
