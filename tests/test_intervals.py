"""Range search against a search of every range, over partition borders, nested and overlapping ranges."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import geo
from tidemark.operators.intervals import RangeIndex


def innermost(ranges, x):
    held = [(low, -high, name) for low, high, name in ranges if low is not None and high is not None and low <= x <= high]
    return max(held)[2] if held else None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_ranges_equal_a_search_of_all(spark, seed):
    rng = random.Random(seed)
    ranges = [(a, a + rng.choice([0, 3, 40, 900]), f"r{i}") for i, a in enumerate(rng.sample(range(2000), 150))]
    ranges += [(0, 1500, "wide"), (5, 2, "turned"), (None, 7, "open"), (300, 1900, "long")]
    probes = [(i, rng.randint(-5, 2600)) for i in range(500)] + [(900 + i, 777) for i in range(50)] + [(1000, None)]
    df = spark.createDataFrame(probes, "id long, x long")
    table = spark.createDataFrame(ranges, "low long, high long, name string")
    got = {r["id"]: r["name"] for r in RangeIndex(table, "low", "high").attach(df, "x").collect()}
    assert got == {i: None if x is None else innermost(ranges, x) for i, x in probes}


def test_addresses_of_both_families_and_a_wide_range_is_no_many_rows(spark):
    nets = ["10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.3/32", "192.168.0.0/16", "2001:db8::/32", "2001:db8:1::/48"]
    rows = []
    for net in map(ipaddress.ip_network, nets):
        rows.append((str(net[0]), str(net[-1]), str(net)))
    table = spark.createDataFrame(rows, "a string, b string, name string").select(
        geo.address_key(F.col("a")).alias("ip_start"), geo.address_key(F.col("b")).alias("ip_end"), "name")
    found = geo.index(table)
    assert found.points.count() <= 2 * len(nets)
    asked = {"10.200.0.1": nets[0], "10.1.9.9": nets[1], "10.1.2.9": nets[2], "10.1.2.3": nets[3], "10.2.0.0": nets[0],
             "9.255.255.255": None, "11.0.0.0": None, "192.168.255.255": nets[4], "2001:db8::1": nets[5], "2001:DB8:1::": nets[6],
             "2001:db8:1:0:0:0:0:ff": nets[6], "2001:db9::": None, "::1": None, "bad": None, "1.2.3": None, "1.2.3.4.5": None,
             "256.1.1.1": None, "1:2:3": None, "::1::": None, "1:2:3:4:5:6:7:8:9": None, ":": None}
    df = spark.createDataFrame([(k,) for k in asked] + [(None,)], "ip string")
    got = {r["ip"]: r["name"] for r in geo.enrich(df, "ip", found).collect()}
    assert got == {**asked, None: None}


def test_keys_sort_like_addresses(spark):
    ips = ["0.0.0.0", "9.0.0.1", "10.0.0.1", "100.2.3.4", "255.255.255.255", "::", "::2", "fe80::1", "1:0:0:2::"]
    df = spark.createDataFrame([(x,) for x in ips], "ip string").select("ip", geo.address_key(F.col("ip")).alias("k"))
    mapped = {x: int(ipaddress.IPv6Address("::ffff:" + x) if "." in x else ipaddress.ip_address(x)) for x in ips}
    assert {r["ip"]: int(r["k"], 16) for r in df.collect()} == mapped


def test_geo_query_meets_all_ranges_and_none(spark):
    from tidemark.plans.q_streaming import q_geo_enrich

    got = q_geo_enrich(spark, "/root/testdata/sf0.01")
    found = got.groupBy("country").count().collect()
    assert len(found) == 26 and all(r["count"] for r in found)
    assert got.where("city LIKE '% Centre'").count() > 0
