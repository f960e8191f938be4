"""IP geolocation as a search in address ranges (no per-row network call).

Addresses become keys that sort like the addresses: 32 hexadecimal digits, IPv4 as mapped into IPv6
(::ffff:a.b.c.d). The ranges may nest; the innermost one holds. See ``intervals`` for the search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import RangeIndex

BASE_IP = (10 << 24)  # 10.0.0.0: stand-in address space of the driver's events
NATION_ADDRESSES = 1 << 16  # addresses of a nation in the stand-in geo dimension: a /16 each
CENTRE = (16384, 20479)  # and a nested range of its own within: a /20
V4_PREFIX = "0" * 20 + "ffff"


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text -> number; malformed text gives NULL (no geo match), not a failure."""
    o = F.split(ip, r"\.")
    return F.when(
        ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & F.forall(o, lambda x: x.try_cast("long") <= 255),
        F.get(o, 0).try_cast("long") * 16777216 + F.get(o, 1).try_cast("long") * 65536
        + F.get(o, 2).try_cast("long") * 256 + F.get(o, 3).try_cast("long"))


def long_to_ip(number: Column) -> Column:
    """Number below 2^32 -> dotted IPv4 text."""
    parts = [F.shiftright(number, 8 * i).bitwiseAND(F.lit(255).cast("long")).cast("string") for i in (3, 2, 1, 0)]
    return F.concat_ws(".", *parts)


def v4_key(number: Column) -> Column:
    """The key of an IPv4 address given as a number."""
    return F.concat(F.lit(V4_PREFIX), F.lower(F.lpad(F.hex(number), 8, "0")))


def _v6_key(ip: Column) -> Column:
    """IPv6 text in groups of hexadecimal digits, one ``::`` at most (no dotted tail); else NULL."""
    halves = F.split(F.lower(ip), "::")
    groups = [F.filter(F.split(F.coalesce(F.get(halves, i), F.lit("")), ":"), lambda x: x != "") for i in (0, 1)]
    missing = 8 - F.size(groups[0]) - F.size(groups[1])
    every = F.concat(groups[0], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), groups[1])
    right = ip.rlike("^[0-9a-fA-F:]*:[0-9a-fA-F:]*$") & ~ip.rlike(":::|^:[^:]|[^:]:$") & F.forall(
        every, lambda x: F.length(x) <= 4) & (F.size(every) == 8) & F.when(
        F.size(halves) == 2, missing > 0).otherwise((F.size(halves) == 1) & (missing == 0))
    return F.when(right, F.array_join(F.transform(every, lambda x: F.lpad(x, 4, "0")), ""))


def address_key(ip: Column) -> Column:
    """IPv4 or IPv6 text -> a key that sorts like the addresses; malformed text gives NULL."""
    number = ip_to_long(ip)
    return F.when(number.isNotNull(), v4_key(number)).otherwise(_v6_key(ip))


def nation_ranges(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Stand-in geo dimension from nation x region: nation n owns a /16 from 10.n.0.0 on, and in it a
    nested /20, its centre. Columns: ip_start, ip_end (keys), country, state, city."""
    n = nation.join(region, nation.n_regionkey == region.r_regionkey)
    first = F.lit(BASE_IP).cast("long") + F.col("n_nationkey").cast("long") * NATION_ADDRESSES
    whole = F.struct(F.lit(0).alias("low"), F.lit(NATION_ADDRESSES - 1).alias("high"), F.lit(" City").alias("city"))
    centre = F.struct(F.lit(CENTRE[0]).alias("low"), F.lit(CENTRE[1]).alias("high"), F.lit(" Centre").alias("city"))
    return n.select(first.alias("first"), "n_name", "r_name", F.explode(F.array(whole, centre)).alias("part")).select(
        v4_key(F.col("first") + F.col("part.low")).alias("ip_start"), v4_key(F.col("first") + F.col("part.high")).alias("ip_end"),
        F.col("n_name").alias("country"), F.col("r_name").alias("state"), F.concat("n_name", "part.city").alias("city"))


def index(ranges: DataFrame) -> RangeIndex:
    """``ranges``: ip_start, ip_end (keys, both inclusive) and the columns to attach."""
    return RangeIndex(ranges, "ip_start", "ip_end")


def enrich(df: DataFrame, ip_col: str, ranges: DataFrame | RangeIndex) -> DataFrame:
    """``df`` with the columns of the innermost range of each address; unmatched and malformed addresses
    get NULLs (the reference's UDF returned '{}' on failure). ``df`` is a batch: see ``runner`` for streams."""
    found = ranges if isinstance(ranges, RangeIndex) else index(ranges)
    return found.attach(df.withColumn("_address", address_key(F.col(ip_col))), "_address").drop("_address")
