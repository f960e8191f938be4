"""Profit (unit and rolled-up) and the executive dashboard cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cents
from ..plans.joins import bounded_broadcast
from .cubes import cube_report

COST_RATE_PCT = 60  # stand-in unit cost: 60 % of the part's retail price


def unit_profit(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Per part: units, revenue, cost, profit in exact 1e-4 currency units.

    Line items are aggregated per part before the join (map-side combine), so the join sees
    one row per part whatever the skew of the line items.
    """
    rev = cents(F.col("l_extendedprice")) * (100 - F.round(F.col("l_discount") * 100).cast("long"))
    per_part = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("units"), F.sum(rev).alias("revenue_e4")
    )
    p = part.select("p_partkey", "p_type", "p_brand", cents(F.col("p_retailprice")).alias("_retail_cents"))
    j = per_part.join(p, "p_partkey")
    cost = F.col("units") * F.col("_retail_cents") * COST_RATE_PCT
    return j.select(
        "p_partkey", "p_type", "p_brand", "units", "revenue_e4", cost.alias("cost_e4"),
        (F.col("revenue_e4") - cost).alias("profit_e4"),
    )


def total_profit(unit: DataFrame) -> DataFrame:
    """Reporting totals: ``ROLLUP(p_type, p_brand)`` over the unit-level rows."""
    return unit.rollup("p_type", "p_brand").agg(
        F.sum("units").alias("units"),
        # decimals: the grand total in 1e-4 units passes a long's range on a large table
        *[F.sum(F.col(c).cast("decimal(19,0)")).cast("decimal(38,0)").alias(c)
          for c in ("revenue_e4", "cost_e4", "profit_e4")],
        F.grouping_id("p_type", "p_brand").cast("int").alias("grouping_level"),
    )


def dashboard_cube(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Filterable extract: ``CUBE(region, nation, segment)`` of revenue and orders.

    Orders are combined per customer first, then per (nation, segment) — the finest set — so
    the cube's Expand multiplies a few thousand rows, not the order table.
    """
    per_cust = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(cents(F.col("o_totalprice"))).alias("revenue_cents"), F.count(F.lit(1)).alias("n_orders")
    )
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    finest = per_cust.join(c, "c_custkey").groupBy("c_nationkey", "c_mktsegment").agg(
        F.sum("revenue_cents").alias("revenue_cents"), F.sum("n_orders").alias("n_orders")
    )
    geo = bounded_broadcast(  # 25 nations x 5 regions
        nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"), F.col("r_name").alias("region")
        )
    )
    rows = finest.join(geo, "c_nationkey").withColumnRenamed("c_mktsegment", "segment")
    return cube_report(
        rows, ["region", "nation", "segment"],
        [F.sum("revenue_cents").alias("revenue_cents"), F.sum("n_orders").alias("n_orders")],
    )


def daily_kpis(events: DataFrame) -> DataFrame:
    """The fixed KPI table, a row per day: events, active users, sign-ups, purchases and revenue.

    Users are folded to one row per (day, user) before the count, so that a busy user costs a row."""
    kind = F.col("event_type")
    per_user = events.groupBy(F.to_date("ts").alias("date"), "user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(kind == "signup").alias("signups"),
        F.count_if(kind == "purchase").alias("purchases"),
        F.sum(F.when(kind == "purchase", cents(F.col("value"))).otherwise(0)).alias("revenue_cents"),
    )
    return per_user.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.sum("n_events").alias("n_events"), F.count("user_id").alias("active_users"),
        *[F.sum(c).alias(c) for c in ("signups", "purchases", "revenue_cents")])
