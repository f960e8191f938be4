"""Registered queries: activity datelists, bit packing, monthly arrays, growth accounting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, bits
from ..operators import activity as act
from ..operators import array_metrics as am
from ..operators import growth as gr
from ..sources import adapters
from ..sources.tables import Tables


def last_day(t: Tables) -> dt.date:
    """The as-of date: the day of the latest event (one scalar to the driver, from the bare column's
    maximum, which the scan answers from the files' statistics where it can)."""
    return t.events.agg(F.max("ts").cast("date")).first()[0]


def user_activity(t: Tables) -> DataFrame:
    return adapters.web_events(t).where(F.col("user_id").isNotNull()).select("user_id", "event_date", "host", "device_id")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _flat_datelist(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys,
        F.size("dates_active").cast("long").alias("n_dates"),
        arrays.join_values(F.col("dates_active")).alias("dates_active"),
        _s("date").alias("date"),
    )


def q_users_cumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    snap = act.datelist_backfill(user_activity(t), ["user_id"], "event_date", last_day(t))
    return _flat_datelist(snap, "user_id")


def q_users_cumulated_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = last_day(t)
    ua = user_activity(t)
    prev = act.datelist_backfill(ua, ["user_id"], "event_date", d - dt.timedelta(days=1))
    return _flat_datelist(act.datelist_step(prev, ua, ["user_id"], "event_date", d), "user_id")


def users_datelist_int(t: Tables) -> DataFrame:
    snap = act.datelist_backfill(user_activity(t), ["user_id"], "event_date", last_day(t))
    return act.datelist_int(snap)


def q_datelist_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_datelist_int(Tables(spark, sf_dir)).select("user_id", "datelist_int", _s("date").alias("date"))


def q_datelist_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = users_datelist_int(Tables(spark, sf_dir)).select("user_id", "datelist_int")
    return act.datelist_activity(packed)


def q_engagement_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAU / WAU / MAU (32-day) and stickiness at the as-of date, from the packed ints."""
    m = F.col("datelist_int")
    packed = users_datelist_int(Tables(spark, sf_dir))
    out = packed.agg(
        F.count_if(m.bitwiseAND(F.lit(1 << 31).cast("long")) != 0).alias("dau"),
        F.count_if(m.bitwiseAND(F.lit(bits.LAST_7_DAYS_MASK).cast("long")) != 0).alias("wau"),
        F.count_if(m != 0).alias("mau"),
    )
    return out.withColumn("stickiness", F.try_divide(F.col("dau").cast("double"), F.col("mau").cast("double")))


def daily_hits(t: Tables, *keys: str) -> DataFrame:
    return user_activity(t).groupBy(*keys, "event_date").agg(F.count(F.lit(1)).alias("num_hits"))


def _flat_hits(df: DataFrame, col: str, *keys: str) -> DataFrame:
    return df.select(
        *keys,
        _s("month_start").alias("month_start"),
        arrays.join_values(F.col(col)).alias(col),
        F.aggregate(F.col(col), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0).cast("long"))).alias(
            "total_hits"
        ),
        _s("first_found_date").alias("first_found_date"),
    )


def site_hits_backfill(t: Tables, d: dt.date) -> DataFrame:
    return am.monthly_array_backfill(daily_hits(t, "user_id"), ["user_id"], "event_date", ["num_hits"], d).withColumnRenamed(
        "num_hits", "hit_array"
    )


def q_monthly_site_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return _flat_hits(site_hits_backfill(t, last_day(t)), "hit_array", "user_id")


def q_monthly_site_hits_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = last_day(t)
    prev = site_hits_backfill(t, d - dt.timedelta(days=1))
    today = daily_hits(t, "user_id").where(F.col("event_date") == F.lit(d))
    step = am.monthly_array_step(prev, today, ["user_id"], "num_hits", d, out="hit_array")
    return _flat_hits(step, "hit_array", "user_id")


def q_monthly_site_hits_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = last_day(t)
    snap = site_hits_backfill(t, d).where(F.col("date_partition") == F.lit(d).cast("date"))
    return am.first_days_totals(snap, "hit_array").select(
        _s("month_start").alias("month_start"), "num_hits_first_day", "num_hits_second_day", "num_hits_third_day"
    )


METRIC, OTHER_METRIC = "site_hits", "hosts_seen"


def _metric_rows(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("num_hits", "metric_array").withColumn("metric_name", F.lit(METRIC)).select(
        "user_id", "month_start", "metric_name", "metric_array"
    )


def array_metrics_state(t: Tables, d: dt.date) -> DataFrame:
    """array_metrics as of ``d``: yesterday's state upserted with today's step (0-filled)."""
    daily = daily_hits(t, "user_id")
    y = d - dt.timedelta(days=1)
    if y.month == d.month:
        prev = am.monthly_array_backfill(daily, ["user_id"], "event_date", ["num_hits"], y, fill=0)
    else:
        # first day of a month: yesterday's state holds no rows of this month
        prev = am.monthly_array_backfill(daily.where(F.lit(False)), ["user_id"], "event_date", ["num_hits"], y, fill=0)
    today = daily.where(F.col("event_date") == F.lit(d))
    step = am.monthly_array_step(prev, today, ["user_id"], "num_hits", d, fill=0)
    return am.upsert(_metric_rows(prev), _metric_rows(step), ["user_id", "month_start", "metric_name"])


def q_upsert_array_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's hits upserted into a table that also holds the month before (which stays as it is)
    and another metric (which stays too): only this month's hit arrays are replaced."""
    t = Tables(spark, sf_dir)
    d = last_day(t)
    daily = daily_hits(t, "user_id")
    y = d - dt.timedelta(days=1)
    month_end = d.replace(day=1) - dt.timedelta(days=1)
    before = _metric_rows(am.monthly_array_backfill(daily, ["user_id"], "event_date", ["num_hits"], month_end, fill=0))
    hosts = user_activity(t).groupBy("user_id", "event_date").agg(F.countDistinct("host").alias("num_hits"))
    other = _metric_rows(am.monthly_array_backfill(hosts, ["user_id"], "event_date", ["num_hits"], y, fill=0))
    other = other.withColumn("metric_name", F.lit(OTHER_METRIC))
    this = am.monthly_array_backfill(daily, ["user_id"], "event_date", ["num_hits"], y, fill=0)
    target = before.unionByName(other)
    if y.month == d.month:
        target = target.unionByName(_metric_rows(this))
    else:
        this = this.where(F.lit(False))
    today = daily.where(F.col("event_date") == F.lit(d).cast("date"))
    step = am.monthly_array_step(this, today, ["user_id"], "num_hits", d, fill=0)
    state = am.upsert(target, _metric_rows(step), ["user_id", "month_start", "metric_name"])
    return state.select(
        "user_id", _s("month_start").alias("month_start"), "metric_name",
        arrays.join_values(F.col("metric_array")).alias("metric_array"),
        F.size("metric_array").cast("long").alias("n_days"),
    )


def q_array_metrics_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    state = array_metrics_state(t, last_day(t))
    daily = am.array_to_daily(state, ["metric_name"], "metric_array")
    return daily.select("metric_name", _s("date").alias("date"), F.col("value").cast("long").alias("value"))


def device_activity(t: Tables) -> DataFrame:
    return user_activity(t).join(adapters.devices(t).select("device_id", "browser_type"), "device_id")


def q_user_devices_cumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    snap = act.datelist_backfill(device_activity(t), ["user_id", "browser_type"], "event_date", last_day(t))
    return _flat_datelist(snap, "user_id", "browser_type")


def q_user_devices_datelist_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    snap = act.datelist_backfill(device_activity(t), ["user_id", "browser_type"], "event_date", last_day(t))
    return act.datelist_int(snap).select("user_id", "browser_type", "datelist_int", _s("date").alias("date"))


def user_devices_map(t: Tables) -> DataFrame:
    """Today's map per user: yesterday's map and today's activity, merged entry by entry."""
    d = last_day(t)
    activity = device_activity(t)
    rows = act.datelist_backfill(activity, ["user_id", "browser_type"], "event_date", d - dt.timedelta(days=1))
    yesterday = act.datelist_map(rows, "user_id", "browser_type")
    return act.datelist_map_step(yesterday, activity, "user_id", "browser_type", "event_date", d, "browser_type_dates_active")


def q_user_devices_map_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = user_devices_map(Tables(spark, sf_dir))
    rows = maps.select("user_id", F.explode("browser_type_dates_active").alias("browser_type", "dates_active"), "date")
    return _flat_datelist(rows, "user_id", "browser_type")


def q_user_devices_map_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = act.datelist_map_int(user_devices_map(Tables(spark, sf_dir)), "browser_type_dates_active")
    return masks.select("user_id", F.explode("datelist_ints").alias("browser_type", "datelist_int"), _s("date").alias("date"))


def q_hosts_cumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental: yesterday's host datelist + today's host activity."""
    t = Tables(spark, sf_dir)
    d = last_day(t)
    ha = user_activity(t).select("host", "event_date")
    prev = act.datelist_backfill(ha, ["host"], "event_date", d - dt.timedelta(days=1))
    return _flat_datelist(act.datelist_step(prev, ha, ["host"], "event_date", d), "host")


def host_daily_visits(t: Tables, approx_visitors: bool = False) -> DataFrame:
    """(host, day) hits and unique visitors. The exact distinct count shuffles on
    (host, day, user) after a map-side distinct; ``approx_visitors`` uses a fixed-size
    HyperLogLog++ sketch per group instead (about 2 % relative error)."""
    visitors = F.approx_count_distinct("user_id") if approx_visitors else F.countDistinct("user_id")
    return user_activity(t).groupBy("host", "event_date").agg(
        F.count(F.lit(1)).alias("hit_array"), visitors.alias("unique_visitors")
    )


def q_host_activity_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = last_day(t)
    per_day = host_daily_visits(t)
    arr = am.monthly_array_backfill(per_day, ["host"], "event_date", ["hit_array", "unique_visitors"], d, fill=0)
    return arr.select(
        _s("month_start").alias("month_start"), "host",
        arrays.join_values(F.col("hit_array")).alias("hit_array"),
        arrays.join_values(F.col("unique_visitors")).alias("unique_visitors"),
    )


def q_host_activity_reduced_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reduced host fact loaded day by day: yesterday's partition and today's hits and visitors."""
    t = Tables(spark, sf_dir)
    d = last_day(t)
    per_day = host_daily_visits(t)
    values = ["hit_array", "unique_visitors"]
    y = d - dt.timedelta(days=1)
    prev = am.monthly_array_backfill(per_day, ["host"], "event_date", values, y, fill=0)
    today = per_day.where(F.col("event_date") == F.lit(d).cast("date"))
    step = am.monthly_arrays_step(prev, today, ["host"], values, d, fill=0)
    return step.select(_s("month_start").alias("month_start"), "host", *[arrays.join_values(F.col(c)).alias(c) for c in values])


# --- growth accounting on purchases ---


def growth_rows(t: Tables, d: dt.date | None = None, with_dates: bool = True) -> DataFrame:
    d = d or last_day(t)
    return gr.growth_accounting_backfill(adapters.purchase_activity(t), "user_id", "event_date", d, with_dates)


def _flat_growth(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id",
        _s("first_active_date").alias("first_active_date"),
        _s("last_active_date").alias("last_active_date"),
        "daily_active_state",
        "weekly_active_state",
        F.size("dates_active").cast("long").alias("n_dates"),
        arrays.join_values(F.col("dates_active")).alias("dates_active"),
        _s("date").alias("date"),
    )


def q_growth_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_growth(growth_rows(Tables(spark, sf_dir)))


def q_growth_accounting_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = last_day(t)
    y = d - dt.timedelta(days=1)
    prev = growth_rows(t, y).where(F.col("date") == F.lit(y).cast("date"))
    step = gr.growth_accounting_step(prev, adapters.purchase_activity(t), "user_id", "event_date", d)
    return _flat_growth(step)


def q_retention_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.retention_curve(growth_rows(Tables(spark, sf_dir), with_dates=False))


def q_growth_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = growth_rows(Tables(spark, sf_dir), with_dates=False)
    state = F.col("daily_active_state")
    return g.groupBy(_s("date").alias("date")).agg(
        *[F.count_if(state == s).alias(f"n_{s.lower()}") for s in (gr.NEW, gr.RETAINED, gr.RESURRECTED, gr.CHURNED, gr.STALE)],
        F.count_if(state.isin(*gr.ACTIVE_STATES)).alias("n_active"),
    )


def q_growth_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = growth_rows(Tables(spark, sf_dir), with_dates=False)
    return g.groupBy("daily_active_state").agg(
        F.count(F.lit(1)).alias("user_days"), F.countDistinct("user_id").alias("users")
    )


QUERIES = {
    "users_cumulated": q_users_cumulated,
    "users_cumulated_step": q_users_cumulated_step,
    "datelist_int": q_datelist_int,
    "datelist_activity": q_datelist_activity,
    "engagement_total": q_engagement_total,
    "monthly_site_hits": q_monthly_site_hits,
    "monthly_site_hits_step": q_monthly_site_hits_step,
    "monthly_site_hits_agg": q_monthly_site_hits_agg,
    "upsert_array_metrics": q_upsert_array_metrics,
    "array_metrics_by_day": q_array_metrics_by_day,
    "user_devices_cumulated": q_user_devices_cumulated,
    "user_devices_datelist_int": q_user_devices_datelist_int,
    "user_devices_map_step": q_user_devices_map_step,
    "user_devices_map_int": q_user_devices_map_int,
    "hosts_cumulated": q_hosts_cumulated,
    "host_activity_reduced": q_host_activity_reduced,
    "host_activity_reduced_step": q_host_activity_reduced_step,
    "growth_accounting": q_growth_accounting,
    "growth_accounting_step": q_growth_accounting_step,
    "retention_curve": q_retention_curve,
    "growth_daily": q_growth_daily,
    "growth_total": q_growth_total,
}

# ----------------------------------------------------------------------------------------------
# Oracles: straight from events with date grids and range joins.
# ----------------------------------------------------------------------------------------------

EV = """
ev AS (
  SELECT e.user_id, CAST(e.ts AS DATE) AS d,
         'host_' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS VARCHAR) AS host,
         e.user_id * 14 + CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS device_id
  FROM events e WHERE e.user_id IS NOT NULL
),
cal AS (SELECT CAST(MAX(ts) AS DATE) AS d, CAST(date_trunc('month', MAX(ts)) AS DATE) AS m FROM events)"""

DEV = """
dev AS (SELECT p_partkey AS device_id, p_brand AS browser_type, p_type AS os_type,
               split_part(p_name, ' ', 2) AS device_type FROM part)"""


def _datelist_sql(keys: str, src: str) -> str:
    return f"""
SELECT {keys}, COUNT(DISTINCT x.d) AS n_dates,
       string_agg(DISTINCT CAST(x.d AS VARCHAR), ',' ORDER BY CAST(x.d AS VARCHAR)) AS dates_active,
       CAST((SELECT d FROM cal) AS VARCHAR) AS date
FROM {src} x WHERE x.d <= (SELECT d FROM cal) GROUP BY {keys}"""


def _mask_sql(keys: str, src: str) -> str:
    return f"""
dl AS (
  SELECT {keys},
         CAST(SUM(CASE WHEN date_diff('day', x.d, a.d) BETWEEN 0 AND 31
                       THEN CAST(1 AS BIGINT) << CAST(31 - date_diff('day', x.d, a.d) AS INTEGER) ELSE 0 END) AS BIGINT)
           AS datelist_int,
         CAST(a.d AS VARCHAR) AS date
  FROM (SELECT DISTINCT {keys}, d FROM {src}) x, cal a WHERE x.d <= a.d GROUP BY {keys}, a.d
)"""


MONTH_GRID = """
mdaily AS (SELECT ev.user_id, ev.d, COUNT(*) AS n FROM ev, cal WHERE ev.d BETWEEN cal.m AND cal.d GROUP BY 1, 2),
grid AS (
  SELECT u.user_id, CAST(g.d AS DATE) AS d
  FROM (SELECT DISTINCT user_id FROM mdaily) u, cal,
       LATERAL (SELECT unnest(generate_series(cal.m, cal.d, INTERVAL 1 DAY)) AS d) g
)"""

HITS = """
SELECT g.user_id, CAST((SELECT m FROM cal) AS VARCHAR) AS month_start,
       string_agg(COALESCE(CAST(md.n AS VARCHAR), '{fill}'), ',' ORDER BY g.d) AS {col},
       CAST(COALESCE(SUM(md.n), 0) AS BIGINT) AS total_hits,
       CAST(MIN(md.d) AS VARCHAR) AS first_found_date
FROM grid g LEFT JOIN mdaily md ON md.user_id = g.user_id AND md.d = g.d GROUP BY g.user_id"""

GROWTH = """
act AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase' AND user_id IS NOT NULL),
cal AS (SELECT CAST(MAX(ts) AS DATE) AS d FROM events),
firsts AS (SELECT user_id, MIN(d) AS first_d FROM act GROUP BY 1),
ggrid AS (
  SELECT f.user_id, f.first_d, CAST(g.d AS DATE) AS d
  FROM firsts f, cal, LATERAL (SELECT unnest(generate_series(f.first_d, cal.d, INTERVAL 1 DAY)) AS d) g
),
st AS (
  SELECT g.user_id, g.first_d, g.d,
         MAX(a.d) FILTER (WHERE a.d < g.d) AS y_last,
         COALESCE(BOOL_OR(a.d = g.d), FALSE) AS active_today,
         MAX(a.d) AS last_d, COUNT(*) AS n_dates,
         string_agg(CAST(a.d AS VARCHAR), ',' ORDER BY a.d) AS dates_active
  FROM ggrid g JOIN act a ON a.user_id = g.user_id AND a.d <= g.d
  GROUP BY 1, 2, 3
),
growth AS (
  SELECT user_id, first_d, d, CAST(first_d AS VARCHAR) AS first_active_date, CAST(last_d AS VARCHAR) AS last_active_date,
         CASE WHEN d = first_d THEN 'New'
              WHEN active_today AND y_last = d - 1 THEN 'Retained'
              WHEN active_today AND y_last < d - 1 THEN 'Resurrected'
              WHEN NOT active_today AND y_last = d - 1 THEN 'Churned'
              ELSE 'Stale' END AS daily_active_state,
         CASE WHEN d = first_d THEN 'New'
              WHEN active_today AND y_last < d - 7 THEN 'Resurrected'
              WHEN NOT active_today AND y_last = d - 8 THEN 'Churned'
              WHEN last_d + 7 >= d - 1 THEN 'Retained'
              ELSE 'Stale' END AS weekly_active_state,
         n_dates, dates_active, CAST(d AS VARCHAR) AS date
  FROM st
)"""

_GROWTH_COLS = ("user_id, first_active_date, last_active_date, daily_active_state, weekly_active_state, "
                "n_dates, dates_active, date")

ORACLES = {
    "users_cumulated": f"WITH {EV} {_datelist_sql('user_id', 'ev')}",
    "users_cumulated_step": f"WITH {EV} {_datelist_sql('user_id', 'ev')}",
    "datelist_int": f"WITH {EV}, {_mask_sql('user_id', 'ev')} SELECT user_id, datelist_int, date FROM dl",
    "datelist_activity": f"""WITH {EV}, {_mask_sql('user_id', 'ev')}
SELECT user_id, datelist_int,
       bit_count(datelist_int) > 0 AS monthly_active,
       CAST(bit_count(datelist_int) AS BIGINT) AS l32,
       bit_count(datelist_int & CAST(4261412864 AS BIGINT)) > 0 AS weekly_active,
       CAST(bit_count(datelist_int & CAST(4261412864 AS BIGINT)) AS BIGINT) AS l7,
       bit_count(datelist_int & CAST(33292288 AS BIGINT)) > 0 AS weekly_active_previous_week
FROM dl""",
    "engagement_total": f"""WITH {EV}
SELECT COUNT(DISTINCT ev.user_id) FILTER (WHERE ev.d = a.d) AS dau,
       COUNT(DISTINCT ev.user_id) FILTER (WHERE ev.d BETWEEN a.d - 6 AND a.d) AS wau,
       COUNT(DISTINCT ev.user_id) FILTER (WHERE ev.d BETWEEN a.d - 31 AND a.d) AS mau,
       CAST(COUNT(DISTINCT ev.user_id) FILTER (WHERE ev.d = a.d) AS DOUBLE)
         / COUNT(DISTINCT ev.user_id) FILTER (WHERE ev.d BETWEEN a.d - 31 AND a.d) AS stickiness
FROM ev, cal a GROUP BY a.d""",
    "monthly_site_hits": f"WITH {EV}, {MONTH_GRID} " + HITS.format(fill="null", col="hit_array"),
    "monthly_site_hits_step": f"WITH {EV}, {MONTH_GRID} " + HITS.format(fill="null", col="hit_array"),
    "monthly_site_hits_agg": f"""WITH {EV}
SELECT CAST(a.m AS VARCHAR) AS month_start,
       COUNT(*) FILTER (WHERE ev.d = a.m) AS num_hits_first_day,
       COUNT(*) FILTER (WHERE ev.d = a.m + 1) AS num_hits_second_day,
       COUNT(*) FILTER (WHERE ev.d = a.m + 2) AS num_hits_third_day
FROM ev, cal a WHERE ev.d BETWEEN a.m AND a.d GROUP BY a.m""",
    # Three parts of the table: this month's hits to the as-of day, the month before, and the hosts
    # seen this month up to the day before (another metric, which the upsert must leave alone).
    "upsert_array_metrics": f"""WITH {EV},
spans AS (
  SELECT 'site_hits' AS metric, m AS first, d AS last FROM cal
  UNION ALL SELECT 'site_hits', CAST(m - INTERVAL 1 MONTH AS DATE), m - 1 FROM cal
  UNION ALL SELECT 'hosts_seen', CAST(date_trunc('month', d - 1) AS DATE), d - 1 FROM cal
),
vals AS (
  SELECT s.metric, s.first, ev.user_id, ev.d,
         CASE WHEN s.metric = 'site_hits' THEN COUNT(*) ELSE COUNT(DISTINCT ev.host) END AS n
  FROM spans s JOIN ev ON ev.d BETWEEN s.first AND s.last GROUP BY s.metric, s.first, ev.user_id, ev.d
),
days AS (SELECT s.metric, s.first, CAST(unnest(generate_series(s.first, s.last, INTERVAL 1 DAY)) AS DATE) AS d FROM spans s),
cells AS (
  SELECT u.metric, u.first, u.user_id, days.d, COALESCE(v.n, 0) AS n
  FROM (SELECT DISTINCT metric, first, user_id FROM vals) u JOIN days ON days.metric = u.metric AND days.first = u.first
  LEFT JOIN vals v ON v.metric = u.metric AND v.first = u.first AND v.user_id = u.user_id AND v.d = days.d
)
SELECT user_id, CAST(first AS VARCHAR) AS month_start, metric AS metric_name,
       string_agg(CAST(n AS VARCHAR), ',' ORDER BY d) AS metric_array, COUNT(*) AS n_days
FROM cells GROUP BY user_id, first, metric""",
    "array_metrics_by_day": f"""WITH {EV}
SELECT 'site_hits' AS metric_name, CAST(CAST(g.d AS DATE) AS VARCHAR) AS date,
       CAST((SELECT COUNT(*) FROM ev WHERE ev.d = CAST(g.d AS DATE)) AS BIGINT) AS value
FROM cal a, LATERAL (SELECT unnest(generate_series(a.m, a.d, INTERVAL 1 DAY)) AS d) g""",
    "user_devices_cumulated": f"""WITH {EV}, {DEV},
x AS (SELECT ev.user_id, dev.browser_type, ev.d FROM ev JOIN dev ON dev.device_id = ev.device_id)
{_datelist_sql('user_id, browser_type', 'x')}""",
    "user_devices_datelist_int": f"""WITH {EV}, {DEV},
x AS (SELECT ev.user_id, dev.browser_type, ev.d FROM ev JOIN dev ON dev.device_id = ev.device_id),
{_mask_sql('user_id, browser_type', 'x')} SELECT user_id, browser_type, datelist_int, date FROM dl""",
    "user_devices_map_step": f"""WITH {EV}, {DEV},
x AS (SELECT ev.user_id, dev.browser_type, ev.d FROM ev JOIN dev ON dev.device_id = ev.device_id)
{_datelist_sql('user_id, browser_type', 'x')}""",
    "user_devices_map_int": f"""WITH {EV}, {DEV},
x AS (SELECT ev.user_id, dev.browser_type, ev.d FROM ev JOIN dev ON dev.device_id = ev.device_id),
{_mask_sql('user_id, browser_type', 'x')} SELECT user_id, browser_type, datelist_int, date FROM dl""",
    "hosts_cumulated": f"WITH {EV} {_datelist_sql('host', 'ev')}",
    "host_activity_reduced": f"""WITH {EV},
hd AS (SELECT ev.host, ev.d, COUNT(*) AS hits, COUNT(DISTINCT ev.user_id) AS visitors FROM ev, cal
       WHERE ev.d BETWEEN cal.m AND cal.d GROUP BY 1, 2),
hgrid AS (SELECT h.host, CAST(g.d AS DATE) AS d FROM (SELECT DISTINCT host FROM hd) h, cal,
          LATERAL (SELECT unnest(generate_series(cal.m, cal.d, INTERVAL 1 DAY)) AS d) g)
SELECT CAST((SELECT m FROM cal) AS VARCHAR) AS month_start, g.host,
       string_agg(CAST(COALESCE(hd.hits, 0) AS VARCHAR), ',' ORDER BY g.d) AS hit_array,
       string_agg(CAST(COALESCE(hd.visitors, 0) AS VARCHAR), ',' ORDER BY g.d) AS unique_visitors
FROM hgrid g LEFT JOIN hd ON hd.host = g.host AND hd.d = g.d GROUP BY g.host""",
    "host_activity_reduced_step": f"""WITH {EV},
hd AS (SELECT ev.host, ev.d, COUNT(*) AS hits, COUNT(DISTINCT ev.user_id) AS visitors FROM ev, cal
       WHERE ev.d BETWEEN cal.m AND cal.d GROUP BY 1, 2),
hgrid AS (SELECT h.host, CAST(g.d AS DATE) AS d FROM (SELECT DISTINCT host FROM hd) h, cal,
          LATERAL (SELECT unnest(generate_series(cal.m, cal.d, INTERVAL 1 DAY)) AS d) g)
SELECT CAST((SELECT m FROM cal) AS VARCHAR) AS month_start, g.host,
       string_agg(CAST(COALESCE(hd.hits, 0) AS VARCHAR), ',' ORDER BY g.d) AS hit_array,
       string_agg(CAST(COALESCE(hd.visitors, 0) AS VARCHAR), ',' ORDER BY g.d) AS unique_visitors
FROM hgrid g LEFT JOIN hd ON hd.host = g.host AND hd.d = g.d GROUP BY g.host""",
    "growth_accounting": f"WITH {GROWTH} SELECT {_GROWTH_COLS} FROM growth",
    "growth_accounting_step": f"WITH {GROWTH} SELECT {_GROWTH_COLS} FROM growth WHERE d = (SELECT d FROM cal)",
    "retention_curve": f"""WITH {GROWTH}
SELECT CAST(d - first_d AS INTEGER) AS days_since_first_active,
       CAST(COUNT(*) FILTER (WHERE daily_active_state IN ('Retained', 'Resurrected', 'New')) AS DOUBLE) / COUNT(*)
         AS pct_active,
       COUNT(*) AS n_users
FROM growth GROUP BY 1""",
    "growth_daily": f"""WITH {GROWTH}
SELECT date, COUNT(*) FILTER (WHERE daily_active_state = 'New') AS n_new,
       COUNT(*) FILTER (WHERE daily_active_state = 'Retained') AS n_retained,
       COUNT(*) FILTER (WHERE daily_active_state = 'Resurrected') AS n_resurrected,
       COUNT(*) FILTER (WHERE daily_active_state = 'Churned') AS n_churned,
       COUNT(*) FILTER (WHERE daily_active_state = 'Stale') AS n_stale,
       COUNT(*) FILTER (WHERE daily_active_state IN ('New', 'Retained', 'Resurrected')) AS n_active
FROM growth GROUP BY date""",
    "growth_total": f"""WITH {GROWTH}
SELECT daily_active_state, COUNT(*) AS user_days, COUNT(DISTINCT user_id) AS users FROM growth GROUP BY 1""",
}
