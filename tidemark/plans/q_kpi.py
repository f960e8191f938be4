"""Registered queries: experiments, profit, dashboard cube, quality checks, cleaning, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, experiments, kpi, quality
from ..session import staging_path
from ..sources import adapters, files
from ..sources.contracts import EVENTS_CONTRACT, enforce_contract
from ..sources.tables import Tables
from .q_events import last_day

EXPERIMENT = "exp_signup"


def _assignment(t: Tables) -> DataFrame:
    units = t.events.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    return experiments.assign(units, "user_id", EXPERIMENT)


def _per_unit(t: Tables) -> DataFrame:
    return experiments.exposure_metrics(
        t.events, _assignment(t), "user_id", "ts", "event_type",
        exposure="view", conversion="signup", value_type="purchase", value_col="value",
    )


def q_experiment_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assignment(Tables(spark, sf_dir))


def q_experiment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.cell_metrics(_per_unit(Tables(spark, sf_dir)))


def q_experiment_readout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.readout(experiments.cell_metrics(_per_unit(Tables(spark, sf_dir))), p_digits=5)


def q_profit_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return kpi.unit_profit(t.lineitem, t.part)


def q_profit_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return kpi.total_profit(kpi.unit_profit(t.lineitem, t.part))


def q_dashboard_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return kpi.dashboard_cube(t.orders, t.customer, t.nation, t.region)


def q_kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.daily_kpis(Tables(spark, sf_dir).events)


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    parts = [
        quality.table_checks(t.events, "events", "event_id", ("user_id", "ts")),
        quality.volume_checks(t.events, "ts", "events"),
        quality.freshness_check(t.events, "ts", "events", last_day(t)),
        quality.freshness_check(t.orders, "o_orderdate", "orders", last_day(t)),
        quality.table_checks(t.orders, "orders", "o_orderkey", ("o_custkey",)),
        quality.orphan_check(t.orders, t.customer, "o_custkey", "c_custkey", "orders"),
        quality.orphan_check(t.lineitem, t.orders, "l_orderkey", "o_orderkey", "lineitem"),
        quality.orphan_check(t.lineitem, t.part, "l_partkey", "p_partkey", "lineitem"),
        quality.orphan_check(t.lineitem, t.supplier, "l_suppkey", "s_suppkey", "lineitem"),
        quality.table_checks(t.customer, "customer", "c_custkey", ("c_name",)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-style export of orders (spaced, capitalised headers, text dates) -> clean table."""
    raw = Tables(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("Order Key"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order  Date"),
        F.col("o_orderstatus").alias("Order Status"),
    )
    clean = cleaning.parse_dates(cleaning.standardise_columns(raw), ["order_date"], "yyyy-MM-dd")
    return clean.select(
        "order_key", F.date_format("order_date", "yyyy-MM-dd HH:mm:ss").alias("order_date"), "order_status", "parse_failed"
    )


def q_impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    ev = adapters.with_web_keys(t.events.select("event_id", "user_id", "props")).select("event_id", "device_id")
    num = t.part.groupBy(F.col("p_partkey").alias("device_id")).agg(
        F.min("p_size").alias("p_size"), F.min("p_retailprice").alias("p_retailprice"))
    joined = ev.join(num, "device_id", "left")
    return cleaning.impute_median(joined, ["p_size", "p_retailprice"])


def q_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce_contract(Tables(spark, sf_dir).events, EVENTS_CONTRACT)


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer written as CSV with a header and read back with the header and an explicit
    schema (inference is an extra full pass and may narrow bigint keys to int)."""
    customer = Tables(spark, sf_dir).customer
    path = staging_path(spark, "csv-customer")
    files.write_csv(customer, path)
    return files.read_csv(spark, path, schema=customer.schema)


QUERIES = {
    "experiment_assign": q_experiment_assign,
    "experiment_metrics": q_experiment_metrics,
    "experiment_readout": q_experiment_readout,
    "profit_unit": q_profit_unit,
    "profit_total": q_profit_total,
    "dashboard_cube": q_dashboard_cube,
    "kpi_daily": q_kpi_daily,
    "quality_report": q_quality_report,
    "clean_table": q_clean_table,
    "impute_median": q_impute_median,
    "typed_scan": q_typed_scan,
    "csv_scan": q_csv_scan,
}

ASSIGN = """
asg AS (
  SELECT user_id,
         (('0x' || substr(md5('exp_signup:' || CAST(user_id AS VARCHAR)), 1, 8))::BIGINT) % 100 AS bucket
  FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL)
)"""

CELLS = ASSIGN + """,
fe AS (SELECT user_id, MIN(ts) AS exposed FROM events WHERE event_type = 'view' GROUP BY 1),
pu AS (
  SELECT f.user_id,
         COALESCE(MAX(CASE WHEN e.event_type = 'signup' AND e.ts > f.exposed
                            AND e.ts <= f.exposed + INTERVAL 86400 SECOND THEN 1 ELSE 0 END), 0) AS converted,
         COALESCE(SUM(CASE WHEN e.event_type = 'purchase' AND e.ts > f.exposed
                           THEN CAST(round(e.value * 100) AS BIGINT) ELSE 0 END), 0) AS value_cents
  FROM fe f LEFT JOIN events e ON e.user_id = f.user_id GROUP BY f.user_id
),
cells AS (
  SELECT CASE WHEN a.bucket < 50 THEN 'control' ELSE 'treatment' END AS variant,
         COUNT(*) AS n_units, CAST(SUM(pu.converted) AS BIGINT) AS n_converted,
         CAST(SUM(pu.value_cents) AS BIGINT) AS sum_value,
         CAST(SUM(pu.value_cents * pu.value_cents) AS BIGINT) AS sum_value_sq
  FROM pu JOIN asg a ON a.user_id = pu.user_id GROUP BY 1
),
cm AS (
  SELECT variant, n_units, n_converted, CAST(n_converted AS DOUBLE) / CAST(n_units AS DOUBLE) AS conversion_rate,
         CAST(sum_value AS DOUBLE) / CAST(n_units AS DOUBLE) AS mean_value,
         (CAST(sum_value_sq AS DOUBLE) - CAST(sum_value AS DOUBLE) * CAST(sum_value AS DOUBLE) / CAST(n_units AS DOUBLE))
           / (CAST(n_units AS DOUBLE) - 1) AS var_value
  FROM cells
)"""


def _erfc_sql(x: str) -> str:
    """erfc(x) by integrating the density: 2 / sqrt(pi) * exp(-t * t) over [x, x + 7], Simpson's rule
    on 2,000 strips (another road than the operator's rational approximation)."""
    return f"""(SELECT 2 / sqrt(pi()) * sum(w * exp(-(x0 + i * 0.0035) * (x0 + i * 0.0035))) * 0.0035 / 3
  FROM (SELECT {x} AS x0, i, CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
        FROM range(0, 2001) AS r(i)))"""


_Z = ("(t.conversion_rate - c.conversion_rate) / sqrt(((CAST(c.n_converted + t.n_converted AS DOUBLE)) / "
      "(CAST(c.n_units AS DOUBLE) + CAST(t.n_units AS DOUBLE))) * (1 - ((CAST(c.n_converted + t.n_converted AS DOUBLE)) / "
      "(CAST(c.n_units AS DOUBLE) + CAST(t.n_units AS DOUBLE)))) * (1 / CAST(c.n_units AS DOUBLE) + 1 / CAST(t.n_units AS DOUBLE)))")
_T = ("(t.mean_value - c.mean_value) / sqrt(c.var_value / CAST(c.n_units AS DOUBLE) + "
      "t.var_value / CAST(t.n_units AS DOUBLE))")
_E = "((CAST(c.n_units AS DOUBLE) + CAST(t.n_units AS DOUBLE)) / 2)"
_CHI = (f"((CAST(c.n_units AS DOUBLE) - {_E}) * (CAST(c.n_units AS DOUBLE) - {_E}) / {_E} + "
        f"(CAST(t.n_units AS DOUBLE) - {_E}) * (CAST(t.n_units AS DOUBLE) - {_E}) / {_E})")

ORACLES = {
    "experiment_assign": f"""WITH {ASSIGN}
SELECT user_id, bucket, CASE WHEN bucket < 50 THEN 'control' ELSE 'treatment' END AS variant FROM asg""",
    "experiment_metrics": f"WITH {CELLS} SELECT * FROM cm",
    "experiment_readout": f"""WITH {CELLS},
c AS (SELECT * FROM cm WHERE variant = 'control'), t AS (SELECT * FROM cm WHERE variant = 'treatment')
SELECT 'signup_rate' AS metric, c.n_units AS control_n, t.n_units AS treatment_n,
       c.conversion_rate AS control_value, t.conversion_rate AS treatment_value,
       round({_Z}, 6) AS statistic, round({_erfc_sql(f"abs({_Z}) / sqrt(2.0)")}, 5) AS p_value FROM c, t
UNION ALL
SELECT 'purchase_value', c.n_units, t.n_units, c.mean_value, t.mean_value,
       round({_T}, 6), round({_erfc_sql(f"abs({_T}) / sqrt(2.0)")}, 5) FROM c, t
UNION ALL
SELECT 'allocation', c.n_units, t.n_units, CAST(c.n_units AS DOUBLE), CAST(t.n_units AS DOUBLE),
       round({_CHI}, 6), round({_erfc_sql(f"sqrt({_CHI} / 2)")}, 5) FROM c, t""",
    "profit_unit": """
SELECT p.p_partkey, p.p_type, p.p_brand, x.units, x.revenue_e4,
       x.units * CAST(round(p.p_retailprice * 100) AS BIGINT) * 60 AS cost_e4,
       x.revenue_e4 - x.units * CAST(round(p.p_retailprice * 100) AS BIGINT) * 60 AS profit_e4
FROM (SELECT l_partkey, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
             CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)))
                  AS BIGINT) AS revenue_e4
      FROM lineitem GROUP BY 1) x
JOIN part p ON p.p_partkey = x.l_partkey""",
    "profit_total": """
WITH u AS (
  SELECT p.p_type, p.p_brand, x.units, x.revenue_e4,
         x.units * CAST(round(p.p_retailprice * 100) AS BIGINT) * 60 AS cost_e4
  FROM (SELECT l_partkey, SUM(CAST(l_quantity AS BIGINT)) AS units,
               SUM(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)))
                 AS revenue_e4
        FROM lineitem GROUP BY 1) x
  JOIN part p ON p.p_partkey = x.l_partkey
)
SELECT p_type, p_brand, CAST(SUM(units) AS BIGINT) AS units, CAST(SUM(revenue_e4) AS DECIMAL(38, 0)) AS revenue_e4,
       CAST(SUM(cost_e4) AS DECIMAL(38, 0)) AS cost_e4, CAST(SUM(revenue_e4 - cost_e4) AS DECIMAL(38, 0)) AS profit_e4,
       CAST(GROUPING(p_type, p_brand) AS INTEGER) AS grouping_level
FROM u GROUP BY ROLLUP (p_type, p_brand)""",
    "dashboard_cube": """
SELECT r.r_name AS region, n.n_name AS nation, c.c_mktsegment AS segment,
       CAST(SUM(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents, COUNT(*) AS n_orders,
       CAST(GROUPING(r.r_name, n.n_name, c.c_mktsegment) AS INTEGER) AS grouping_level
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY CUBE (r.r_name, n.n_name, c.c_mktsegment)""",
    "kpi_daily": """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
SELECT CAST(d AS VARCHAR) AS date,
       (SELECT COUNT(*) FROM events e WHERE CAST(e.ts AS DATE) = d) AS n_events,
       (SELECT COUNT(DISTINCT user_id) FROM events e WHERE CAST(e.ts AS DATE) = d) AS active_users,
       (SELECT COUNT(*) FROM events e WHERE CAST(e.ts AS DATE) = d AND event_type = 'signup') AS signups,
       (SELECT COUNT(*) FROM events e WHERE CAST(e.ts AS DATE) = d AND event_type = 'purchase') AS purchases,
       (SELECT CAST(COALESCE(SUM(CAST(round(value * 100) AS BIGINT)), 0) AS BIGINT) FROM events e
        WHERE CAST(e.ts AS DATE) = d AND event_type = 'purchase') AS revenue_cents
FROM days""",
    "quality_report": """
WITH per_day AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, row_number() OVER (ORDER BY CAST(ts AS DATE)) AS i
                 FROM events GROUP BY 1)
SELECT 'events' AS table_name, 'rows' AS check_name, COUNT(*) AS value FROM events
UNION ALL SELECT 'events', 'duplicate_event_id', COUNT(*) - COUNT(DISTINCT event_id) FROM events
UNION ALL SELECT 'events', 'null_user_id', COUNT(*) FILTER (WHERE user_id IS NULL) FROM events
UNION ALL SELECT 'events', 'null_ts', COUNT(*) FILTER (WHERE ts IS NULL) FROM events
UNION ALL SELECT 'events', 'min_daily_rows', MIN(n) FROM (SELECT CAST(ts AS DATE) d, COUNT(*) n FROM events GROUP BY 1)
UNION ALL SELECT 'events', 'max_daily_rows', MAX(n) FROM (SELECT CAST(ts AS DATE) d, COUNT(*) n FROM events GROUP BY 1)
UNION ALL SELECT 'events', 'days_present', COUNT(*) FROM (SELECT DISTINCT CAST(ts AS DATE) d FROM events)
UNION ALL SELECT 'events', 'days_missing', CAST(MAX(d) - MIN(d) + 1 - COUNT(*) AS BIGINT)
  FROM (SELECT DISTINCT CAST(ts AS DATE) d FROM events)
UNION ALL SELECT 'events', 'null_ppm_user_id', COUNT(*) FILTER (WHERE user_id IS NULL) * 1000000 // COUNT(*) FROM events
UNION ALL SELECT 'events', 'null_ppm_ts', COUNT(*) FILTER (WHERE ts IS NULL) * 1000000 // COUNT(*) FROM events
UNION ALL SELECT 'events', 'max_daily_shift', MAX(abs(b.n - a.n)) FROM per_day a JOIN per_day b ON b.i = a.i + 1
UNION ALL SELECT 'events', 'max_daily_shift_ppm', CAST(MAX(floor(abs(b.n - a.n) * 1000000 / a.n)) AS BIGINT)
  FROM per_day a JOIN per_day b ON b.i = a.i + 1
UNION ALL SELECT 'events', 'days_stale', 0
UNION ALL SELECT 'orders', 'days_stale', date_diff('day', (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders),
                                                   (SELECT CAST(MAX(ts) AS DATE) FROM events))
UNION ALL SELECT 'orders', 'null_ppm_o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) * 1000000 // COUNT(*) FROM orders
UNION ALL SELECT 'customer', 'null_ppm_c_name', COUNT(*) FILTER (WHERE c_name IS NULL) * 1000000 // COUNT(*) FROM customer
UNION ALL SELECT 'orders', 'rows', COUNT(*) FROM orders
UNION ALL SELECT 'orders', 'duplicate_o_orderkey', COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'orders', 'null_o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'orders', 'orphan_o_custkey', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem', 'orphan_l_orderkey', COUNT(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'orphan_l_partkey', COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'lineitem', 'orphan_l_suppkey', COUNT(*) FROM lineitem
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'customer', 'rows', COUNT(*) FROM customer
UNION ALL SELECT 'customer', 'duplicate_c_custkey', COUNT(*) - COUNT(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'customer', 'null_c_name', COUNT(*) FILTER (WHERE c_name IS NULL) FROM customer""",
    "clean_table": """
SELECT o_orderkey AS order_key, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || ' 00:00:00' AS order_date,
       o_orderstatus AS order_status, FALSE AS parse_failed
FROM orders""",
    "impute_median": """
WITH x AS (
  SELECT e.event_id, e.user_id * 14 + CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS device_id,
         CAST(p.p_size AS DOUBLE) AS p_size, p.p_retailprice
  FROM events e LEFT JOIN part p
    ON p.p_partkey = e.user_id * 14 + CAST(json_extract_string(e.props, '$.k') AS BIGINT)
)
SELECT event_id, device_id, COALESCE(p_size, (SELECT median(p_size) FROM x)) AS p_size,
       COALESCE(p_retailprice, (SELECT median(p_retailprice) FROM x)) AS p_retailprice
FROM x""",
    "typed_scan": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "csv_scan": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
}
