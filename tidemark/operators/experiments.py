"""Experiment assignment, exposure/conversion metrics and a significance readout.

All heavy work is Spark aggregation; the readout works on the one-row-per-cell result with
column expressions (normal approximation; erfc by a rational approximation, |error| < 1.2e-7).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL, TREATMENT = "control", "treatment"


def assign(units: DataFrame, unit_col: str, experiment: str, treatment_pct: int = 50) -> DataFrame:
    """Deterministic cell: first 32 bits of md5('<experiment>:<unit>') mod 100 (stable across
    processes and engines, unlike a salted language hash)."""
    key = F.concat(F.lit(f"{experiment}:"), F.col(unit_col).cast("string"))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100
    return units.select(
        unit_col, bucket.alias("bucket"), F.when(bucket < 100 - treatment_pct, CONTROL).otherwise(TREATMENT).alias("variant")
    )


def exposure_metrics(
    events: DataFrame,
    assignment: DataFrame,
    unit_col: str,
    time_col: str,
    type_col: str,
    exposure: str,
    conversion: str,
    value_type: str,
    value_col: str,
    window_seconds: int = 86400,
) -> DataFrame:
    """Per unit after its first ``exposure`` event: converted = a ``conversion`` event within
    ``window_seconds``; value = sum of ``value_type`` values (integer cents) after exposure.
    One aggregate per unit for the exposure time, one join, one aggregate per unit."""
    first = events.where(F.col(type_col) == exposure).groupBy(unit_col).agg(F.min(time_col).alias("_exposed"))
    ev = events.where(F.col(type_col).isin(conversion, value_type)).join(first, unit_col)
    after = F.col(time_col) > F.col("_exposed")
    in_window = after & (F.col(time_col) <= F.col("_exposed") + F.expr(f"INTERVAL {window_seconds} SECONDS"))
    cents = F.round(F.col(value_col) * 100).cast("long")
    per_unit = ev.groupBy(unit_col).agg(
        F.max(((F.col(type_col) == conversion) & in_window).cast("int")).alias("converted"),
        F.sum(F.when((F.col(type_col) == value_type) & after, cents).otherwise(0)).alias("value_cents"),
    )
    exposed = first.join(per_unit, unit_col, "left").select(
        unit_col,
        F.coalesce(F.col("converted"), F.lit(0)).cast("long").alias("converted"),
        F.coalesce(F.col("value_cents"), F.lit(0)).cast("long").alias("value_cents"),
    )
    return exposed.join(assignment, unit_col)


def cell_metrics(per_unit: DataFrame) -> DataFrame:
    """One row per variant: n, conversions, rate, value mean and sample variance (from exact
    integer sums, so the result does not depend on summation order)."""
    agg = per_unit.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.sum("converted").alias("n_converted"),
        # decimals: a sum of squared cents passes a long's range on a large table
        F.sum(F.col("value_cents").cast("decimal(19,0)")).alias("sum_value"),
        F.sum((F.col("value_cents").cast("decimal(19,0)") * F.col("value_cents").cast("decimal(19,0)")).cast("decimal(38,0)"))
        .alias("sum_value_sq"),
    )
    n = F.col("n_units").cast("double")
    s = F.col("sum_value").cast("double")
    return agg.select(
        "variant", "n_units", "n_converted",
        (F.col("n_converted").cast("double") / n).alias("conversion_rate"),
        (s / n).alias("mean_value"),
        F.try_divide(F.col("sum_value_sq").cast("double") - s * s / n, n - 1).alias("var_value"),
    )


def erfc(x: Column) -> Column:
    """Complementary error function (Numerical Recipes rational approximation) for x >= 0."""
    t = 1.0 / (1.0 + 0.5 * x)
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398,
              1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


def two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / math.sqrt(2.0))


def readout(cells: DataFrame, p_digits: int = 6) -> DataFrame:
    """Control vs treatment: two-proportion z test (conversion), Welch statistic with a normal
    p-value (value), chi-square allocation check against 50/50. Input is one row per cell."""
    # Pivot the two cell rows into one row with a conditional aggregate (no join).
    metrics = [x for x in cells.columns if x != "variant"]
    both = cells.agg(
        *[F.max(F.when(F.col("variant") == CONTROL, F.col(x))).alias(f"c_{x}") for x in metrics],
        *[F.max(F.when(F.col("variant") == TREATMENT, F.col(x))).alias(f"t_{x}") for x in metrics],
    )
    nc, nt = F.col("c_n_units").cast("double"), F.col("t_n_units").cast("double")
    pc, pt = F.col("c_conversion_rate"), F.col("t_conversion_rate")
    pooled = (F.col("c_n_converted") + F.col("t_n_converted")).cast("double") / (nc + nt)
    # try_divide: a degenerate cell (no conversions, zero variance) gives a NULL statistic
    # instead of failing the job under ANSI division rules
    z_conv = F.try_divide(pt - pc, F.sqrt(pooled * (1 - pooled) * (1 / nc + 1 / nt)))
    t_val = F.try_divide(
        F.col("t_mean_value") - F.col("c_mean_value"), F.sqrt(F.col("c_var_value") / nc + F.col("t_var_value") / nt)
    )
    expected = (nc + nt) / 2
    chi2 = (nc - expected) * (nc - expected) / expected + (nt - expected) * (nt - expected) / expected
    rows = [
        ("signup_rate", pc, pt, z_conv, two_sided_p(z_conv)),
        ("purchase_value", F.col("c_mean_value"), F.col("t_mean_value"), t_val, two_sided_p(t_val)),
        ("allocation", nc, nt, chi2, erfc(F.sqrt(chi2 / 2))),
    ]
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("metric"), F.col("c_n_units").alias("control_n"), F.col("t_n_units").alias("treatment_n"),
            a.cast("double").alias("control_value"), b.cast("double").alias("treatment_value"),
            F.round(stat, 6).alias("statistic"), F.round(p, p_digits).alias("p_value"))
        for name, a, b, stat, p in rows])
    return both.select(F.inline(lines))  # one row of both cells gives the three lines
