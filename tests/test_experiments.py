"""Experiment readout math: erfc approximation, z statistic, assignment stability."""

import math

from pyspark.sql import functions as F

from tidemark.operators import experiments as ex


def test_erfc_approximation(spark):
    xs = [0.0, 0.1, 0.5, 1.0, 1.5, 2.0, 3.0, 4.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(ex.erfc(F.col("x"))).collect()]
    for x, g in zip(xs, got):
        assert abs(g - math.erfc(x)) < 1.3e-7 * max(1.0, math.erfc(x))


def test_readout_two_proportion_z(spark):
    cells = spark.createDataFrame(
        [("control", 1000, 100, 0.10, 5.0, 4.0), ("treatment", 1000, 130, 0.13, 5.5, 4.0)],
        "variant string, n_units long, n_converted long, conversion_rate double, mean_value double, var_value double",
    )
    rows = {r["metric"]: r for r in ex.readout(cells).collect()}
    p = 230 / 2000
    z = (0.13 - 0.10) / math.sqrt(p * (1 - p) * (2 / 1000))
    assert abs(rows["signup_rate"]["statistic"] - z) < 1e-6
    assert abs(rows["signup_rate"]["p_value"] - math.erfc(abs(z) / math.sqrt(2))) < 1e-6
    t = 0.5 / math.sqrt(4.0 / 1000 + 4.0 / 1000)
    assert abs(rows["purchase_value"]["statistic"] - t) < 1e-6
    assert rows["allocation"]["statistic"] == 0.0 and abs(rows["allocation"]["p_value"] - 1.0) < 1e-6


def test_assignment_is_stable_and_balanced(spark):
    units = spark.range(0, 20000).withColumnRenamed("id", "user_id")
    a1 = ex.assign(units, "user_id", "exp_a")
    a2 = ex.assign(units, "user_id", "exp_a")
    assert a1.join(a2, "user_id").where(a1.variant != a2.variant).count() == 0
    share = a1.where("variant = 'treatment'").count() / 20000
    assert 0.48 < share < 0.52
    other = ex.assign(units, "user_id", "exp_b")
    agree = a1.join(other, "user_id").where(a1.variant == other.variant).count() / 20000
    assert 0.45 < agree < 0.55  # independent salts per experiment


def test_readout_degenerate_cells_give_null_not_error(spark):
    cells = spark.createDataFrame(
        [("control", 10, 0, 0.0, 0.0, 0.0), ("treatment", 10, 0, 0.0, 0.0, 0.0)],
        "variant string, n_units long, n_converted long, conversion_rate double, mean_value double, var_value double",
    )
    rows = {r["metric"]: r for r in ex.readout(cells).collect()}
    assert rows["signup_rate"]["statistic"] is None or rows["signup_rate"]["statistic"] != rows["signup_rate"]["statistic"]


def test_sums_pass_the_range_of_a_long(spark):
    from tidemark.operators import kpi

    rows = [("control", 1, 6_000_000_000), ("control", 0, 6_000_000_000), ("treatment", 0, 1), ("treatment", 1, 3)]
    cells = ex.cell_metrics(spark.createDataFrame(rows, "variant string, converted long, value_cents long"))
    got = {r["variant"]: (r["mean_value"], r["var_value"]) for r in cells.collect()}
    assert got == {"control": (6e9, 0.0), "treatment": (2.0, 2.0)}
    big = spark.createDataFrame([("t", "b", 1, 2**62, 0, 2**62)] * 3, "p_type string, p_brand string, units long, "
                                "revenue_e4 long, cost_e4 long, profit_e4 long")
    assert {int(r["revenue_e4"]) for r in kpi.total_profit(big).collect()} == {3 * 2**62}
