"""Property test: on complete snapshots (every entity present from its first period on), folding
the SCD increment equals the one-pass backfill, for random values including NULLs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tidemark.operators.scd import scd_backfill, scd_increment

VALUES = st.sampled_from(["a", "b", None])
ENTITY = st.tuples(st.integers(min_value=1, max_value=4), st.lists(VALUES, min_size=1, max_size=5))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ENTITY, min_size=1, max_size=5))
def test_scd_fold_equals_backfill(spark, entities):
    rows = []
    for i, (first, values) in enumerate(entities):
        for k, v in enumerate(values):
            rows.append((f"e{i}", first + k, v, (first + k) % 2 == 0))
    snaps = spark.createDataFrame(rows, "name string, season int, cls string, flag boolean")
    lo = min(r[1] for r in rows)
    hi = max(r[1] for r in rows)
    tracked = ["cls", "flag"]
    state = scd_backfill(snaps, ["name"], "season", tracked, as_of=lo)
    for s in range(lo + 1, hi + 1):
        cur = snaps.where(f"season = {s}").withColumnRenamed("season", "current_season")
        state = scd_increment(state, cur, ["name"], tracked, as_of=s)
    expected = scd_backfill(snaps, ["name"], "season", tracked, as_of=hi)
    assertDataFrameEqual(state, expected.select(state.columns))


DAYS = st.lists(st.integers(min_value=0, max_value=14), min_size=1, max_size=8, unique=True)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DAYS, min_size=1, max_size=4))
def test_growth_step_fold_equals_backfill(spark, users):
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.operators import growth as gr

    d0 = dt.date(2024, 1, 1)
    rows = [(u, d0 + dt.timedelta(days=k)) for u, days in enumerate(users) for k in days]
    activity = spark.createDataFrame(rows, "user_id long, event_date date")
    last = d0 + dt.timedelta(days=14)
    rows_all = gr.growth_accounting_backfill(activity, "user_id", "event_date", last)
    state = rows_all.where(F.col("date") == F.lit(d0))
    for i in range(1, 15):
        d = d0 + dt.timedelta(days=i)
        state = gr.growth_accounting_step(state, activity, "user_id", "event_date", d)
        if i % 5 == 0:
            state = state.checkpoint(eager=True)
    assertDataFrameEqual(state, rows_all.where(F.col("date") == F.lit(last)).select(state.columns))


HITS = st.dictionaries(st.integers(min_value=0, max_value=9), st.integers(min_value=1, max_value=5), min_size=1, max_size=6)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(HITS, min_size=1, max_size=4))
def test_monthly_array_step_fold_equals_backfill(spark, users):
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.operators import array_metrics as am

    d0 = dt.date(2024, 3, 1)
    rows = [(u, d0 + dt.timedelta(days=k), n) for u, hits in enumerate(users) for k, n in hits.items()]
    daily = spark.createDataFrame(rows, "user_id long, event_date date, num_hits long")
    last = d0 + dt.timedelta(days=9)
    for fill in (None, 0):
        state = am.monthly_array_backfill(daily, ["user_id"], "event_date", ["num_hits"], d0, fill=fill)
        for i in range(1, 10):
            d = d0 + dt.timedelta(days=i)
            today = daily.where(F.col("event_date") == F.lit(d))
            state = am.monthly_array_step(state, today, ["user_id"], "num_hits", d, fill=fill)
        expected = am.monthly_array_backfill(daily, ["user_id"], "event_date", ["num_hits"], last, fill=fill)
        assertDataFrameEqual(state, expected.select(state.columns))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DAYS, min_size=1, max_size=4))
def test_datelist_fold_and_mask_equal_backfill(spark, users):
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.operators import activity as act

    d0 = dt.date(2024, 1, 1)
    rows = [(u, d0 + dt.timedelta(days=k)) for u, days in enumerate(users) for k in days]
    activity = spark.createDataFrame(rows, "user_id long, event_date date")
    last = d0 + dt.timedelta(days=14)
    state = act.datelist_backfill(activity, ["user_id"], "event_date", d0)
    for i in range(1, 15):
        state = act.datelist_step(state, activity, ["user_id"], "event_date", d0 + dt.timedelta(days=i))
    expected = act.datelist_backfill(activity, ["user_id"], "event_date", last)
    assertDataFrameEqual(state, expected)
    # bit k of the mask (from the top) is set exactly when the user was active k days before
    packed = {r["user_id"]: r["datelist_int"] for r in act.datelist_int(expected).collect()}
    for u, days in enumerate(users):
        want = sum(1 << (31 - (14 - k)) for k in days)
        assert packed[u] == want
    assert act.datelist_int(expected).where(F.col("datelist_int") < 0).count() == 0


def test_integer_division_is_exact_above_doubles(spark):
    from tidemark.functions.numeric import idiv, milli

    big = (1 << 62) + 1
    row = spark.createDataFrame([(big, 1), (big, 3), (7, 2)], "a long, b long").select(
        idiv(F.col("a"), F.col("b")).alias("d"), milli(F.col("a"), F.col("b")).alias("m")).collect()
    assert [r["d"] for r in row] == [big, big // 3, 3]
    assert [r["m"] for r in row] == [float(big) / 1000, float(big // 3) / 1000, 0.003]
