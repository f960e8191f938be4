"""Running the step over the periods must equal the one-pass backfill."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tidemark.functions import arrays
from tidemark.operators import activity as act
from tidemark.operators import array_metrics as am
from tidemark.operators import growth as gr
from tidemark.operators.cumulative import cumulative_backfill, cumulative_step
from tidemark.operators.scd import scd_backfill, scd_increment
from tidemark.plans import q_dimensions as qd
from tidemark.plans import q_events as qe
from tidemark.plans.fold import fold_steps
from tidemark.sources import adapters

KEYS = ["player_name"]


def _flat(df):
    return df.select(
        "player_name", "season", "college", "country", arrays.join_values(
            F.transform("history", lambda h: F.concat_ws(":", h["season"].cast("string"), h["pts"].cast("string")))
        ).alias("h"), "is_active", "periods_since_last_active",
    )


def test_players_step_fold_equals_backfill(spark, tables):
    ps = adapters.player_seasons(tables)
    first, last = ps.agg(F.min("season"), F.max("season")).first()
    backfill = cumulative_backfill(ps, KEYS, "season", qd.PLAYER_STATS, qd.PLAYER_STATICS, through=last)
    start = backfill.where(F.col("season") == first)
    folded = fold_steps(
        start, range(first + 1, last + 1),
        lambda prev, s: cumulative_step(prev, ps, KEYS, "season", qd.PLAYER_STATS, qd.PLAYER_STATICS, as_of=s),
        checkpoint_every=3,
    )
    assertDataFrameEqual(_flat(folded), _flat(backfill.where(F.col("season") == last)))


def test_scd_increment_fold_equals_backfill(spark, tables):
    snaps = qd.players_snapshots(tables)
    first, last = snaps.agg(F.min("season"), F.max("season")).first()
    tracked = list(qd.PLAYER_TRACKED)
    state = scd_backfill(snaps, KEYS, "season", tracked, as_of=first)
    for s in range(first + 1, last + 1):
        cur = snaps.where(F.col("season") == s).withColumnRenamed("season", "current_season")
        state = scd_increment(state, cur, KEYS, tracked, as_of=s)
    assertDataFrameEqual(state, scd_backfill(snaps, KEYS, "season", tracked, as_of=last).select(state.columns))


def test_datelist_step_fold_equals_backfill(spark, tables):
    ua = qe.user_activity(tables)
    d1 = ua.agg(F.min("event_date")).first()[0]
    d_last = qe.last_day(tables)
    start = act.datelist_backfill(ua, ["user_id"], "event_date", d1)
    days = [d1 + dt.timedelta(days=i) for i in range(1, (d_last - d1).days + 1)]
    folded = fold_steps(start, days, lambda prev, d: act.datelist_step(prev, ua, ["user_id"], "event_date", d))
    assertDataFrameEqual(folded, act.datelist_backfill(ua, ["user_id"], "event_date", d_last))


def test_monthly_array_step_fold_equals_backfill(spark, tables):
    daily = qe.daily_hits(tables, "user_id")
    d_last = qe.last_day(tables)
    month_start = d_last.replace(day=1)
    state = am.monthly_array_backfill(daily, ["user_id"], "event_date", ["num_hits"], month_start)
    days = [month_start + dt.timedelta(days=i) for i in range(1, d_last.day)]

    def step(prev, d):
        return am.monthly_array_step(prev, daily.where(F.col("event_date") == F.lit(d)), ["user_id"], "num_hits", d)

    folded = fold_steps(state, days, step)
    backfill = am.monthly_array_backfill(daily, ["user_id"], "event_date", ["num_hits"], d_last)
    assertDataFrameEqual(folded, backfill.select(folded.columns))


def test_growth_step_fold_equals_backfill(spark, tables):
    activity = adapters.purchase_activity(tables)
    d_last = qe.last_day(tables)
    d1 = activity.agg(F.min("event_date")).first()[0]
    rows = gr.growth_accounting_backfill(activity, "user_id", "event_date", d_last)
    state = rows.where(F.col("date") == F.lit(d1))
    for i in range(1, (d_last - d1).days + 1):
        d = d1 + dt.timedelta(days=i)
        state = gr.growth_accounting_step(state, activity, "user_id", "event_date", d)
        if i % 7 == 0:
            state = state.checkpoint(eager=True)
        expected = rows.where(F.col("date") == F.lit(d))
        if i in (1, 8, (d_last - d1).days):
            assertDataFrameEqual(state, expected.select(state.columns))
