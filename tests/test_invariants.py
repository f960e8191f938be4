"""Table invariants: keys unique, SCD ranges disjoint and covering, arrays sized by the calendar."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import array_metrics as am
from tidemark.operators import growth as gr
from tidemark.operators.scd import scd_backfill
from tidemark.plans import q_dimensions as qd
from tidemark.plans import q_events as qe
from tidemark.sources import adapters


def _unique(df, keys):
    return df.groupBy(*keys).count().where("count > 1").count() == 0


def test_snapshot_keys_unique(tables):
    assert _unique(qd.players_snapshots(tables), ["player_name", "season"])
    assert _unique(qd.actors_snapshots(tables), ["actorid", "year"])


def test_scd_ranges_disjoint_and_cover(tables):
    snaps = qd.players_snapshots(tables)
    scd = scd_backfill(snaps, ["player_name"], "season", list(qd.PLAYER_TRACKED))
    w = Window.partitionBy("player_name").orderBy("start_season")
    gaps = scd.withColumn("prev_end", F.lag("end_season").over(w)).where(
        F.col("prev_end").isNotNull() & (F.col("start_season") != F.col("prev_end") + 1)
    )
    assert gaps.count() == 0
    covered = scd.agg(F.sum(F.col("end_season") - F.col("start_season") + 1)).first()[0]
    assert covered == snaps.count()


def test_hit_array_length_is_day_of_month(tables):
    d = qe.last_day(tables)
    arr = qe.site_hits_backfill(tables, d)
    assert arr.where(F.size("hit_array") != d.day).count() == 0


def test_datelists_strictly_increasing(tables):
    from tidemark.operators.activity import datelist_backfill

    snap = datelist_backfill(qe.user_activity(tables), ["user_id"], "event_date", qe.last_day(tables))
    bad = snap.where(F.size("dates_active") != F.size(F.array_distinct("dates_active"))).count()
    bad += snap.where(F.col("dates_active") != F.array_sort("dates_active")).count()
    assert bad == 0


def test_array_metrics_by_day_sums_to_event_count(tables):
    d = qe.last_day(tables)
    state = qe.array_metrics_state(tables, d)
    total = am.array_to_daily(state, ["metric_name"], "metric_array").agg(F.sum("value")).first()[0]
    n_events = qe.user_activity(tables).where(F.col("event_date") <= F.lit(d)).where(
        F.col("event_date") >= F.lit(d.replace(day=1))
    ).count()
    assert total == n_events


def test_growth_states_are_the_five(tables):
    rows = gr.growth_accounting_backfill(adapters.purchase_activity(tables), "user_id", "event_date", qe.last_day(tables))
    states = {r[0] for r in rows.select("daily_active_state").distinct().collect()}
    states |= {r[0] for r in rows.select("weekly_active_state").distinct().collect()}
    assert states <= {"New", "Retained", "Resurrected", "Churned", "Stale"}
    assert _unique(rows, ["user_id", "date"])
