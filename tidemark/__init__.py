"""tidemark: analytical table and stream operators on Spark SQL / Structured Streaming.

Every operator is a function ``DataFrame(s) + parameters -> DataFrame``; nothing is
collected to the driver except tiny scalar results (a max date, a row count bound).

Main entry points::

    from tidemark.operators.cumulative import cumulative_backfill, cumulative_step
    from tidemark.operators.scd import scd_backfill, scd_increment
    from tidemark.operators.activity import datelist_backfill, datelist_step, datelist_int
    from tidemark.operators.array_metrics import monthly_array_backfill, monthly_array_step, upsert
    from tidemark.operators.growth import growth_accounting_backfill, growth_accounting_step
    from tidemark.operators.funnel import funnel
    from tidemark.operators.trends import rolling_counts, best_stretch, longest_streak
    from tidemark.streaming.windows import tumbling_counts, session_counts
"""

__version__ = "0.1.0"
