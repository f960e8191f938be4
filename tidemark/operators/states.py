"""Entity state transitions between consecutive snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# State labels of the reference's player state tracking.
NEW = "New"
RETIRED = "Retired"
CONTINUED = "Continued Playing"
RETURNED = "Returned from Retirement"
STAYED_RETIRED = "Stayed Retired"


def player_state_changes(
    snapshots: DataFrame, keys: Sequence[str], time_col: str, active_col: str = "is_active"
) -> DataFrame:
    """Label each snapshot row by the activity change from the entity's previous row.

    Window per entity (bounded by the number of periods), one exchange on the keys.
    """
    w = Window.partitionBy(*keys).orderBy(time_col)
    prev = F.lag(active_col).over(w)
    has_prev = F.lag(F.lit(1)).over(w).isNotNull()
    now = F.col(active_col)
    state = (
        F.when(~has_prev, NEW)
        .when(prev & now, CONTINUED)
        .when(prev & ~now, RETIRED)
        .when(~prev & now, RETURNED)
        .otherwise(STAYED_RETIRED)
    )
    return snapshots.withColumn("state", state)
