"""Catch-up loop for incremental operators: apply a step per period, cutting lineage.

A fold of N steps builds an N-deep plan (each step a full outer join on the previous
result). Every ``checkpoint_every`` steps the state is written with ``checkpoint()`` into
the shared ``spark.checkpoint.dir`` (reliable, survives executor loss), which truncates the
plan; ``localCheckpoint`` is never used, as its blocks die with the executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import TypeVar

from pyspark.sql import DataFrame

from ..session import checkpoint_dir

P = TypeVar("P")


def fold_steps(
    state: DataFrame,
    periods: Iterable[P],
    step: Callable[[DataFrame, P], DataFrame],
    checkpoint_every: int = 7,
) -> DataFrame:
    checkpoint_dir(state.sparkSession)  # uses the cluster's folder; sets one only when unset
    for i, period in enumerate(periods, start=1):
        state = step(state, period)
        if checkpoint_every and i % checkpoint_every == 0:
            state = state.checkpoint(eager=True)
    return state
