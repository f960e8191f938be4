"""Registry of the queries (one per operator of the coverage checklist) and their SQL oracles."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("q_dimensions", "q_events", "q_analytics", "q_matches", "q_kpi", "q_streaming")


def _load():
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    oracles: dict[str, str] = {}
    for name in _MODULES:
        mod = importlib.import_module(f"{__package__}.{name}")
        for key, fn in mod.QUERIES.items():
            if key in queries:
                raise ValueError(f"duplicate query {key}")
            queries[key] = fn
        oracles.update(getattr(mod, "ORACLES", {}))
    missing = set(oracles) - set(queries)
    if missing:
        raise ValueError(f"oracles without queries: {sorted(missing)}")
    return queries, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _load()[0]


def oracle_sql() -> dict[str, str]:
    return _load()[1]
