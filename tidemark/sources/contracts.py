"""Typed scans: a schema contract (types + non-null columns) checked by the job itself.

Python has no typed Dataset; a contract is the counterpart of ``.as[Event]`` with ``Option``
for nullable fields. Type mismatches fail at plan time; a NULL in a non-nullable column fails
the task that reads it (``raise_error``), so bad data never flows on silently.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# column -> (Spark SQL type name, nullable)
Contract = Mapping[str, tuple[str, bool]]

EVENTS_CONTRACT: Contract = {
    "event_id": ("bigint", False),
    "ts": ("timestamp_ntz", False),
    "user_id": ("bigint", True),
    "event_type": ("string", False),
    "value": ("double", True),
    "props": ("string", True),
}


def enforce_contract(df: DataFrame, contract: Contract) -> DataFrame:
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = [
        f"{c}: expected {t}, found {actual.get(c, 'missing')}" for c, (t, _) in contract.items() if actual.get(c) != t
    ]
    if problems:
        raise ValueError("schema contract violated: " + "; ".join(problems))
    cols = []
    for c, (_, nullable) in contract.items():
        col = F.col(c)
        if not nullable:
            col = F.when(col.isNull(), F.raise_error(F.lit(f"NULL in non-nullable column {c}"))).otherwise(col)
        cols.append(col.alias(c))
    return df.select(*cols)
