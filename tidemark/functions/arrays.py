"""Array helpers with Postgres-like null behaviour, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_array(element_type: str) -> Column:
    """Typed empty array (``ARRAY[]::T[]``)."""
    return F.array().cast(f"array<{element_type}>")


def append(arr: Column, element: Column, element_type: str) -> Column:
    """``arr || ARRAY[element]`` where a null ``arr`` counts as empty."""
    return F.concat(F.coalesce(arr, empty_array(element_type)), F.array(element))


def append_if(arr: Column, cond: Column, element: Column, element_type: str) -> Column:
    """Append ``element`` only when ``cond``; a null ``arr`` counts as empty."""
    base = F.coalesce(arr, empty_array(element_type))
    return F.when(cond, F.concat(base, F.array(element))).otherwise(base)


def fill(value: Column, n: Column, element_type: str) -> Column:
    """``ARRAY_FILL(value, ARRAY[n])``; n <= 0 gives an empty array."""
    return F.array_repeat(value.cast(element_type), F.greatest(n, F.lit(0)).cast("int"))


def last(arr: Column) -> Column:
    """Last element or null for an empty/null array (Postgres ``a[cardinality(a)]``)."""
    return F.try_element_at(arr, F.lit(-1))


def first(arr: Column) -> Column:
    return F.get(arr, 0)


def join_values(arr: Column, sep: str = ",", null_text: str = "null") -> Column:
    """Flatten an array of scalars to text (for flat, comparable outputs)."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep, null_text)
