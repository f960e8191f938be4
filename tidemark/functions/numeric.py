"""Exact fixed-point helpers: money is summed as integer cents so both engines agree bit for bit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Money (double with 2 decimals) -> integer cents."""
    return F.round(amount * 100).cast("long")


def milli(numerator: Column, denominator: Column) -> Column:
    """``numerator div denominator / 1000`` on integers: one division of doubles, at the end."""
    return idiv(numerator, denominator).cast("double") / 1000


def idiv(numerator: Column, denominator: Column) -> Column:
    """Integer division (``div``) of two integral columns, in 64 bits at every size."""
    return F.call_function("div", numerator.cast("long"), denominator.cast("long"))
