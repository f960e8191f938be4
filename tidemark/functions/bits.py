"""Bit-packed activity: 32 days of history in the low 32 bits of a long."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_DAYS = 32
# Masks over the 32-bit activity int (most significant bit = as-of day).
LAST_7_DAYS_MASK = 4261412864  # bits 31..25: days 0-6 before the as-of date
PREVIOUS_7_DAYS_MASK = 33292288  # bits 24..18: days 7-13 before the as-of date


def _bit(position: Column) -> Column:
    """``1 << position`` for a column position (powers of two are exact in a double)."""
    return F.pow(F.lit(2.0), position).cast("long")


def datelist_to_int(dates: Column, as_of: Column) -> Column:
    """Fold an array of active dates into a 32-bit mask: bit (31 - days_before_as_of)."""
    in_range = F.filter(dates, lambda d: F.datediff(as_of, d).between(0, WINDOW_DAYS - 1))
    return F.aggregate(
        in_range,
        F.lit(0).cast("long"),
        lambda acc, d: acc.bitwiseOR(_bit(31 - F.datediff(as_of, d))),
    )


def day_bit(day: Column, as_of: Column) -> Column:
    """Single-day bit, 0 when the day is outside the 32-day window (for ``bit_or`` aggregation)."""
    back = F.datediff(as_of, day)
    return F.when(back.between(0, WINDOW_DAYS - 1), _bit(31 - back)).otherwise(
        F.lit(0).cast("long")
    )


def count_bits(mask: Column, bits: int | None = None) -> Column:
    m = mask if bits is None else mask.bitwiseAND(F.lit(bits).cast("long"))
    return F.bit_count(m).cast("long")
