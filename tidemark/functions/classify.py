"""Threshold and pattern bucketing as column expressions (JVM side, codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's class labels and default thresholds.
SCORING_LABELS = ("star", "good", "average", "bad")
PLAYER_THRESHOLDS = (20.0, 15.0, 10.0)  # points per game: > 20 star, > 15 good, > 10 average
ACTOR_THRESHOLDS = (8.0, 7.0, 6.0)  # average rating: > 8 star, > 7 good, > 6 average

# Thresholds that give four well-filled classes on the driver's customer/orders stand-in.
STANDIN_PLAYER_THRESHOLDS = (35.0, 25.0, 15.0)


def threshold_class(value: Column, thresholds: Sequence[float], labels: Sequence[str] = SCORING_LABELS) -> Column:
    """``value > t0 -> labels[0]``, ``> t1 -> labels[1]``, ...; anything else (null too) -> last label."""
    if len(labels) != len(thresholds) + 1:
        raise ValueError("need one more label than thresholds")
    expr = None
    for t, label in zip(thresholds, labels):
        expr = F.when(value > F.lit(t), label) if expr is None else expr.when(value > F.lit(t), label)
    return expr.otherwise(labels[-1])


def pattern_class(value: Column, rules: Sequence[tuple[str, str]], default: Column | None = None) -> Column:
    """Ordered ``LIKE`` rules: first matching pattern wins, else ``default`` (the raw value)."""
    expr = None
    for pattern, label in rules:
        cond = value.like(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    fallback = value if default is None else default
    return fallback if expr is None else expr.otherwise(fallback)


# Referrer rules of the reference, in its order (D12: '%t.co%' also hits reddit.com).
REFERENCE_REFERRER_RULES = (
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
)
# (The reference also maps its own site domains to "On Site"; pass such rules as a parameter.)

# Rules that fire on the driver's page urls; ordered, and they overlap, so order matters.
STANDIN_REFERRER_RULES = (
    ("%//m.%", "Mobile"),
    ("%//blog.%", "Blog"),
    ("%example.com%", "Example COM"),
    ("%example.net%", "Example NET"),
)
