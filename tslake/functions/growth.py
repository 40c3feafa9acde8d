"""Feature arithmetic (O-24, O-24a, O-25). NULL propagates; division by zero is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def change(x: Column, previous: Column) -> Column:
    return x - previous


def pct_change(x: Column, previous: Column) -> Column:
    """``(x / previous - 1) * 100``; a zero or NULL previous value gives NULL."""
    return (F.try_divide(x, previous) - F.lit(1.0)) * F.lit(100.0)


def spread(a: Column, b: Column) -> Column:
    return a - b


def midpoint(a: Column, b: Column) -> Column:
    return (a + b) / F.lit(2.0)
