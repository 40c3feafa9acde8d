"""Joins of observations with frames of one row per series or batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.session import checkpoint_root

#: A side of at most this many rows (of a few short columns) is broadcast; a
#: larger one is joined by shuffle. Either way the result is the same.
SMALL_ROWS = 1_000_000


def small_side(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` materialised and counted, and marked for broadcast if it is small."""
    checkpoint_root(df.sparkSession)
    df = df.checkpoint(eager=True)
    return F.broadcast(df) if df.count() <= limit else df
