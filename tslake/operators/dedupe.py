"""Deterministic latest-wins deduplication by key (O-08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return False


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` tuple.

    One aggregation of ``max(struct(order..., values...))``: structs compare
    field by field, so the order decides and the remaining values break ties
    deterministically. Partial aggregation runs before the shuffle, so a hot
    key (say a third of all rows) is reduced to one row per map task and never
    gathered into a single task. NULL sorts lowest, so a non-NULL order value
    wins.
    """
    keys = list(keys)
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.select(*keys).distinct()
    if any(_has_map(df.schema[c].dataType) for c in values):
        # maps are not orderable: order by the order columns only
        winner = F.max_by(F.struct(*values), F.struct(*order)).alias("_w")
        return df.groupBy(*keys).agg(winner).select(*keys, *(F.col(f"_w.{c}").alias(c) for c in values))
    order = list(order)
    rest = [c for c in values if c not in order]  # order columns are packed once
    packed = F.struct(
        *(F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)),
        *(F.col(f"`{c}`").alias(f"_v{i}") for i, c in enumerate(rest)),
    )
    best = df.groupBy(*keys).agg(F.max(packed).alias("_w"))
    field = {c: f"_w._o{i}" for i, c in enumerate(order)} | {c: f"_w._v{i}" for i, c in enumerate(rest)}
    return best.select(*keys, *(F.col(field[c]).alias(c) for c in values))


def latest_by_sequence(df: DataFrame, keys: Sequence[str], sequence: str, value: str) -> DataFrame:
    """``keys``, ``sequence`` and ``value`` of each key's row with the greatest
    ``sequence`` (a rising number, as of a commit); of several with that number the
    greatest value. Numbers are all that the buffers hold, so both aggregations
    are hash aggregations: nothing is sorted, and each is partial before its
    shuffle."""
    per_commit = df.groupBy(*keys, sequence).agg(F.max(value).alias(value))
    return per_commit.groupBy(*keys).agg(F.max(sequence).alias(sequence), F.max_by(value, sequence).alias(value))
