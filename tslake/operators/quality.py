"""Data-quality checks as DataFrames of ``(check_name, column_name, violations)``
(O-29, O-30, O-32). Each check is one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = "check_name string, column_name string, violations bigint"


def _rows(counts: DataFrame, check: str, names: Sequence[str]) -> DataFrame:
    """Turn a one-row frame of counts into one row per column."""
    items = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").cast("bigint").alias("violations")) for n in names]
    )
    return counts.select(F.inline(items)).select(F.lit(check).alias("check_name"), "column_name", "violations")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return _rows(counts, "not_null", columns)


def check_accepted_values(df: DataFrame, accepted: dict[str, Sequence]) -> DataFrame:
    """Rows whose value is outside the accepted list; NULL is not a violation."""
    counts = df.agg(*[F.count_if(~F.col(f"`{c}`").isin(*vals)).alias(c) for c, vals in accepted.items()])
    return _rows(counts, "accepted_values", list(accepted))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once (two aggregations, both
    partial: the first by key, the second a global count)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    counts = dup.agg(F.count(F.lit(1)).alias("k"))
    return counts.select(
        F.lit("unique").alias("check_name"),
        F.lit(",".join(keys)).alias("column_name"),
        F.col("k").alias("violations"),
    )


def check_columns(spark: SparkSession, df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Compare the frame's columns with a declared list (schema metadata only).

    status: ``ok`` (declared and present), ``missing`` (declared, absent),
    ``undeclared`` (present, not declared).
    """
    present = list(df.columns)
    rows = [(c, "ok" if c in present else "missing") for c in declared]
    rows += [(c, "undeclared") for c in present if c not in declared]
    return spark.createDataFrame(rows, "column_name string, status string")
