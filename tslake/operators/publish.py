"""Publishing Gold to a warehouse target (O-05, O-10b, O-28b, O-28c, O-28d).

Targets are Parquet folders or JDBC tables. ``append_new`` matches the
reference (append months past the target's high-water mark, never touch
loaded months); ``upsert`` also corrects months already loaded (D13).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslake.operators.upsert import merge_frames
from tslake.sources import versioned


@dataclass(frozen=True)
class ParquetTarget:
    path: str


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    num_partitions: int = 8
    batch_size: int = 10000


def read_target(spark: SparkSession, target, schema=None) -> DataFrame | None:
    """The target as a DataFrame, or None when it does not exist (D14: only
    a missing target counts as an initial load; other errors propagate)."""
    try:
        if isinstance(target, ParquetTarget):
            return versioned.read(spark, target.path, schema)
        return spark.read.jdbc(target.url, target.table, properties=dict(target.properties))
    except AnalysisException as exc:
        if (exc.getCondition() or "") in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise
    except Exception as exc:  # JDBC drivers report a missing table as a SQL error
        if isinstance(target, JdbcTarget) and "does not exist" in str(exc).lower():
            return None
        raise


def high_water(spark: SparkSession, target, key: str = "reference_month") -> DataFrame | None:
    """``max(key)`` of the target as a one-row frame (O-05). For JDBC the
    aggregate is pushed into the database as a subquery."""
    if isinstance(target, JdbcTarget):
        q = f"(SELECT MAX({_quote(key)}) AS max_key FROM {target.table}) hw"
        try:
            return spark.read.jdbc(target.url, q, properties=dict(target.properties))
        except Exception as exc:
            if "does not exist" in str(exc).lower():
                return None
            raise
    df = read_target(spark, target)
    return None if df is None else df.agg(F.max(key).alias("max_key"))


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'



def _write(df: DataFrame, target, mode: str) -> None:
    if isinstance(target, ParquetTarget):
        (versioned.replace if mode == "overwrite" else versioned.append)(df, target.path)
        return
    props = dict(target.properties)
    (
        df.repartition(target.num_partitions)
        .write.option("batchsize", target.batch_size)
        .option("truncate", "true")  # an overwrite keeps the table's DDL (primary key)
        .jdbc(target.url, target.table, mode=mode, properties=props)
    )


def new_rows(df: DataFrame, hw: DataFrame | None, key: str = "reference_month") -> DataFrame:
    """Rows past the high-water mark (O-10b); the mark is a scalar subquery,
    so nothing goes through the driver."""
    if hw is None:
        return df
    mark = hw.select("max_key").scalar()
    return df.where(mark.isNull() | (F.col(key) > mark))


def publish(spark: SparkSession, df: DataFrame, target, mode: str = "append_new", key: str = "reference_month") -> None:
    """Publish ``df`` (unique by ``key``) to ``target``.

    ``append_new``: initial load appends everything, later loads append rows
    past ``max(key)``. ``upsert``: rows of ``df`` replace target rows with
    the same key, new keys are added. ``overwrite``: replace the target.
    """
    if mode == "overwrite":
        _write(df, target, "overwrite")
        return
    if mode == "append_new":
        # the high-water mark is computed where the data is (a MAX subquery
        # for JDBC), never by pulling the target into Spark
        hw = high_water(spark, target, key)
        _write(new_rows(df, hw, key), target, "append")
        return
    if mode != "upsert":
        raise ValueError(f"unknown publish mode: {mode}")
    if isinstance(target, JdbcTarget):
        # reading the table back and rewriting it would leave it empty after a
        # failure half-way; a database merges its own rows
        raise ValueError("upsert into JDBC is not supported: publish to a staging table (overwrite) and merge there")
    existing = read_target(spark, target, df.schema)
    if existing is None:
        _write(df, target, "append")
        return
    _write(merge_frames(existing.select(*df.columns), df, [key]), target, "overwrite")


def materialize_table(df: DataFrame, table: str) -> DataFrame:
    """Replace a catalog table (``database.name``) and return it (O-28d)."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def materialize(df: DataFrame, path: str, note: dict | None = None) -> DataFrame:
    """Replace a table, whole or not at all, and return it re-read (O-28b, O-28d)."""
    return versioned.replace(df, path, note)
