"""Silver: one table for all series, key (series_name, data), partitioned by
(series_name, year) (O-04, O-15b)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslake.operators.history import extend
from tslake.operators.upsert import collapse, replace_keys, upsert_table
from tslake.sources import versioned
from tslake.sources.schemas import SILVER, SILVER_KEYS, SILVER_ORDER, SILVER_PARTITIONS


def silver_path(root: str) -> str:
    return f"{root.rstrip('/')}/silver"


def silver_exists(spark: SparkSession, root: str) -> bool:
    return versioned.load(spark, silver_path(root)) is not None


def read_silver(spark: SparkSession, path: str, series: Sequence[str] | None = None) -> DataFrame:
    """Scan with the fixed schema; a series list becomes a literal partition
    filter, so only those series' folders are read."""
    df = versioned.read_partitioned(spark, path, SILVER)
    if df is None:
        raise FileNotFoundError(f"no Silver table at {path}")
    if series is not None:
        df = df.where(F.col("series_name").isin(list(series)))
    return df


def upsert_silver(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    partitions: Sequence[str] = SILVER_PARTITIONS,
    touched: Sequence[str] | dict[str, tuple[str, str] | None] | None = None,
) -> None:
    """Upsert by (series_name, data); the row of the newest batch stays, so
    Silver depends on the applied batches alone, not on their order.
    ``partitions`` must be the layout the table was created with
    (``SILVER_PARTITIONS`` or ``SILVER_PARTITIONS_MONTHLY``). The change feed
    stays with the table until Gold has applied it."""
    upsert_table(spark, source, path, SILVER_KEYS, partitions, SILVER, order=SILVER_ORDER, touched=touched, keep_feed=True)


HISTORY = T.StructType(
    [
        T.StructField("data", T.DateType()),
        T.StructField("valor", T.DoubleType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("series_name", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)
HISTORY_PARTITIONS = ["series_name", "year"]


def history_path(root: str) -> str:
    return f"{root.rstrip('/')}/history"


def update_history(spark: SparkSession, rows: DataFrame, path: str, touched: Sequence[str] | None = None) -> None:
    """Bring the history up to date with rows of committed batches (O-17). The
    table is partitioned like Silver; of it only the partitions of touched keys
    are read and written. Applying the same rows again changes nothing."""
    touched = versioned.touched_keys(rows.withColumn("year", F.year("data")), HISTORY_PARTITIONS) if touched is None else touched
    history = versioned.read_partitioned(spark, path, HISTORY, keys=touched)
    anew = extend(history, rows).withColumn("year", F.year("data"))
    replace_keys(spark, anew.select(*HISTORY.fieldNames()), path, ["series_name", "data"], HISTORY_PARTITIONS, HISTORY, touched)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    return versioned.read_partitioned(spark, path, HISTORY)


def read_feeds(spark: SparkSession, path: str, feeds: Sequence[str]) -> DataFrame:
    """Several of the table's change feeds as one."""
    return collapse([spark.read.parquet(versioned.feed_folder(path, f)) for f in feeds], SILVER_KEYS)
