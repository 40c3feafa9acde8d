"""Upsert by key without a transactional table format (O-15, O-15b).

``merge_frames`` is the pure relational form (matched -> replaced, not matched
-> inserted). ``upsert_table`` applies a source to a partitioned table
(``sources.versioned``). It first makes the *change feed*: the source's rows
joined with the rows of their keys in the touched partitions, exactly whose
folders are read, so that each change stands there with the row before and
after it. The feed decides what is written: a partition that loses a row is
rewritten, one that only gains rows gets one more version beside its others
(until it has ``VERSIONS`` of them), and one without a change is left alone.
Re-running the same source changes nothing, and an interrupted run leaves the
table as it was. The feed may be kept with the table for those who follow it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from tslake.session import work_dir
from tslake.sources import versioned

#: Versions that a partition may have before it is rewritten as one.
VERSIONS = 8
#: From so many partitions on, each is written by a task of its own where tasks are free.
MANY_PARTITIONS = 32


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in source, plus all source rows."""
    keys = list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], mode: str = "overwrite", partitions: int = 0) -> None:
    """Write grouped by the partition columns (few files per partition).

    ``rebalance`` rather than ``repartition``: AQE splits a partition value
    that is too large for one task (a hot series-year) over several tasks and
    files, and merges small ones, instead of funnelling it through one writer.
    Of many ``partitions`` the small ones are not merged: their files are what
    takes the time, so they are spread over the tasks.
    """
    spark = df.sparkSession
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    many = partitions >= MANY_PARTITIONS
    tasks = min(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = spark.conf.get(name)
    if many:
        spark.conf.set(name, "false")
    try:
        (
            (df.hint("rebalance", tasks, *partition_cols) if many else df.hint("rebalance", *partition_cols))
            .sortWithinPartitions(*partition_cols)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_cols)
            .parquet(path)
        )
    finally:
        spark.conf.set(name, before)


# ---- change feed --------------------------------------------------------------
def change_feed(target: DataFrame | None, source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row for each key of ``source`` (one row per key) that changes the
    target: the keys, ``op`` (``insert`` or ``update``), and the rows before and
    after as the structs ``old`` (NULL for an insert) and ``new``.

    With ``order`` the newer of both rows stays: a source row that is older
    than the target's changes nothing, and of equally new ones the greater row
    wins. Without it the source's row stays. A row that is what it was is no
    change.
    """
    keys = list(keys)
    columns = [c for c in source.columns if c not in keys]
    row = lambda df, name: df.select(*keys, F.struct(*columns).alias(name))
    if target is None:
        return row(source, "new").select(*keys, F.lit("insert").alias("op"), F.lit(None).cast(source.select(F.struct(*columns).alias("r")).schema["r"].dataType).alias("old"), "new")
    joined = row(source, "new").join(row(target, "old"), keys, "left")
    changed = ~F.col("new").eqNullSafe(F.col("old"))
    if order:
        rank = lambda name: F.struct(*(F.col(f"{name}.{c}") for c in [*order, *(c for c in columns if c not in order)]))
        changed = F.col("old").isNull() | (rank("new") > rank("old"))
    op = F.when(F.col("old").isNull(), F.lit("insert")).otherwise(F.lit("update"))
    return joined.where(changed).select(*keys, op.alias("op"), "old", "new")


def collapse(feeds: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Consecutive feeds of one table, oldest first, as one: the row before the
    first and after the last change of each key."""
    if len(feeds) == 1:
        return feeds[0]
    both = None
    for i, feed in enumerate(feeds):
        part = feed.withColumn("_i", F.lit(i))
        both = part if both is None else both.unionByName(part)
    return both.groupBy(*keys).agg(
        F.min_by("op", "_i").alias("op"), F.min_by("old", "_i").alias("old"), F.max_by("new", "_i").alias("new")
    )


def replay(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the changes of a feed."""
    return merge_frames(target, feed.select(*keys, "new.*"), keys)


def _feed_key(columns: Sequence[str], keys: Sequence[str]) -> Column:
    """The partition that a feed's row lies in."""
    names = [c if c in keys else f"new.{c}" for c in columns]
    return F.concat_ws(versioned.SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(versioned.NULL)) for c in names])


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    schema: StructType,
    order: Sequence[str] | None = None,
    touched: Sequence[str] | dict[str, tuple[str, str] | None] | None = None,
    keep_feed: bool = False,
) -> DataFrame:
    """Upsert ``source`` (one row per key) into the table at ``path``; returns
    the change feed.

    A key's partition must not change. With ``order`` the newest row of a key
    stays, whether it comes from target or source; without it the source's row
    does. ``touched`` (the source's partition keys, ``versioned.touched_keys``,
    or these with their dates, ``versioned.touched_ranges``) may be passed when
    the caller knows it already, else the source is evaluated once more for it.
    The table keeps the range of dates of every partition: one whose dates the
    source's have not met cannot hold a key of it and is not read. With ``keep_feed`` the feed stays with the table
    until ``versioned.drop_feeds``; else it stays until the next write.
    """
    source = source.select(*schema.fieldNames())
    before = versioned.load(spark, path)
    dated = [k for k in keys if isinstance(schema[k].dataType, DateType)]
    if touched is None:
        touched = versioned.touched_ranges(source, partition_cols, dated[0]) if dated else versioned.touched_keys(source, partition_cols)
    ranges = touched if isinstance(touched, dict) else {}
    live, held = (before["partitions"], before["ranges"]) if before else ({}, {})
    known = [k for k in touched if k in live and not versioned.apart(ranges.get(k), held.get(k))]
    version, folder = versioned.stage(path)
    # nobody follows a table that is not there yet: its first rows are no changes
    if before is None:
        write_partitioned(source, folder, partition_cols, mode="errorifexists", partitions=len(touched))
        versioned.switch_partitions(spark, path, version, list(touched), partition_cols, before, ranges=ranges)
        return change_feed(None, versioned.read_partitioned(spark, path, schema), keys)
    target = versioned.read_partitioned(spark, path, schema, keys=known) if known else None
    feed = change_feed(target, source, keys, order)
    place = versioned.feed_folder(path, version)
    feed.write.parquet(place)
    feed = spark.read.schema(feed.schema).parquet(place)
    counts = feed.groupBy(_feed_key(partition_cols, keys).alias("k")).agg(F.max((F.col("op") == "update").cast("int")).alias("u")).collect()
    # partitions of this run only
    rewritten = sorted(r["k"] for r in counts if r["u"] or len(live.get(r["k"], ())) >= VERSIONS)
    added = sorted({r["k"] for r in counts} - set(rewritten))
    if counts:
        rows = feed.select(*keys, "new.*").select(*schema.fieldNames())
        old = [k for k in rewritten if k in live]
        if old:
            kept = versioned.read_partitioned(spark, path, schema, keys=old).join(feed.where("op = 'update'").select(*keys), list(keys), "left_anti")
            rows = rows.unionByName(kept)
        write_partitioned(rows, folder, partition_cols, mode="errorifexists", partitions=len(counts))
        versioned.switch_partitions(spark, path, version, rewritten, partition_cols, before, added, version, keep_feed, ranges)
        return feed
    versioned.delete(spark, place)
    return spark.createDataFrame([], feed.schema)


def replace_keys(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    schema: StructType,
    touched: Sequence[str],
) -> None:
    """Put the rows of ``source`` (any number per key) in place of all rows of
    their keys; ``touched`` are the partitions they lie in."""
    before = versioned.load(spark, path)
    version, folder = versioned.stage(path)
    source = source.select(*schema.fieldNames())
    known = [k for k in touched if before and k in before["partitions"]]
    if known:
        place = work_dir(spark, "replace")
        source.write.parquet(place)  # read for its keys and for its rows
        source = spark.read.schema(schema).parquet(place)
        kept = versioned.read_partitioned(spark, path, schema, keys=known).join(source.select(*keys).distinct(), list(keys), "left_anti")
        source = source.unionByName(kept)
    write_partitioned(source, folder, partition_cols, mode="errorifexists", partitions=len(touched))
    versioned.switch_partitions(spark, path, version, touched, partition_cols, before)
    if known:
        versioned.delete(spark, place)
