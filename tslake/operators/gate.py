"""Manifests, the commit gate and reconciliation (O-02, O-09, O-12, O-13, O-31)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.operators.small import small_side
from tslake.sources.schemas import CHANGED_STATUSES

# A batch is known by its landing day and its id; another day's batch of the
# same id is another batch.
BATCH = ["ingestion_date", "batch_id"]
BATCH_KEYS = [*BATCH, "series_name"]


def manifest_entries(manifests: DataFrame) -> DataFrame:
    """One row per (batch, series) from manifests with a ``series`` map."""
    return manifests.select(
        "batch_id",
        "ingestion_date",
        F.col("status").alias("batch_status"),
        F.explode("series").alias("series_name", "series_status"),
    )


def committed_changes(entries: DataFrame) -> DataFrame:
    """Entries of committed batches whose series changed (``new_data``; the
    older spelling ``success`` is accepted too)."""
    return entries.where(
        (F.col("batch_status") == "committed") & F.col("series_status").isin(*CHANGED_STATUSES)
    )


def gate(bronze: DataFrame, entries: DataFrame) -> DataFrame:
    """Landed rows that a committed manifest vouches for (left semi join).

    The manifest side holds one row per (batch, series); it is materialised,
    counted and broadcast when small, so that landed rows are not shuffled.
    """
    ok = small_side(committed_changes(entries).select(*BATCH_KEYS).distinct())
    return bronze.join(ok, BATCH_KEYS, "left_semi")


def rollup_batches(entries: DataFrame) -> DataFrame:
    """Batch status from series statuses (O-13): any ``failed`` -> ``failed``.

    ``entries``: batch_id, ingestion_date, series_name, series_status. The map
    holds one entry per catalogue series, so its size is bounded by the
    catalogue, not by the data.
    """
    failed = F.col("series_status") == "failed"
    return entries.groupBy("batch_id", "ingestion_date").agg(
        F.when(F.bool_or(failed), F.lit("failed")).otherwise(F.lit("committed")).alias("status"),
        F.map_from_entries(F.collect_list(F.struct("series_name", "series_status"))).alias("series"),
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(failed).alias("n_failed"),
    )


def accept_new_manifests(new: DataFrame, existing: DataFrame | None) -> DataFrame:
    """A committed batch (day and id) is immutable: drop new manifests for such (D8)."""
    if existing is None:
        return new
    committed = existing.where(F.col("status") == "committed").select(*BATCH)
    return new.join(committed, BATCH, "left_anti")


def pending_batches(manifests: DataFrame, applied: DataFrame) -> DataFrame:
    """Committed batches not yet applied to Silver (O-12, D7)."""
    committed = manifests.where(F.col("status") == "committed").select("batch_id", "ingestion_date")
    return committed.join(applied.select(*BATCH), BATCH, "left_anti").select("batch_id", "ingestion_date")


def reconcile(entries: DataFrame, objects: DataFrame) -> DataFrame:
    """Manifest <-> landed-object reconciliation (O-31), anti joins both ways.

    ``objects``: distinct (ingestion_date, batch_id, series_name) that have landed data.
    Issues: ``missing_object`` (committed change without data) and
    ``orphan_object`` (data of a series that no committed manifest lists,
    e.g. everything landed by a failed batch). A series listed as unchanged
    may carry an object (the source system copies the previous one).
    """
    claimed = committed_changes(entries).select(*BATCH_KEYS)
    listed = entries.where(F.col("batch_status") == "committed").select(*BATCH_KEYS)
    landed = objects.select(*BATCH_KEYS).distinct()
    missing = claimed.join(landed, BATCH_KEYS, "left_anti").withColumn("issue", F.lit("missing_object"))
    orphan = landed.join(listed, BATCH_KEYS, "left_anti").withColumn("issue", F.lit("orphan_object"))
    return missing.unionByName(orphan)


def content_checks(rows: DataFrame) -> DataFrame:
    """What the landed text of each object (batch and series) adds up to: the
    number of rows and the sum of their 64-bit hashes, which no order of rows or
    files changes (O-31). Sums are decimal, so that they cannot overflow."""
    row = F.xxhash64("data", "valor").cast("decimal(20,0)")
    check = F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(row).cast("string"))
    return rows.groupBy(*BATCH_KEYS).agg(check.alias("check"))


def with_checks(manifests: DataFrame, rows: DataFrame) -> DataFrame:
    """Manifests with the checks of their batches' rows (one entry per series)."""
    per_batch = content_checks(rows).groupBy(*BATCH).agg(F.map_from_entries(F.collect_list(F.struct("series_name", "check"))).alias("checks"))
    return manifests.drop("checks").join(per_batch, BATCH, "left")


def altered_objects(manifests: DataFrame, rows: DataFrame) -> DataFrame:
    """Objects of committed batches whose rows are not those the manifest was
    written for: rows changed, added or lost since. An object that is gone
    altogether is ``reconcile``'s ``missing_object``."""
    stated = manifests.where((F.col("status") == "committed") & F.col("checks").isNotNull()).select(*BATCH, F.explode("checks").alias("series_name", "stated"))
    found = content_checks(rows).join(stated, BATCH_KEYS)
    return found.where(F.col("check") != F.col("stated")).select(*BATCH_KEYS, F.lit("altered_object").alias("issue"))
