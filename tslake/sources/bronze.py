"""Landing zone (Bronze) and batch manifests (O-01, O-02, O-28a).

Layout written here (Hive-style, so partition columns are real columns):

    <root>/bronze/ingestion_date=<d>/batch_id=<b>/series_name=<s>/part-*.json
    <root>/_control/manifests/part-*.json     one JSON object per batch attempt

Landed rows are never valid on their own: readers join them to committed
manifests (``operators.gate``). ``_control`` starts with an underscore, so
directory reads of the data never see it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslake.sources import versioned
from tslake.sources.schemas import LANDING_PARTITIONS, MANIFEST, RAW

PARTITIONS = [f.name for f in LANDING_PARTITIONS.fields]


def bronze_path(root: str) -> str:
    return f"{root.rstrip('/')}/bronze"


def manifests_path(root: str) -> str:
    return f"{root.rstrip('/')}/_control/manifests"


def applied_path(root: str) -> str:
    return f"{root.rstrip('/')}/_control/applied"


#: What is kept of a landed line that is no JSON object of the schema: the line itself.
RAW_LINE = T.StructField("raw_line", T.StringType())


def landed_schema(extra: Sequence[T.StructField] = ()) -> T.StructType:
    return T.StructType([*RAW.fields, *extra, RAW_LINE, *LANDING_PARTITIONS.fields])


def land(raw: DataFrame, root: str) -> None:
    """Write raw text rows of one or more batches. Re-landing a batch replaces
    exactly its partitions (dynamic overwrite), so a retry is idempotent."""
    (
        raw.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .json(bronze_path(root))
    )


def _escaped(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in versioned.PATH_ESCAPED else c for c in value)


def _folder_value(value: str) -> str:
    return "".join("\\" + c if c in versioned.GLOB_SPECIAL else c for c in _escaped(value))


def batch_folder(root: str, ingestion_date, batch_id: str) -> str:
    return f"{bronze_path(root)}/ingestion_date={ingestion_date}/batch_id={_escaped(str(batch_id))}"


def read_landed(
    spark: SparkSession,
    root: str,
    extra: Sequence[T.StructField] = (),
    batches: Sequence[tuple] | None = None,
) -> DataFrame:
    """Landed rows in one scan (explicit schema). A line that cannot be read is a
    row without values whose text is in ``raw_line``; it is NULL elsewhere.

    Without ``batches`` the whole landing zone is read. With ``batches`` —
    ``(ingestion_date, batch_id)`` pairs taken from manifests — exactly these
    batches' folders are listed and read; a pair without a folder has no rows.
    """
    schema = landed_schema(extra)
    base = bronze_path(root)
    if batches is None:
        return spark.read.schema(schema).option("columnNameOfCorruptRecord", RAW_LINE.name).json(base)
    folders = [
        f"{base}/ingestion_date={day}/batch_id={_folder_value(batch)}"
        for day, batch in sorted({(str(d), str(b)) for d, b in batches})
        if versioned.exists(spark, batch_folder(root, day, batch))
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).option("columnNameOfCorruptRecord", RAW_LINE.name).json(folders)


def read_reference_layout(spark: SparkSession, root: str) -> DataFrame:
    """Read the source system's own layout
    ``<root>/<series>/ingestion_date=<d>/batch_id=<b>/response.json``, whose first
    level is not Hive-style: partition values are parsed from the file path."""
    df = spark.read.schema(RAW).option("recursiveFileLookup", "true").json(root)
    path = F.col("_metadata.file_path")
    pattern = r"/([^/]+)/ingestion_date=([^/]+)/batch_id=([^/]+)/[^/]+$"
    return df.select(
        "data",
        "valor",
        F.regexp_extract(path, pattern, 1).alias("series_name"),
        F.try_to_date(F.regexp_extract(path, pattern, 2), "yyyy-MM-dd").alias("ingestion_date"),
        F.regexp_extract(path, pattern, 3).alias("batch_id"),
    )


def write_manifests(manifests: DataFrame, root: str) -> None:
    """Append manifests (batch_id, ingestion_date, series map, status, and the
    rows' checks if there are any). Each write adds new uniquely named files: a stream over this folder sees every
    attempt, and no file is ever rewritten in place."""
    if "checks" not in manifests.columns:
        manifests = manifests.withColumn("checks", F.lit(None).cast(MANIFEST["checks"].dataType))
    manifests.select(*MANIFEST.fieldNames()).coalesce(1).write.mode("append").json(manifests_path(root))


def manifest_log_path(root: str) -> str:
    return f"{root.rstrip('/')}/_control/manifest_log"


def _tail(spark: SparkSession, root: str) -> tuple[DataFrame | None, list[str], list[str]]:
    """(the snapshot of the manifests or None, the files it was made of, the files
    written since)."""
    path = manifest_log_path(root)
    note = versioned.note(spark, path)
    known = note["files"] if note else []
    tail = sorted(set(versioned.names(spark, manifests_path(root), ".json")) - set(known))
    return versioned.read(spark, path, MANIFEST) if note else None, known, tail


def _manifest_files(spark: SparkSession, root: str, files: Sequence[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json([f"{manifests_path(root)}/{name}" for name in files])


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """All manifests: the snapshot, if there is one, and the files written since;
    without a snapshot all files in one scan."""
    snapshot, _, tail = _tail(spark, root)
    if snapshot is None:
        return spark.read.schema(MANIFEST).json(manifests_path(root))
    return snapshot.unionByName(_manifest_files(spark, root, tail)) if tail else snapshot


def manifest_tail(spark: SparkSession, root: str) -> int:
    """How many manifest files the snapshot does not hold."""
    note = versioned.note(spark, manifest_log_path(root))
    return len(set(versioned.names(spark, manifests_path(root), ".json")) - set(note["files"] if note else []))


def snapshot_manifests(spark: SparkSession, root: str) -> int:
    """Put the deciding manifest of every batch into one Parquet snapshot, which
    takes the place of all files written so far for readers; returns how many
    files it is made of. The files stay, for the stream that reads them as they
    come. The snapshot's names of files are its state: a name per batch attempt."""
    snapshot, known, tail = _tail(spark, root)
    if not tail:
        return len(known)
    rows = _manifest_files(spark, root, tail)
    rows = latest_manifests(rows if snapshot is None else snapshot.unionByName(rows))
    versioned.replace(rows.select(*MANIFEST.fieldNames()).coalesce(1), manifest_log_path(root), {"files": sorted([*known, *tail])})
    return len(known) + len(tail)


def read_reference_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Pretty-printed single-object manifests as written by the source system."""
    return spark.read.schema(MANIFEST).option("multiLine", "true").json(path)


def latest_manifests(manifests: DataFrame) -> DataFrame:
    """The deciding manifest per batch (day and id): the committed one if any exists (a
    committed batch is immutable, D8), else a failed attempt."""
    from tslake.operators.dedupe import latest_per_key

    rank = F.when(F.col("status") == "committed", F.lit(1)).otherwise(F.lit(0))
    return latest_per_key(manifests.withColumn("_rank", rank), ["ingestion_date", "batch_id"], ["_rank"]).drop("_rank")
