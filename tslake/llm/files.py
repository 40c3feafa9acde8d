"""Files that tasks write to and read from a folder all executors share.

A task attempt writes under a name of its own and reports the path; only the
paths that successful attempts report are read, so a lost executor or a
speculative copy leaves at most a file that nothing reads.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tslake.session import work_dir
from tslake.sources import versioned


#: Whether Spark removes an execution's shuffle files when it ends; nothing reads them after a write.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Settings of the session that say how its object store is reached.
STORE_SETTINGS = "endpoint endpoint.region access.key secret.key session.token path.style.access connection.ssl.enabled".split()


def store_settings(spark: SparkSession) -> dict[str, str]:
    """The session's ``fs.s3a`` settings; without keys, the tasks' own credentials count."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {key: conf.get(f"fs.s3a.{key}") for key in STORE_SETTINGS}
    return {key: value for key, value in found.items() if value}


def store_arguments(settings: dict[str, str]) -> dict:
    """Arguments of Arrow's object store for the session's settings."""
    names = {"access.key": "access_key", "secret.key": "secret_key", "session.token": "session_token", "endpoint.region": "region"}
    out: dict = {names[k]: v for k, v in settings.items() if k in names}
    if "endpoint" in settings:
        scheme, _, host = settings["endpoint"].rpartition("://")
        out["endpoint_override"] = host
        out["scheme"] = scheme or ("http" if settings.get("connection.ssl.enabled") == "false" else "https")
        # a custom endpoint serves buckets as paths unless the session says otherwise
        out["force_virtual_addressing"] = settings.get("path.style.access", "true") == "false"
    return out


def locate(uri: str, settings: dict[str, str] | None = None) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file; a plain path is local, and the
    JVM's names of an object store (s3a, s3n) mean the same store here."""
    if re.match(r"file:/(?!/)", uri):
        uri = "file://" + uri[len("file:") :]
    if store := re.match(r"s3[an]?://", uri):
        return pafs.S3FileSystem(**store_arguments(settings or {})), uri[store.end() :]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def write(folder: str, stem: str, suffix: str, data, settings: dict[str, str] | None = None) -> str:
    """Write a new file of the folder and return its path."""
    path = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"
    system, place = locate(path, settings)
    if isinstance(system, pafs.LocalFileSystem):  # an object store has no folders to make
        system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place, compression=None) as out:
        out.write(data)
    return path


def open_input(path: str, settings: dict[str, str] | None = None):
    """The file for random access; a local one is mapped, not read."""
    system, place = locate(path, settings)
    return pa.memory_map(place) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(place)


def settled(spark: SparkSession, df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read again, so that what
    its tasks wrote is never written twice; the shuffles of this one write go
    with it. Its folder is added to ``made``."""
    path = work_dir(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, made: list[str]) -> None:
    """Delete settled tables that nothing reads any more."""
    for path in made:
        versioned.delete(spark, path)
    made.clear()


def spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The manifest's rows dealt out over tasks, a few files each."""
    return manifest.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
