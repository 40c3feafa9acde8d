"""Tables that are replaced as a whole or not at all.

A table folder holds version folders ``v=<id>`` of Parquet files and small state
files ``_state-<n>.json``; the one of the highest number says what is live. A
write goes to a version folder of its own; then the next state file is put in
place by one rename that fails if the file is there already. A write that is
interrupted leaves the table as it was, a folder without a state file is no
table, and of two writers that started from the same state the second one gets
``LostUpdate`` instead of undoing the first. What a commit takes out of use is
deleted before the following commit, so readers of the former state can finish.

Two kinds: plain tables list their live versions (one after a replacement, one
more after each append); partitioned tables list the live versions of every
partition, so that a write adds to or replaces only the partitions it touches,
and a replaced partition's folder is freed although its version lives on. The
state grows with the number of versions or partitions, not with the rows.

A table may carry change feeds (folders ``f=<id>``, see ``operators.upsert``)
and a small note of its writer, both committed with the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE = "_state-{:012d}.json"
VERSION, FEED = "v", "f"
#: Separates the values of a partition key; stands for a null value.
SEPARATOR, NULL = "\x1f", "\x00"

# FIXED VALUES: characters that Hive-style partition folder names escape as
# %XX (as Spark writes them), and the folder name of a null value.
PATH_ESCAPED = set('"#%\'*/:=?\\{[]^\x7f') | {chr(i) for i in range(1, 32)}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# FIXED VALUE: the metacharacters of Hadoop glob patterns.
GLOB_SPECIAL = set("{}[]*?,\\")


class LostUpdate(RuntimeError):
    """Another writer committed to the table since this one had read its state."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, place, place.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    _, _, place, fs = _files(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own, if it is there."""
    _, _, place, fs = _files(spark, path)
    fs.delete(place, True)


def names(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Names of a folder's files that end with ``suffix``; none if it is not there."""
    _, _, place, fs = _files(spark, path)
    if not fs.exists(place):
        return []
    return sorted(n for f in fs.listStatus(place) if f.isFile() and (n := f.getPath().getName()).endswith(suffix) and n[0] not in "._")


def load(spark: SparkSession, path: str) -> dict | None:
    """What is live, or None if there is no table."""
    jvm, _, place, fs = _files(spark, f"{path}/_state-*.json")
    found = fs.globStatus(place)
    if not found:
        return None
    source = fs.open(max((f.getPath() for f in found), key=lambda p: p.getName()))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def _switch(spark: SparkSession, path: str, state: dict, before: dict | None) -> None:
    """Commit ``state``, made from ``before``."""
    for folder in (before or {}).get("retired", []):
        delete(spark, f"{path}/{folder}")
    state["commit"] = before["commit"] + 1 if before else 0
    state["retired"] = _retired(state, before) + [f"{FEED}={f}" for f in state.pop("passing", [])]
    jvm, conf, place, fs = _files(spark, f"{path}/{STATE.format(state['commit'])}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/_{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(state).encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(draft, place, options)
    except Exception as exc:
        fs.delete(draft, False)
        if fs.exists(place):
            raise LostUpdate(f"{path}: another writer has made commit {state['commit']}") from exc
        raise
    if state["commit"] > 1:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{STATE.format(state['commit'] - 2)}"), False)


def _live(state: dict | None) -> dict[str, set[str] | None]:
    """Live versions; of partitioned tables with the keys that live there."""
    if state is None:
        return {}
    if "versions" in state:
        return dict.fromkeys(state["versions"])
    out: dict[str, set[str]] = {}
    for key, versions in state["partitions"].items():
        for version in versions:
            out.setdefault(version, set()).add(key)
    return out


def _retired(state: dict, before: dict | None) -> list[str]:
    """Folders that ``before`` uses and ``state`` does not."""
    now, out = _live(state), []
    for version, keys in _live(before).items():
        if version not in now:
            out.append(f"{VERSION}={version}")
        elif keys is not None:
            out += [_folder(version, state["columns"], key) for key in sorted(keys - now[version])]
    feeds = set(state.get("feeds", []))
    return out + [f"{FEED}={f}" for f in (before or {}).get("feeds", []) if f not in feeds]


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by as many tasks as the cluster runs at once, not by a
    task for each folder."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), max(2, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# ---- plain tables -----------------------------------------------------------
def _add(df: DataFrame, path: str, append: bool, note: dict | None = None) -> DataFrame:
    spark = df.sparkSession
    before = load(spark, path)
    version = uuid.uuid4().hex[:16]
    df.write.parquet(f"{path}/{VERSION}={version}")
    kept = before["versions"] if append and before else []
    _switch(spark, path, {"versions": [*kept, version], "note": note or {}}, before)
    return read(spark, path, df.schema)


def replace(df: DataFrame, path: str, note: dict | None = None) -> DataFrame:
    """Make ``df`` the table's content; returns the table re-read. ``note`` is
    kept with it (``note``)."""
    return _add(df, path, append=False, note=note)


def append(df: DataFrame, path: str) -> DataFrame:
    """Add ``df`` to the table's content; returns the table re-read."""
    return _add(df, path, append=True)


def note(spark: SparkSession, path: str) -> dict | None:
    """What the last writer left beside the rows, and the commit's number; None
    if there is no table."""
    state = load(spark, path)
    return None if state is None else {**state.get("note", {}), "commit": state["commit"]}


def read(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """A plain table, or None if there is none."""
    state = load(spark, path)
    if state is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    with _listing(spark):
        return reader.parquet(*(f"{path}/{VERSION}={version}" for version in state["versions"]))


# ---- partitioned tables -----------------------------------------------------
def partition_key(columns: Sequence[str]) -> Column:
    """One string for the values of the partition columns. A flat ``isin`` over
    it is a partition filter of any length."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in columns])


def touched_keys(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Keys of the partitions ``df`` has rows of: bounded by the partitions."""
    return sorted(r[0] for r in df.select(partition_key(columns)).distinct().collect())


def touched_ranges(df: DataFrame, columns: Sequence[str], key: str) -> dict[str, tuple[str, str] | None]:
    """Keys of the partitions ``df`` has rows of, each with the least and the
    greatest ``key`` (a date) there; None where one is missing."""
    ends = df.groupBy(partition_key(columns).alias("k")).agg(F.min(key).cast("string").alias("a"), F.max(key).cast("string").alias("b"), F.count_if(F.col(key).isNull()).alias("n"))
    return {r["k"]: (r["a"], r["b"]) if r["a"] is not None and not r["n"] else None for r in ends.collect()}


def apart(a: Sequence[str] | None, b: Sequence[str] | None) -> bool:
    """Whether two ranges of dates have none in common."""
    return a is not None and b is not None and (a[1] < b[0] or b[1] < a[0])


def touched_filter(keys: Sequence[str], columns: Sequence[str]) -> Column:
    return partition_key(columns).isin(list(keys)) if keys else F.lit(False)


def _folder(version: str, columns: Sequence[str], key: str) -> str:
    """The folder of one partition in a version."""
    values = [NULL_FOLDER if v in (NULL, "") else "".join(f"%{ord(c):02X}" if c in PATH_ESCAPED else c for c in v) for v in key.split(SEPARATOR)]
    return "/".join([f"{VERSION}={version}", *(f"{c}={v}" for c, v in zip(columns, values))])


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] | None = None) -> DataFrame | None:
    """A partitioned table, or None if there is none; filters on its partition
    columns prune folders as usual. With ``keys`` exactly the folders of these
    partitions are listed and read."""
    state = load(spark, path)
    if state is None:
        return None
    partitions = state["partitions"]
    whole = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    reader = spark.read.schema(whole).option("basePath", path)
    if keys is not None:
        escape = lambda folder: "".join("\\" + c if c in GLOB_SPECIAL else c for c in folder)
        folders = [f"{path}/{escape(_folder(version, state['columns'], key))}" for key in keys for version in partitions.get(key, [])]
    else:
        folders = [f"{path}/{VERSION}={version}" for version in sorted(_live(state))]
    if not folders:
        return spark.createDataFrame([], schema)
    with _listing(spark):
        df = reader.parquet(*folders)
    if keys is None and (gone := _gone(state)):
        df = df.where(~touched_filter(gone, [VERSION, *state["columns"]]))
    return df.select(*schema.fieldNames())


def _gone(state: dict) -> list[str]:
    """Partitions (version and key) whose folders stand but are out of use: those
    the last commit replaced."""
    return [f"{version}{SEPARATOR}{key}" for version, key in state.get("replaced", [])]


def stage(path: str) -> tuple[str, str]:
    """A new version and its folder, to write touched partitions to."""
    version = uuid.uuid4().hex[:16]
    return version, f"{path}/{VERSION}={version}"


def create_partitioned(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """An empty partitioned table, where there is none yet."""
    if load(spark, path) is None:
        switch_partitions(spark, path, "", [], columns, None)


def feed_folder(path: str, feed: str) -> str:
    return f"{path}/{FEED}={feed}"


def switch_partitions(
    spark: SparkSession,
    path: str,
    version: str,
    keys: Sequence[str],
    columns: Sequence[str],
    before: dict | None,
    added: Sequence[str] = (),
    feed: str | None = None,
    keep_feed: bool = False,
    ranges: dict[str, tuple[str, str] | None] | None = None,
) -> None:
    """Make ``version`` the live one of the partitions ``keys``, and one more of
    the partitions ``added``; ``before`` is the state that was read first. The
    change feed ``feed`` stays with the table, or until the next commit. ``ranges``
    are the dates that the written partitions gain (``touched_ranges``)."""
    if before and before["partitions"] and before["columns"] != list(columns):  # an empty table takes any layout
        raise ValueError(f"{path} is partitioned by {before['columns']}, not by {list(columns)}")
    old = before["partitions"] if before else {}
    partitions = {**old, **{key: [version] for key in keys}, **{key: [*old.get(key, []), version] for key in added}}
    live = _live({"partitions": partitions})
    replaced = [(v, key) for key in keys for v in old.get(key, []) if v in live]
    kept = [*(before.get("feeds", []) if before else []), *([feed] if keep_feed else [])]
    passing = [feed] if feed and not keep_feed else []
    unfed = (before["unfed"] if before else 0) + (not keep_feed)
    spans = dict(before["ranges"]) if before else {}
    for key in [*keys, *added]:
        both = [(ranges or {}).get(key), *([spans.get(key)] if key in old else [])]
        spans[key] = None if None in both else [min(r[0] for r in both), max(r[1] for r in both)]
    state = {"columns": list(columns), "partitions": partitions, "ranges": spans, "replaced": replaced, "feeds": kept, "unfed": unfed, "passing": passing}
    _switch(spark, path, state, before)


def feeds(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """The change feeds a table carries, oldest first, and how many commits have
    left none: while that number stands, the feeds are all that has changed."""
    state = load(spark, path) or {}
    return state.get("feeds", []), state.get("unfed", 0)


def drop_feeds(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    """Give up change feeds that all their readers have applied."""
    before = load(spark, path)
    kept = [f for f in before.get("feeds", []) if f not in set(names)]
    if kept != before.get("feeds", []):
        _switch(spark, path, {**before, "feeds": kept, "replaced": []}, before)
