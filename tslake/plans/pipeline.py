"""End-to-end plans: landing -> Silver -> Gold -> warehouse -> marts.

Each step is one set-oriented Spark plan over all series and all pending
batches (the reference runs one job per series). Steps communicate through
tables under ``root`` only, so each can run in its own application and any
step can be re-run: landing and Silver upserts are idempotent, Gold and marts
are recomputed in full (they are O(months x series)).
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tslake.operators import cells
from tslake.operators import gate as gate_ops
from tslake.operators.dedupe import latest_by_sequence
from tslake.operators.features import month_axis
from tslake.operators.history import as_of
from tslake.operators.gold import to_wide
from tslake.operators.normalize import clean_rows, parse_raw, quarantine_rows
from tslake.operators.publish import ParquetTarget, materialize, publish
from tslake.operators.small import small_side
from tslake.operators.state import after_watermark, classify
from tslake.plans.marts import MARTS, build_marts, update_mart
from tslake.session import checkpoint_root, work_dir
from tslake.sources import bronze, versioned
from tslake.sources.catalog import SERIES_NAMES, catalog_frame
from tslake.sources.schemas import GOLD_LONG, SILVER, SILVER_KEYS, SILVER_PARTITIONS
from tslake.sources.silver import (
    HISTORY_PARTITIONS,
    history_path,
    read_feeds,
    read_history,
    read_silver,
    silver_exists,
    silver_path,
    update_history,
    upsert_silver,
)

# ---- ingestion ------------------------------------------------------------
def ingest(
    spark: SparkSession,
    root: str,
    fetched: DataFrame,
    batch_id: str,
    ingestion_date: str,
    catalog: DataFrame | None = None,
    inclusive: bool = False,
    lookback_days: int = 0,
    raise_on_failure: bool = False,
) -> DataFrame:
    """Land the rows of ``fetched`` (series_name, data text, valor text) that are
    past each series' watermark, then commit the batch manifest.

    Returns the manifest that was written. A batch (day and id) that is
    already committed is left alone (D8): nothing lands, a warning says so and
    the manifest is empty. Series are isolated from each other (O-18c): a
    failed series fails the batch, but the manifest is written for all of
    them; with ``raise_on_failure`` an error naming every failed series is
    raised after that. The fetched rows are read once: they land first, their
    classification reads the landed batch, and the manifest, which makes the
    batch count, is written last.
    """
    catalog = catalog if catalog is not None else catalog_frame(spark)
    day = F.to_date(F.lit(ingestion_date))
    manifests = _read_manifests_or_none(spark, root)
    if manifests is not None:
        committed = manifests.where((F.col("status") == "committed") & (F.col("ingestion_date") == day) & (F.col("batch_id") == batch_id))
        if not committed.isEmpty():
            warnings.warn(f"batch {batch_id} of {ingestion_date} is already committed; nothing was landed", stacklevel=2)
            return manifests.limit(0)
    history = small_side(committed_silver_watermarks(spark, root))
    # only catalogue series are ingested (their manifest entries vouch for them)
    parsed = parse_raw(fetched.join(small_side(catalog.select("series_name")), "series_name", "left_semi"))
    dated = after_watermark(parsed.where(F.col("data").isNotNull()), history, inclusive=inclusive, lookback_days=lookback_days)
    rows = dated.unionByName(parsed.where(F.col("data").isNull()))
    raw = (
        rows.select(F.col("data_text").alias("data"), F.col("valor_text").alias("valor"), "series_name")
        .withColumn("ingestion_date", day)
        .withColumn("batch_id", F.lit(batch_id))
    )
    # rows of an attempt of this batch that was not committed must not stay
    versioned.delete(spark, bronze.batch_folder(root, ingestion_date, batch_id))
    bronze.land(raw, root)
    landed = bronze.read_landed(spark, root, batches=[(ingestion_date, batch_id)])
    status = classify(catalog, clean_rows(parse_raw(landed)), history, day)
    entries = status.select(F.lit(batch_id).alias("batch_id"), day.alias("ingestion_date"), "series_name", "series_status")
    manifest = gate_ops.with_checks(gate_ops.rollup_batches(entries).drop("n_series", "n_failed"), landed)
    checkpoint_root(spark)
    manifest = manifest.checkpoint(eager=True)  # one row
    bronze.write_manifests(manifest, root)
    if raise_on_failure:
        # the manifest is one row whose map lists the catalogue's series
        failed = sorted(
            r.key for r in manifest.select(F.explode("series")).where(F.col("value") == "failed").collect()
        )
        if failed:
            raise RuntimeError(f"batch {batch_id} failed for series: {', '.join(failed)}")
    return manifest


def _read_manifests_or_none(spark: SparkSession, root: str):
    from tslake.sources.schemas import MANIFEST

    if not _exists_json(spark, bronze.manifests_path(root), MANIFEST):
        return None
    return bronze.read_manifests(spark, root)


def _exists_json(spark: SparkSession, path: str, schema) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.schema(schema).json(path).schema  # noqa: B018
        return True
    except AnalysisException as exc:
        if (exc.getCondition() or "") == "PATH_NOT_FOUND":
            return False
        raise


WATERMARK_SCHEMA = "series_name string, last_reference_date date"


def watermarks_path(root: str) -> str:
    return f"{root.rstrip('/')}/_control/watermarks"


def update_watermarks(spark: SparkSession, root: str, applied_rows: DataFrame) -> None:
    """Fold the applied rows' last dates into the watermark table (one row per
    series), so that ingestion never scans Silver. The table is derived
    state: it can be rebuilt from Silver at any time, and a stale one only
    re-lands rows that the idempotent upsert absorbs."""
    path = watermarks_path(root)
    new = applied_rows.groupBy("series_name").agg(F.max("data").alias("last_reference_date"))
    old = versioned.read(spark, path, WATERMARK_SCHEMA)
    if old is not None:
        new = old.unionByName(new).groupBy("series_name").agg(F.max("last_reference_date").alias("last_reference_date"))
    versioned.replace(new.coalesce(1), path)


def committed_silver_watermarks(spark: SparkSession, root: str) -> DataFrame:
    """Watermarks of everything committed: Silver plus the committed batches
    that Silver has not applied yet (D7: state must not run ahead of, or fall
    behind, the committed data). Silver's part comes from the watermark table
    kept by ``bronze_to_silver`` (rebuilt from Silver only when missing); only
    the pending batches' folders are read."""
    parts = []
    wm = versioned.read(spark, watermarks_path(root), WATERMARK_SCHEMA)
    if wm is not None:
        parts.append(wm.select("series_name", F.col("last_reference_date").alias("data")))
    elif silver_exists(spark, root):
        parts.append(read_silver(spark, silver_path(root)).select("series_name", "data"))
    pending, entries = _pending(spark, root)
    if pending is not None:
        rows = pending.select("ingestion_date", "batch_id").collect()
        if rows:
            landed = bronze.read_landed(spark, root, batches=[(r.ingestion_date, r.batch_id) for r in rows])
            typed = clean_rows(parse_raw(gate_ops.gate(landed, entries)))
            parts.append(typed.select("series_name", "data"))
    if not parts:
        return spark.createDataFrame([], WATERMARK_SCHEMA)
    obs = parts[0]
    for p in parts[1:]:
        obs = obs.unionByName(p)
    return obs.groupBy("series_name").agg(F.max("data").alias("last_reference_date"))


APPLIED_SCHEMA = "ingestion_date date, batch_id string"


def read_applied(spark: SparkSession, root: str) -> DataFrame:
    """The batches applied to Silver so far."""
    applied = versioned.read(spark, bronze.applied_path(root), APPLIED_SCHEMA)
    return spark.createDataFrame([], APPLIED_SCHEMA) if applied is None else applied


def record_applied(batches: DataFrame, root: str) -> None:
    """Add batches (ingestion_date, batch_id) to the applied list, which is
    replaced as a whole (one row per batch)."""
    spark = batches.sparkSession
    both = read_applied(spark, root).unionByName(batches.select("ingestion_date", "batch_id")).distinct()
    versioned.replace(both.coalesce(1), bronze.applied_path(root))


def _pending(spark: SparkSession, root: str):
    """(pending committed batches, their manifest entries) or (None, None)."""
    manifests = _read_manifests_or_none(spark, root)
    if manifests is None:
        return None, None
    manifests = bronze.latest_manifests(manifests)
    pending = gate_ops.pending_batches(manifests, read_applied(spark, root))
    entries = gate_ops.manifest_entries(manifests.join(pending, gate_ops.BATCH, "left_semi"))
    return pending, entries


# ---- Bronze -> Silver -----------------------------------------------------
#: Manifest files after which a run puts them into the snapshot.
MANIFEST_TAIL = 64


def quarantine_path(root: str) -> str:
    return f"{root.rstrip('/')}/quarantine"


def apply_batches(
    spark: SparkSession, root: str, manifests: DataFrame, metrics: dict | None = None, partitions=SILVER_PARTITIONS, history: bool = False
) -> DataFrame:
    """Apply the committed, not yet applied batches among ``manifests`` to
    Silver; returns them. Used by the batch run and by the stream.

    The landed rows are read and parsed once, into a working table that is
    removed at the end. Rows with a bad date go to ``<root>/quarantine``, by
    batch, whatever their series' status; a repeated run replaces them. The
    other rows go to Silver if their manifest vouches for their series, and with
    ``history`` to the history of all states as well (``snapshots``). When
    ``metrics`` is given it receives the row counts gathered by that job, and
    the committed series without a landed object. Where no batch has been
    committed yet, the tables are there, and empty.
    """
    manifests = bronze.latest_manifests(manifests)
    pending = gate_ops.pending_batches(manifests, read_applied(spark, root))
    rows = pending.collect()  # the batches of this run only
    applied_now = spark.createDataFrame([(r.ingestion_date, r.batch_id) for r in rows], APPLIED_SCHEMA)
    if not rows:
        versioned.create_partitioned(spark, silver_path(root), partitions)
        if history:
            versioned.create_partitioned(spark, history_path(root), HISTORY_PARTITIONS)
        return applied_now
    entries = small_side(gate_ops.manifest_entries(manifests.join(F.broadcast(applied_now), gate_ops.BATCH, "left_semi")))
    landed = bronze.read_landed(spark, root, batches=[(r.ingestion_date, r.batch_id) for r in rows])
    vouched = small_side(gate_ops.committed_changes(entries).select(*gate_ops.BATCH_KEYS).distinct()).withColumn("vouched", F.lit(True))
    observation = Observation("apply_batches")
    bad = F.col("data").isNull()
    parsed = (
        parse_raw(landed.join(vouched, gate_ops.BATCH_KEYS, "left"))
        .withColumn("vouched", F.coalesce("vouched", F.lit(False)))
        .observe(
            observation,
            F.count(F.lit(1)).alias("rows_landed"),
            F.count_if(bad).alias("rows_quarantined"),
            F.count_if(~bad & F.col("valor").isNull()).alias("rows_null_valor"),
        )
    )
    work = work_dir(spark, "apply")
    parsed.write.parquet(work)
    parsed = spark.read.schema(parsed.schema).parquet(work)
    counts = observation.get
    missing = gate_ops.reconcile(entries, parsed.select(*gate_ops.BATCH_KEYS)).where("issue = 'missing_object'").collect()
    for r in missing:
        warnings.warn(f"batch {r.batch_id} of {r.ingestion_date}: {r.series_name} is committed but has no landed object", stacklevel=2)
    if metrics is not None:
        metrics.update(counts)
        if missing:
            metrics["missing_objects"] = sorted((str(r.ingestion_date), r.batch_id, r.series_name) for r in missing)
    if counts.get("rows_quarantined"):  # no job when the batches are clean
        (
            quarantine_rows(parsed).drop("vouched").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*gate_ops.BATCH)
            .parquet(quarantine_path(root))
        )
    clean = clean_rows(parsed.where("vouched").drop("vouched"), with_ingestion_ts=True)
    # the batches of this run in order: their number decides which row of a key is the newest
    numbered = spark.createDataFrame([(i, *b) for i, b in enumerate(sorted((r.ingestion_date, r.batch_id) for r in rows))], f"_n int, {APPLIED_SCHEMA}")
    newest = latest_by_sequence(clean.join(F.broadcast(numbered), gate_ops.BATCH), SILVER_KEYS, "_n", "valor").join(F.broadcast(numbered), "_n")
    source = newest.withColumns({"ingestion_timestamp": F.current_timestamp(), "year": F.year("data"), "month": F.month("data")}).select(*SILVER.fieldNames())
    touched = versioned.touched_ranges(clean, partitions, "data")
    upsert_silver(spark, source, silver_path(root), partitions=partitions, touched=touched)
    if history:
        update_history(spark, clean, history_path(root), list(touched) if list(partitions) == HISTORY_PARTITIONS else None)
    update_watermarks(spark, root, clean.select("series_name", "data"))
    record_applied(applied_now, root)
    versioned.delete(spark, work)
    return applied_now


def bronze_to_silver(
    spark: SparkSession, root: str, metrics: dict | None = None, partitions=SILVER_PARTITIONS, history: bool = False
) -> DataFrame:
    """Apply every committed, not yet applied batch to Silver in one plan."""
    manifests = _read_manifests_or_none(spark, root)
    if manifests is None:
        return spark.createDataFrame([], APPLIED_SCHEMA)
    applied = apply_batches(spark, root, manifests, metrics, partitions, history)
    if bronze.manifest_tail(spark, root) >= MANIFEST_TAIL:
        bronze.snapshot_manifests(spark, root)
    return applied


# ---- Silver -> Gold -> warehouse -> marts ----------------------------------
def cells_path(root: str) -> str:
    return f"{root.rstrip('/')}/_control/gold_cells"


def _gold_paths(root: str) -> tuple[str, str]:
    base = root.rstrip("/")
    return f"{base}/gold_long", f"{base}/gold"


def _updated_cells(spark: SparkSession, root: str, feed: DataFrame, commit: int) -> DataFrame:
    """The cells after the changes of ``feed``. Silver is read only for cells
    that their state and the changes do not determine."""
    current = versioned.read(spark, cells_path(root), cells.STATE)
    checkpoint_root(spark)
    after = cells.apply(current, cells.changes(feed), commit).checkpoint(eager=True)
    known = after.where("not stale").drop("stale")
    stale = after.where("stale").select(*cells.CELL)
    if stale.isEmpty():
        return known
    stale = small_side(stale)
    years = versioned.touched_keys(stale.withColumn("year", F.year("reference_month")), ["series_name", "year"])
    scope = read_silver(spark, silver_path(root)).where(versioned.touched_filter(years, ["series_name", "year"]))
    return known.unionByName(cells.build(scope, commit).join(stale, cells.CELL, "left_semi"))


def silver_to_gold(spark: SparkSession, root: str, incremental: bool = True) -> tuple[DataFrame, DataFrame]:
    """Bring Gold (long and wide) up to date with Silver; returns both re-read.

    The first run (or ``incremental=False``) computes the state of every
    (series, month) cell from all of Silver (``operators.cells``). Later runs
    apply Silver's change feeds to it, so that a run costs the changes and the
    cells, not Silver; the feeds applied are committed with the cells, and each
    is applied once whatever is interrupted.
    """
    long_path, wide_path = _gold_paths(root)
    place, silver = cells_path(root), silver_path(root)
    feeds, unfed = versioned.feeds(spark, silver)
    done = versioned.note(spark, place)
    commit = done["commit"] + 1 if done else 0
    if not incremental or done is None or done.get("unfed") != unfed:
        new = cells.build(read_silver(spark, silver), commit)
    elif todo := [f for f in feeds if f not in done["feeds"]]:
        new = _updated_cells(spark, root, read_feeds(spark, silver, todo), commit)
    else:
        new, commit = None, done["commit"]
    if new is not None:
        versioned.replace(new, place, {"feeds": feeds, "unfed": unfed})
    versioned.drop_feeds(spark, silver, feeds)
    out = []
    for path, make in ((long_path, lambda: cells.values(versioned.read(spark, place, cells.STATE), catalog_frame(spark))), (wide_path, lambda: to_wide(out[0], SERIES_NAMES))):
        note = versioned.note(spark, path)
        current = note is not None and note.get("cells") == commit
        out.append(versioned.read(spark, path) if current else materialize(make(), path, {"cells": commit}))
    return out[0], out[1]


def read_gold(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Gold, long and wide, as last built."""
    long_path, wide_path = _gold_paths(root)
    long, wide = versioned.read(spark, long_path, GOLD_LONG), versioned.read(spark, wide_path)
    if long is None or wide is None:
        raise FileNotFoundError(f"no Gold table under {root}")
    return long, wide


def gold_to_warehouse(spark: SparkSession, root: str, target=None, mode: str = "append_new") -> None:
    target = target or ParquetTarget(f"{root.rstrip('/')}/warehouse/macro_monthly")
    _, wide = read_gold(spark, root)
    publish(spark, wide, target, mode=mode)


def marts(spark: SparkSession, root: str, database: str | None = None, incremental: bool = True, metrics: dict | None = None) -> dict[str, DataFrame]:
    """Materialise the five marts from Gold long form: as Parquet folders
    under ``<root>/marts``, or as catalog tables ``<database>.<mart>``.

    Folders built before are brought up to date: only the rows that read a
    cell changed since then are computed (``marts.update_mart``). ``metrics``
    receives how many rows of each mart were computed.
    """
    from tslake.operators.publish import materialize_table

    long, _ = read_gold(spark, root)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        return {name: materialize_table(df, f"`{database}`.`{name}`") for name, df in build_marts(long, small_side(month_axis(long))).items()}
    # the commit of the cells that Gold was made of
    commit = (versioned.note(spark, _gold_paths(root)[0]) or {}).get("cells")
    axis, state, fresh, out = None, None, None, {}
    for name in MARTS:
        path = f"{root.rstrip('/')}/marts/{name}"
        seen = (versioned.note(spark, path) or {}).get("cells")
        mart = versioned.read(spark, path) if incremental and seen is not None and commit is not None else None
        if mart is not None and seen == commit:
            out[name], count = mart, 0
        else:
            axis = small_side(month_axis(long)) if axis is None else axis
            if mart is None:
                fresh = build_marts(long, axis) if fresh is None else fresh
                out[name] = materialize(fresh[name], path, {"cells": commit})
                count = None
            else:
                state = versioned.read(spark, cells_path(root), cells.STATE) if state is None else state
                changed = state.where((F.col("commit") > seen) & (F.col("commit") <= commit)).select(*cells.CELL)
                whole, anew = update_mart(mart, long, name, changed, axis)
                out[name], count = materialize(whole, path, {"cells": commit}), anew
        if metrics is not None:
            metrics[name] = out[name].count() if count is None else count if isinstance(count, int) else count.count()
    return out


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Register Gold as the staging view ``stg_macro_monthly`` and every mart
    as a temp view of its own name (O-26, O-28d), so existing SQL models run
    unchanged with ``spark.sql``."""
    long, wide = read_gold(spark, root)
    wide.createOrReplaceTempView("stg_macro_monthly")
    names = ["stg_macro_monthly"]
    for name, df in build_marts(long, small_side(month_axis(long))).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def adopt_reference_landing(spark: SparkSession, source_root: str, root: str) -> None:
    """Take over data landed in the source system's layout
    (``<series>/ingestion_date=<d>/batch_id=<b>/response.json`` plus
    ``_control/batches/**.json`` manifests) into this layout, in one job each.
    Objects of batches without a committed manifest come along but stay
    invisible behind the gate, as they were."""
    base = source_root.rstrip("/")
    landed = bronze.read_reference_layout(spark, base)
    bronze.land(landed, root)
    manifests = bronze.read_reference_manifests(spark, f"{base}/_control/batches")
    bronze.write_manifests(manifests, root)


def snapshot(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """The full view of every series as of a date (O-17, D2): all committed
    batches landed up to ``as_of``, typed, latest batch wins per (series,
    date). The day is a partition filter of the landing zone, and the
    manifests' entries are joined by the engine, not collected."""
    from tslake.operators.state import snapshot_as_of

    day = F.to_date(F.lit(as_of))
    manifests = bronze.latest_manifests(bronze.read_manifests(spark, root)).where(F.col("ingestion_date") <= day)
    landed = bronze.read_landed(spark, root).where(F.col("ingestion_date") <= day)
    typed = clean_rows(parse_raw(gate_ops.gate(landed, gate_ops.manifest_entries(manifests))))
    return snapshot_as_of(typed, day).select("series_name", "data", "valor", "ingestion_date", "batch_id")


def snapshots(spark: SparkSession, root: str, days: list[str]) -> DataFrame:
    """The full view of every series on each of some days (``as_of``), from the
    history that ``bronze_to_silver(history=True)`` keeps: a range filter over
    one table per day, no landed row is read."""
    history = read_history(spark, history_path(root))
    if history is None:
        raise FileNotFoundError(f"no history under {root}: run bronze_to_silver(history=True)")
    columns = ["series_name", "data", "valor", "batch_id"]
    wanted = F.explode(F.array(*[F.to_date(F.lit(d)) for d in days])).alias("as_of")
    return as_of(history.select("*", wanted), F.col("as_of")).select("as_of", *columns)


def quality_report(spark: SparkSession, root: str, catalog: DataFrame | None = None) -> DataFrame:
    """Data-quality checks of a lake root as one frame of
    ``(table, check_name, column_name, violations)`` (O-29..O-32): Gold's key
    (the warehouse primary key) not NULL and unique, its declared columns,
    Silver's key not NULL and unique, and the catalogue's frequencies."""
    from tslake.operators import quality
    from tslake.sources.catalog import FREQUENCIES

    catalog = catalog if catalog is not None else catalog_frame(spark)
    _, gold = read_gold(spark, root)
    silver = read_silver(spark, silver_path(root))
    declared = quality.check_columns(spark, gold, ["reference_month", *SERIES_NAMES])
    columns = declared.where(F.col("status") != "ok").groupBy().agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("declared_columns").alias("check_name"), F.lit("*").alias("column_name"), "violations"
    )
    manifests = bronze.latest_manifests(bronze.read_manifests(spark, root))
    landed = bronze.read_landed(spark, root)
    missing = gate_ops.reconcile(gate_ops.manifest_entries(manifests), landed.select(*gate_ops.BATCH_KEYS)).where("issue = 'missing_object'")
    counted = lambda df, name, column: df.groupBy().agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), "violations"
    )
    parts = [
        ("bronze", counted(missing, "missing_object", "series_name")),
        ("bronze", counted(gate_ops.altered_objects(manifests, landed), "altered_object", "valor")),
        ("gold", quality.check_not_null(gold, ["reference_month"])),
        ("gold", quality.check_unique(gold, ["reference_month"])),
        ("gold", columns),
        ("silver", quality.check_not_null(silver, ["series_name", "data"])),
        ("silver", quality.check_unique(silver, ["series_name", "data"])),
        ("catalog", quality.check_accepted_values(catalog, {"frequency": list(FREQUENCIES)})),
    ]
    out = None
    for table, df in parts:
        df = df.select(F.lit(table).alias("table"), "check_name", "column_name", "violations")
        out = df if out is None else out.unionByName(df)
    return out
