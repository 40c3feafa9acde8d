"""Registered queries over the supplied tables: one per operator of the
inventory. Each callable takes ``(spark, sf_dir)`` and returns a DataFrame
whose column names equal those of the matching oracle SQL (``oracle.py``).

Outputs round DOUBLE columns to 6 places so that engines that sum in a
different order still agree; dates are DATE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslake.functions import growth
from tslake.functions.dates import sanitize_batch_id
from tslake.operators import gate as gate_ops
from tslake.operators import quality
from tslake.operators.dedupe import latest_by_sequence, latest_per_key
from tslake.operators.features import Feature, calendar_lag, wide_features
from tslake.operators.gold import monthly, to_wide
from tslake.operators.normalize import clean_rows, error_report, parse_raw, quarantine_rows
from tslake.operators.publish import ParquetTarget, high_water, materialize, publish
from tslake.operators.state import (
    after_watermark,
    carry_forward,
    classify,
    fetch_start,
    holes,
    classify_monthly_batches,
    request_windows,
    snapshot_as_of,
    watermarks,
)
from tslake.operators.upsert import merge_frames, upsert_table
from tslake.plans.marts import build_mart
from tslake.session import checkpoint_root, work_dir
from tslake.sources import bronze, tables, versioned
from tslake.sources.catalog import SERIES_NAMES, catalog_frame, frequency_frame
from tslake.sources.tables import PRIORITY_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

# FIXED VALUES used by the queries (dates that split history from new data).
HISTORY_END = "2000-01-01"  # watermark history: reference dates before this day
LOOKBACK_DAYS = 7
UPSERT_TARGET_END = "2000-01-01"  # upsert target: dates before this day
UPSERT_SOURCE_START = "1999-07-01"  # upsert source: dates from this day, value x 1.1
APPLIED_UNTIL = "2024-01-10"  # events batches already applied to Silver
SNAPSHOT_AS_OF = "2024-01-20"
PUBLISHED_UNTIL = "2000-01-01"  # warehouse target holds Gold months before this
STALE_MONTH = "1999-12-01"  # ... with this month's selic loaded as 0
CALENDAR_GAP_MONTH = "1998-06-01"  # month removed before the calendar lag
DAILY_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
LAG_OFFSETS = [1, 3, 6, 12]


# Means of cents over a power of two lie exactly on a tie at six places, and the
# last bit of a sum, which depends on its order, would decide them. A nudge far
# above that bit and far below the sixth place decides them in any engine.
TIE_NUDGE = 1e-8


def round6(c):
    """Round to 6 places as ``round(x * 1e6) / 1e6`` on the binary value, the
    same arithmetic SQL engines use for DOUBLE, ties upwards."""
    return F.round((c + F.lit(TIE_NUDGE)) * F.lit(1e6), 0) / F.lit(1e6)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            round6(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def materialized(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder. Used for Gold in
    long form (months x series rows): the marts read it twice (month axis
    and values), and without it both reads would rescan the source tables."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _date(s: str):
    return F.lit(s).cast("date")


# ---- normalise, quarantine, errors ----------------------------------------
def q_normalize_observations(spark, sf):
    clean = clean_rows(parse_raw(tables.raw_orders(spark, sf)))
    return rounded(clean.select("series_name", "data", "valor", "year", "month", "o_orderkey"))


def q_quarantine_rows(spark, sf):
    q = quarantine_rows(parse_raw(tables.raw_orders(spark, sf)))
    return rounded(
        q.select(
            "series_name", "data_text", F.col("valor_text").try_cast("double").alias("valor"), "o_orderkey", "reason"
        )
    )


def q_error_report(spark, sf):
    return error_report(parse_raw(tables.raw_orders(spark, sf)))


# ---- dedupe ------------------------------------------------------------------
def q_dedupe_latest(spark, sf):
    o = tables.obs_orders(spark, sf)
    return rounded(latest_per_key(o, ["series_name", "data"], ["o_orderkey"]))


def q_dedupe_by_sequence(spark, sf):
    o = tables.obs_orders(spark, sf)
    return rounded(latest_by_sequence(o, ["series_name", "data"], "o_orderkey", "valor"))


def q_dedupe_max_by(spark, sf):
    li = tables.obs_lineitem(spark, sf)
    out = latest_per_key(li, ["series_name", "data"], ["l_orderkey", "l_linenumber", "valor"])
    return rounded(out.select("series_name", "data", "valor", "l_orderkey", "l_linenumber"))


# ---- watermarks and classification ----------------------------------------
def _event_committed(spark, sf):
    ev = tables.event_observations(spark, sf)
    return gate_ops.gate(ev, tables.event_entries(spark, sf))


def q_watermark_per_series(spark, sf):
    wm = watermarks(_event_committed(spark, sf).select("series_name", "data", "batch_id", "ingestion_date"))
    return wm.select("series_name", "last_reference_date", "rows_ingested", "last_ingestion_date", "last_batch_id")


def _after(spark, sf, **kw):
    o = tables.obs_orders(spark, sf)
    wm = watermarks(o.where(F.col("data") < _date(HISTORY_END)).select("series_name", "data"))
    return rounded(after_watermark(o, wm, **kw).select("series_name", "data", "valor", "o_orderkey"))


def q_after_watermark(spark, sf):
    return _after(spark, sf)


def q_after_watermark_inclusive(spark, sf):
    return _after(spark, sf, inclusive=True)


def q_after_watermark_lookback(spark, sf):
    return _after(spark, sf, lookback_days=LOOKBACK_DAYS)


# fetch_start: two series have no history, one has all of its rows
NO_HISTORY = ["3-MEDIUM", "5-LOW"]
ALL_HISTORY = ["4-NOT SPECIFIED"]
NOT_LANDED = ["2-HIGH", "3-MEDIUM"]  # classify_run: series that land nothing
RUN_START = "2001-01-01"  # classify_run: rows from this day are the run's landing
RUN_DAY = "2001-01-31"  # ... and this is the run's "today"
NEVER_FETCHED = "5-LOW"  # refetch_windows: the series without a fetched window
LOST_SERIES = "click"  # manifest_reconcile: the series whose objects are lost


def _orders_catalog(spark, sf):
    """The priorities as a catalogue: daily, available from their first row."""
    o = tables.obs_orders(spark, sf)
    return o.groupBy("series_name").agg(F.min("data").alias("available_from")).withColumn(
        "frequency", F.lit("daily")
    )


def _run_history(spark, sf):
    """Watermarks of the rows before the run, of all rows, or none, by series."""
    o = tables.obs_orders(spark, sf)
    known = ~F.col("series_name").isin(NO_HISTORY) & ((F.col("data") < _date(RUN_START)) | F.col("series_name").isin(ALL_HISTORY))
    return watermarks(o.where(known).select("series_name", "data"))


def q_fetch_start(spark, sf):
    return fetch_start(_orders_catalog(spark, sf), _run_history(spark, sf))


def q_classify_run(spark, sf):
    history = _run_history(spark, sf)
    landed = tables.obs_orders(spark, sf).where((F.col("data") >= _date(RUN_START)) & ~F.col("series_name").isin(NOT_LANDED))
    new = after_watermark(landed, history)
    return classify(_orders_catalog(spark, sf), new, history, _date(RUN_DAY))


def q_accept_new_manifests(spark, sf):
    manifests = tables.event_manifests(spark, sf)
    existing = manifests.where(F.col("ingestion_date") <= _date(APPLIED_UNTIL))
    accepted = gate_ops.accept_new_manifests(manifests, existing)
    return accepted.select("batch_id", "ingestion_date", "status")


def q_classify_series(spark, sf):
    return classify_monthly_batches(tables.obs_orders(spark, sf)).select(
        "series_name", "batch_month", "n_new", "series_status"
    )


# ---- batches, gate, carry-forward, snapshot --------------------------------
def q_batch_status_rollup(spark, sf):
    return tables.event_manifests(spark, sf).select("batch_id", "ingestion_date", "status", "n_series", "n_failed")


def q_committed_gate(spark, sf):
    return rounded(_event_committed(spark, sf).select("event_id", "series_name", "data", "valor", "batch_id"))


def q_pending_batches(spark, sf):
    manifests = tables.event_manifests(spark, sf)
    applied = manifests.where((F.col("status") == "committed") & (F.col("ingestion_date") <= _date(APPLIED_UNTIL)))
    return gate_ops.pending_batches(manifests, applied)


def q_pending_batches_log(spark, sf):
    """Pending batches from the manifests of a lake root: a snapshot of those up to
    the last applied day, the files written since, and one batch more whose
    first attempt failed and is in the snapshot."""
    root = work_dir(spark, "manifests")
    manifests = materialized(tables.event_manifests(spark, sf).drop("n_series", "n_failed"))
    early = F.col("ingestion_date") <= _date(APPLIED_UNTIL)
    bronze.write_manifests(manifests.where(early), root)
    retried = manifests.where(early & (F.col("status") == "failed"))
    bronze.snapshot_manifests(spark, root)
    bronze.write_manifests(manifests.where(~early), root)
    bronze.write_manifests(retried.withColumn("status", F.lit("committed")), root)
    applied = manifests.where(early & (F.col("status") == "committed"))
    return gate_ops.pending_batches(bronze.latest_manifests(bronze.read_manifests(spark, root)), applied)


def q_carry_forward_batch(spark, sf):
    return carry_forward(tables.event_entries(spark, sf)).select(
        "batch_id", "ingestion_date", "series_name", "source_batch_id"
    )


def q_snapshot_as_of(spark, sf):
    committed = _event_committed(spark, sf)
    snap = snapshot_as_of(committed, _date(SNAPSHOT_AS_OF), order_extra=["ts", "event_id"])
    return rounded(snap.select("series_name", "data", "valor", "batch_id"))


def q_manifest_reconcile(spark, sf):
    # objects of one series are lost on every seventh day
    ev = tables.event_observations(spark, sf)
    lost = (F.col("series_name") == LOST_SERIES) & (F.dayofmonth("data") % 7 == 0)
    return gate_ops.reconcile(tables.event_entries(spark, sf), ev.where(~lost).select(*gate_ops.BATCH_KEYS))


def q_batch_id_sanitize(spark, sf):
    e = tables.table(spark, sf, "events")
    raw = F.concat(F.lit("manual__"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return e.select("event_id", raw.alias("batch_id_raw"), sanitize_batch_id(raw).alias("batch_id"))


# ---- request windows -------------------------------------------------------
def _windows(spark, sf, frequency):
    spans = tables.obs_orders(spark, sf).groupBy("series_name").agg(
        F.min("data").alias("start_date"), F.max("data").alias("end_date")
    )
    return request_windows(spans.withColumn("frequency", F.lit(frequency)))


def q_request_windows_daily(spark, sf):
    return _windows(spark, sf, "daily")


def q_request_windows_monthly(spark, sf):
    return _windows(spark, sf, "monthly")


def q_refetch_windows(spark, sf):
    """Windows to request again: every third window of the daily history failed
    but for the month that the one before it covers too, and one series has
    never been fetched."""
    spans = tables.obs_orders(spark, sf).groupBy("series_name").agg(
        F.min("data").alias("start_date"), F.max("data").alias("end_date")
    ).withColumn("frequency", F.lit("daily"))
    windows = request_windows(spans)
    fetched = windows.where((F.col("window_index") % 3 != 1) & (F.col("series_name") != NEVER_FETCHED))
    # what came reaches a month into the next window
    fetched = fetched.withColumn("window_end", F.date_add("window_end", 30))
    return request_windows(holes(spans, fetched))


# ---- upsert ----------------------------------------------------------------
def _upsert_inputs(spark, sf):
    d = latest_per_key(tables.obs_orders(spark, sf), ["series_name", "data"], ["o_orderkey"])
    target = d.where(F.col("data") < _date(UPSERT_TARGET_END))
    source = d.where(F.col("data") >= _date(UPSERT_SOURCE_START)).withColumn("valor", F.col("valor") * F.lit(1.1))
    return target, source


def q_upsert_merge(spark, sf):
    target, source = _upsert_inputs(spark, sf)
    return rounded(merge_frames(target, source, ["series_name", "data"]))


UPSERT_SCHEMA = T.StructType(
    [
        T.StructField("data", T.DateType()),
        T.StructField("valor", T.DoubleType()),
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("series_name", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)


def q_upsert_idempotent(spark, sf):
    """Partitioned table: create from the target, upsert the source twice."""
    target, source = _upsert_inputs(spark, sf)
    path = work_dir(spark, "upsert")
    keys, parts = ["series_name", "data"], ["series_name", "year"]
    with_year = lambda df: df.withColumn("year", F.year("data"))
    upsert_table(spark, with_year(target), path, keys, parts, UPSERT_SCHEMA)
    upsert_table(spark, with_year(source), path, keys, parts, UPSERT_SCHEMA)
    upsert_table(spark, with_year(source), path, keys, parts, UPSERT_SCHEMA)
    out = versioned.read_partitioned(spark, path, UPSERT_SCHEMA)
    return rounded(out.select("series_name", "data", "valor", "o_orderkey"))


def q_upsert_out_of_order(spark, sf):
    """The newest rows first, then every key's older row: the late, older
    batch changes nothing."""
    obs = tables.obs_orders(spark, sf).withColumn("year", F.year("data"))
    keys, parts = ["series_name", "data"], ["series_name", "year"]
    newest = latest_per_key(obs, keys, ["o_orderkey"])
    oldest = latest_per_key(obs.withColumn("_age", -F.col("o_orderkey")), keys, ["_age"]).drop("_age")
    path = work_dir(spark, "upsert")
    for source in (newest, oldest):
        upsert_table(spark, source, path, keys, parts, UPSERT_SCHEMA, order=["o_orderkey"])
    out = versioned.read_partitioned(spark, path, UPSERT_SCHEMA)
    return rounded(out.select("series_name", "data", "valor", "o_orderkey"))


def q_upsert_change_feed(spark, sf):
    """What an upsert changes, row by row: inserted and corrected observations
    with their values before and after."""
    target, source = _upsert_inputs(spark, sf)
    path = work_dir(spark, "upsert")
    keys, parts = ["series_name", "data"], ["series_name", "year"]
    with_year = lambda df: df.withColumn("year", F.year("data"))
    upsert_table(spark, with_year(target), path, keys, parts, UPSERT_SCHEMA)
    feed = upsert_table(spark, with_year(source), path, keys, parts, UPSERT_SCHEMA, keep_feed=True)
    return rounded(feed.select(*keys, "op", F.col("old.valor").alias("old_valor"), F.col("new.valor").alias("new_valor")))


WEEK_SCHEMA = T.StructType([*UPSERT_SCHEMA.fields, T.StructField("week", T.IntegerType())])


def q_upsert_many_partitions(spark, sf):
    """An upsert that touches every week of every series: over a thousand
    partitions of one table."""
    obs = latest_per_key(tables.obs_orders(spark, sf), ["series_name", "data"], ["o_orderkey"])
    obs = obs.withColumn("year", F.year("data")).withColumn("week", F.weekofyear("data"))
    path = work_dir(spark, "upsert")
    keys, parts = ["series_name", "data"], ["series_name", "year", "week"]
    raised = obs.where(F.col("o_orderkey") % 2 == 1).withColumn("valor", F.col("valor") * F.lit(2.0))
    for source in (obs, raised):
        upsert_table(spark, source, path, keys, parts, WEEK_SCHEMA)
    out = versioned.read_partitioned(spark, path, WEEK_SCHEMA)
    return rounded(out.select("series_name", "data", "valor", "o_orderkey", "week"))


# ---- monthly aggregation and pivot ----------------------------------------
def _orders_monthly_avg(spark, sf):
    o = tables.obs_orders(spark, sf)
    freq = frequency_frame(spark, {p: "daily" for p in PRIORITY_COLUMNS})
    return monthly(o, freq)


def q_monthly_avg(spark, sf):
    return rounded(_orders_monthly_avg(spark, sf))


def q_monthly_first(spark, sf):
    li = tables.obs_lineitem(spark, sf)
    freq = frequency_frame(spark, {s: "monthly" for s in tables.LINEITEM_TO_CATALOG})
    return rounded(monthly(li, freq, tiebreak=["l_orderkey", "l_linenumber", "valor"]))


def q_monthly_mixed_frequency(spark, sf):
    o = tables.obs_orders(spark, sf)
    freq = frequency_frame(spark, {p: ("daily" if p in DAILY_PRIORITIES else "monthly") for p in PRIORITY_COLUMNS})
    return rounded(monthly(o, freq, tiebreak=["o_orderkey", "valor"]))


def _priority_long(spark, sf):
    long = _orders_monthly_avg(spark, sf)
    expr = None
    for src, dst in PRIORITY_COLUMNS.items():
        expr = F.when(F.col("series_name") == src, F.lit(dst)) if expr is None else expr.when(F.col("series_name") == src, F.lit(dst))
    return long.withColumn("series_name", expr)


PRIORITY_NAMES = list(PRIORITY_COLUMNS.values())


def q_gold_pivot(spark, sf):
    return rounded(to_wide(_priority_long(spark, sf), PRIORITY_NAMES))


def _features(spark, sf, feats):
    return rounded(wide_features(materialized(_priority_long(spark, sf)), feats))


def q_lag_features(spark, sf):
    feats = []
    for n in PRIORITY_NAMES:
        feats.append(Feature(n, "value", (n,)))
        feats += [Feature(f"{n}_lag_{k}", "lag", (n,), k) for k in LAG_OFFSETS]
    return _features(spark, sf, feats)


def q_change(spark, sf):
    return _features(spark, sf, [Feature(f"{n}_change", "change", (n,), 1) for n in PRIORITY_NAMES])


def q_pct_change_mom(spark, sf):
    return _features(spark, sf, [Feature(f"{n}_mom", "pct_change", (n,), 1) for n in PRIORITY_NAMES])


def q_pct_change_yoy(spark, sf):
    return _features(spark, sf, [Feature(f"{n}_yoy", "pct_change", (n,), 12) for n in PRIORITY_NAMES])


def q_spread_midpoint(spark, sf):
    return _features(
        spark,
        sf,
        [
            Feature("urgent", "value", ("urgent",)),
            Feature("low", "value", ("low",)),
            Feature("urgent_low_spread", "spread", ("urgent", "low")),
            Feature("urgent_low_midpoint", "midpoint", ("urgent", "low")),
        ],
    )


def q_pct_change_calendar(spark, sf):
    long = materialized(_priority_long(spark, sf).where(F.col("reference_month") != _date(CALENDAR_GAP_MONTH)))
    out = calendar_lag(long, 12).withColumn("yoy_calendar", growth.pct_change(F.col("valor"), F.col("lag_12")))
    return rounded(out.select("series_name", "reference_month", "valor", "lag_12", "yoy_calendar"))


# ---- the macro pipeline: Silver -> Gold -> marts ---------------------------
def macro_silver(spark, sf):
    obs = tables.macro_observations(spark, sf)
    return latest_per_key(obs, ["series_name", "data"], ["k1", "k2", "valor"]).select("series_name", "data", "valor")


def macro_gold_long(spark, sf):
    return monthly(macro_silver(spark, sf), catalog_frame(spark))


def q_gold_macro(spark, sf):
    return rounded(to_wide(macro_gold_long(spark, sf), SERIES_NAMES))


def _mart(name):
    def run(spark, sf):
        return rounded(build_mart(materialized(macro_gold_long(spark, sf)), name))

    run.__name__ = f"q_{name}"
    return run


def q_mart_exchange_calendar(spark, sf):
    """The exchange-rate mart with calendar-exact lags (O-24b)."""
    return rounded(build_mart(materialized(macro_gold_long(spark, sf)), "fct_exchange_rate", calendar=True))


# ---- sinks and round trips --------------------------------------------------
def _gold_target(spark, sf):
    """A warehouse target loaded up to PUBLISHED_UNTIL, with one stale value."""
    gold = materialized(to_wide(macro_gold_long(spark, sf), SERIES_NAMES))
    path = work_dir(spark, "warehouse")
    stale = F.when(F.col("reference_month") == _date(STALE_MONTH), F.lit(0.0)).otherwise(F.col("selic"))
    versioned.replace(gold.where(F.col("reference_month") < _date(PUBLISHED_UNTIL)).withColumn("selic", stale), path)
    return gold, ParquetTarget(path)


def q_publish_append_new(spark, sf):
    gold, target = _gold_target(spark, sf)
    publish(spark, gold, target, mode="append_new")
    publish(spark, gold, target, mode="append_new")  # second load appends nothing
    return rounded(versioned.read(spark, target.path, gold.schema))


def q_publish_upsert(spark, sf):
    gold, target = _gold_target(spark, sf)
    publish(spark, gold, target, mode="upsert")
    return rounded(versioned.read(spark, target.path, gold.schema))


def q_high_water_month(spark, sf):
    gold, target = _gold_target(spark, sf)
    publish(spark, gold, target, mode="append_new")
    return high_water(spark, target).select(F.col("max_key").alias("max_month"))


def q_gold_overwrite(spark, sf):
    gold = materialized(to_wide(macro_gold_long(spark, sf), SERIES_NAMES))
    path = work_dir(spark, "gold")
    materialize(gold, path)
    return rounded(materialize(gold, path))


def q_mart_materialize(spark, sf):
    mart = build_mart(materialized(macro_gold_long(spark, sf)), "mart_macro_credit_features")
    path = work_dir(spark, "mart")
    materialize(mart, path)
    return rounded(materialize(mart, path))


def q_silver_roundtrip(spark, sf):
    d = latest_per_key(tables.obs_orders(spark, sf), ["series_name", "data"], ["o_orderkey"])
    path = work_dir(spark, "silver")
    from tslake.operators.upsert import write_partitioned

    write_partitioned(d.withColumn("year", F.year("data")), path, ["series_name", "year"])
    back = spark.read.schema(UPSERT_SCHEMA).parquet(path)
    return rounded(back.select("series_name", "data", "valor", "o_orderkey", "year"))


EVENT_ID_FIELD = [T.StructField("event_id", T.LongType())]


def land_events(spark, sf) -> str:
    """Land the events as raw text plus their manifests under a fresh root."""
    root = work_dir(spark, "landing")
    bronze.land(tables.event_raw(spark, sf), root)
    bronze.write_manifests(tables.event_manifests(spark, sf).drop("n_series", "n_failed"), root)
    return root


def q_landing_roundtrip(spark, sf):
    root = land_events(spark, sf)
    landed = bronze.read_landed(spark, root, EVENT_ID_FIELD)
    entries = gate_ops.manifest_entries(bronze.latest_manifests(bronze.read_manifests(spark, root)))
    clean = clean_rows(parse_raw(gate_ops.gate(landed, entries)))
    return rounded(clean.select("event_id", "series_name", "data", "valor", "batch_id"))


def q_lake_snapshot(spark, sf):
    """Snapshot of a lake root as of a day: the events landed with their
    manifests, then ``pipeline.snapshot`` (committed batches only)."""
    from tslake.plans import pipeline

    root = land_events(spark, sf)
    snap = pipeline.snapshot(spark, root, SNAPSHOT_AS_OF)
    return rounded(snap.select("series_name", "data", "valor", "batch_id"))


SNAPSHOT_DAYS = ["2024-01-05", "2024-01-12", "2024-01-20", "2024-02-10"]


def q_lake_snapshots(spark, sf):
    """Snapshots of several days from the history table, which three runs of
    ``bronze_to_silver`` built: the later batches come first, so the last runs
    put their intervals between those that are there."""
    from tslake.plans import pipeline

    root = work_dir(spark, "history")
    rows, manifests = materialized(tables.event_raw(spark, sf)), tables.event_manifests(spark, sf).drop("n_series", "n_failed")
    day = F.dayofmonth("ingestion_date") % 3
    for k in (2, 0, 1):
        # a correction: each batch also restates the first day's value of its series
        first = rows.where(day == k).withColumn("data", F.lit("01/01/2024"))
        bronze.land(rows.where(day == k).unionByName(first), root)
        bronze.write_manifests(manifests.where(day == k), root)
        pipeline.bronze_to_silver(spark, root, history=True)
    return rounded(pipeline.snapshots(spark, root, SNAPSHOT_DAYS))


def q_content_reconcile(spark, sf):
    """Objects changed after their manifest was written: the click objects of
    every seventh day get another value in each row."""
    root = work_dir(spark, "landing")
    rows = materialized(tables.event_raw(spark, sf))
    bronze.land(rows, root)
    bronze.write_manifests(gate_ops.with_checks(tables.event_manifests(spark, sf).drop("n_series", "n_failed"), rows), root)
    changed = rows.where((F.col("series_name") == LOST_SERIES) & (F.dayofmonth("ingestion_date") % 7 == 0))
    bronze.land(changed.withColumn("valor", F.concat("valor", F.lit("1"))), root)
    manifests = bronze.latest_manifests(bronze.read_manifests(spark, root))
    return gate_ops.altered_objects(manifests, bronze.read_landed(spark, root, EVENT_ID_FIELD))


CUT_LINES = 50  # every so many events land as a line that is cut off


def q_rescued_lines(spark, sf):
    """Landed lines that are no JSON objects end in the quarantine with their text."""
    root = work_dir(spark, "landing")
    ev = tables.event_raw(spark, sf)
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"data":"'), F.col("data"), F.lit('","val'))
    whole = F.to_json(F.struct("data", "valor", "event_id"))
    lines = ev.select(F.when(F.col("event_id") % CUT_LINES == 0, cut).otherwise(whole).alias("value"), *gate_ops.BATCH_KEYS)
    lines.write.partitionBy(*bronze.PARTITIONS).text(bronze.bronze_path(root))
    return quarantine_rows(parse_raw(bronze.read_landed(spark, root))).select(*gate_ops.BATCH_KEYS, "raw_line", "reason")


def q_stream_upsert(spark, sf):
    from tslake.sources.silver import read_silver, silver_path
    from tslake.streaming.stream import run_silver_stream

    root = land_events(spark, sf)
    run_silver_stream(spark, root)
    out = read_silver(spark, silver_path(root))
    return rounded(out.select("series_name", "data", "valor", "batch_id"))


INCREMENTAL_SPLIT = "1998-01-01"  # batches (order months) before this land in the first wave


def q_pipeline_incremental_gold(spark, sf):
    """The real pipeline on the orders: land and commit the first wave of
    monthly batches, Bronze -> Silver -> Gold; then the second wave with an
    incremental Gold update. Returns the wide Gold table."""
    from tslake.plans import pipeline

    root = work_dir(spark, "pipeline")
    landing = materialized(tables.orders_landing(spark, sf))  # read by both waves, for rows and manifests
    first = F.col("ingestion_date") < _date(INCREMENTAL_SPLIT)
    for wave in (first, ~first):
        batch = landing.where(wave)
        bronze.land(batch, root)
        bronze.write_manifests(tables.landing_manifests(batch), root)
        pipeline.bronze_to_silver(spark, root)
        pipeline.silver_to_gold(spark, root)
    return rounded(pipeline.read_gold(spark, root)[1])


# gold_from_feed: rows before this day are first loaded at half their value and,
# from the second day on, loaded again as they are; some are withdrawn (NULL).
FEED_LOADED_UNTIL, FEED_FROM = "1999-06-01", "1998-01-01"
WITHDRAWN_DAYS, WITHDRAWN_MONTHS = 5, [3, 9]
# marts_incremental: what is loaded at first, and the old month corrected later.
MART_LOADED_UNTIL, CORRECTED_MONTH = "1998-07-01", "1996-05-01"


def _load_silver(spark, root, obs, batch: int):
    from tslake.sources.silver import silver_path, upsert_silver

    rows = obs.select(
        "series_name",
        "data",
        "valor",
        F.date_add(_date("2024-01-01"), batch).alias("ingestion_date"),
        F.lit(f"b{batch}").alias("batch_id"),
        F.lit(None).cast("timestamp").alias("ingestion_timestamp"),
        F.year("data").alias("year"),
        F.month("data").alias("month"),
    )
    upsert_silver(spark, rows, silver_path(root))


def q_gold_from_feed(spark, sf):
    """Gold brought up to date from Silver's change feed: new observations,
    corrected ones and withdrawn ones. Returns the wide table."""
    from tslake.plans import pipeline

    root = work_dir(spark, "feed")
    silver = materialized(macro_silver(spark, sf))
    withdrawn = F.month("data").isin(WITHDRAWN_MONTHS) & (F.dayofmonth("data") <= WITHDRAWN_DAYS)
    waves = [
        silver.where(F.col("data") < _date(FEED_LOADED_UNTIL)).withColumn("valor", F.col("valor") * F.lit(0.5)),
        silver.where(F.col("data") >= _date(FEED_FROM)).withColumn("valor", F.when(~withdrawn, F.col("valor"))),
    ]
    for i, wave in enumerate(waves):
        _load_silver(spark, root, wave, i)
        pipeline.silver_to_gold(spark, root)
    return rounded(pipeline.read_gold(spark, root)[1])


def q_marts_incremental(spark, sf):
    """The feature mart after new months and the correction of an old one, of
    which only the rows that read a changed cell were computed anew."""
    from tslake.plans import pipeline

    root = work_dir(spark, "marts")
    silver = materialized(macro_silver(spark, sf))
    corrected = F.trunc("data", "month") == _date(CORRECTED_MONTH)
    waves = [
        silver.where(F.col("data") < _date(MART_LOADED_UNTIL)),
        silver.where((F.col("data") >= _date(MART_LOADED_UNTIL)) | corrected).withColumn("valor", F.when(corrected, F.col("valor") * F.lit(3.0)).otherwise(F.col("valor"))),
    ]
    for i, wave in enumerate(waves):
        _load_silver(spark, root, wave, i)
        pipeline.silver_to_gold(spark, root)
        out = pipeline.marts(spark, root)
    return rounded(out["mart_macro_credit_features"])


def q_ingest_run(spark, sf):
    """Two runs of the ingestion step on the raw orders text. In the second,
    one series has new rows, one nothing new, one is past the run's day, and
    two have no history: one of these arrives, the other fails, so the batch
    stays uncommitted. Per series: status, rows landed, of these clean ones
    and bad ones."""
    from tslake.plans import pipeline

    root = work_dir(spark, "ingest")
    raw = materialized(tables.orders_fetched(spark, sf))
    fetched = lambda rows: rows.select("series_name", "data", "valor")
    catalog = catalog_frame(spark).where(F.col("series_name").isin(list(tables.ORDERS_TO_CATALOG.values())))
    names = tables.ORDERS_TO_CATALOG
    of = lambda keys: F.col("series_name").isin([names[k] for k in keys])
    before = ~of(NO_HISTORY) & ((F.col("order_date") < _date(RUN_START)) | of(ALL_HISTORY))
    pipeline.ingest(spark, root, fetched(raw.where(before)), "first", RUN_START, catalog=catalog.where(~of(NO_HISTORY)))
    pipeline.bronze_to_silver(spark, root)
    run = (F.col("order_date") >= _date(RUN_START)) & ~of(NOT_LANDED)
    manifest = pipeline.ingest(spark, root, fetched(raw.where(run)), "second", RUN_DAY, catalog=catalog)
    landed = parse_raw(bronze.read_landed(spark, root, batches=[(RUN_DAY, "second")]))
    counts = landed.groupBy("series_name").agg(
        F.count(F.lit(1)).alias("n_landed"), F.count("data").alias("n_clean"), F.count_if(F.col("data").isNull()).alias("n_quarantined")
    )
    entries = manifest.select("status", F.explode("series").alias("series_name", "series_status"))
    return entries.join(counts, "series_name", "left").na.fill(0)


# ---- quality ------------------------------------------------------------------
def q_check_not_null(spark, sf):
    parsed = parse_raw(tables.raw_orders(spark, sf))
    return quality.check_not_null(parsed, ["series_name", "data", "valor"])


def q_check_unique_key(spark, sf):
    return quality.check_unique(tables.obs_orders(spark, sf), ["series_name", "data"])


def q_check_accepted_values(spark, sf):
    o = tables.table(spark, sf, "orders")
    return quality.check_accepted_values(
        o, {"o_orderstatus": ["F", "O"], "o_orderpriority": list(PRIORITY_COLUMNS)}
    )


QUERIES: dict[str, Query] = {
    "normalize_observations": q_normalize_observations,
    "quarantine_rows": q_quarantine_rows,
    "error_report": q_error_report,
    "dedupe_latest": q_dedupe_latest,
    "dedupe_by_sequence": q_dedupe_by_sequence,
    "dedupe_max_by": q_dedupe_max_by,
    "watermark_per_series": q_watermark_per_series,
    "after_watermark": q_after_watermark,
    "after_watermark_inclusive": q_after_watermark_inclusive,
    "after_watermark_lookback": q_after_watermark_lookback,
    "classify_series": q_classify_series,
    "classify_run": q_classify_run,
    "fetch_start": q_fetch_start,
    "accept_new_manifests": q_accept_new_manifests,
    "batch_status_rollup": q_batch_status_rollup,
    "committed_gate": q_committed_gate,
    "pending_batches": q_pending_batches,
    "pending_batches_log": q_pending_batches_log,
    "carry_forward_batch": q_carry_forward_batch,
    "snapshot_as_of": q_snapshot_as_of,
    "manifest_reconcile": q_manifest_reconcile,
    "batch_id_sanitize": q_batch_id_sanitize,
    "request_windows_daily": q_request_windows_daily,
    "request_windows_monthly": q_request_windows_monthly,
    "refetch_windows": q_refetch_windows,
    "upsert_merge": q_upsert_merge,
    "upsert_idempotent": q_upsert_idempotent,
    "upsert_out_of_order": q_upsert_out_of_order,
    "upsert_many_partitions": q_upsert_many_partitions,
    "upsert_change_feed": q_upsert_change_feed,
    "monthly_avg": q_monthly_avg,
    "monthly_first": q_monthly_first,
    "monthly_mixed_frequency": q_monthly_mixed_frequency,
    "gold_pivot": q_gold_pivot,
    "lag_features": q_lag_features,
    "change": q_change,
    "pct_change_mom": q_pct_change_mom,
    "pct_change_yoy": q_pct_change_yoy,
    "pct_change_calendar": q_pct_change_calendar,
    "spread_midpoint": q_spread_midpoint,
    "gold_macro": q_gold_macro,
    "mart_monetary": _mart("fct_monetary_policy"),
    "mart_activity": _mart("fct_economic_activity"),
    "mart_exchange": _mart("fct_exchange_rate"),
    "mart_credit": _mart("fct_credit_pf"),
    "mart_features": _mart("mart_macro_credit_features"),
    "mart_exchange_calendar": q_mart_exchange_calendar,
    "publish_append_new": q_publish_append_new,
    "publish_upsert": q_publish_upsert,
    "high_water_month": q_high_water_month,
    "gold_overwrite": q_gold_overwrite,
    "mart_materialize": q_mart_materialize,
    "silver_roundtrip": q_silver_roundtrip,
    "landing_roundtrip": q_landing_roundtrip,
    "stream_upsert": q_stream_upsert,
    "lake_snapshot": q_lake_snapshot,
    "lake_snapshots": q_lake_snapshots,
    "content_reconcile": q_content_reconcile,
    "rescued_lines": q_rescued_lines,
    "ingest_run": q_ingest_run,
    "pipeline_incremental_gold": q_pipeline_incremental_gold,
    "gold_from_feed": q_gold_from_feed,
    "marts_incremental": q_marts_incremental,
    "check_not_null": q_check_not_null,
    "check_unique_key": q_check_unique_key,
    "check_accepted_values": q_check_accepted_values,
}
