"""Incremental state derived from data (O-10, O-11, O-14, O-16, O-17, O-18).

Nothing here is a mutable state file: watermarks and classifications are
aggregations over committed data, so they cannot drift from it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslake.functions.dates import month_start
from tslake.operators.dedupe import latest_per_key
from tslake.operators.small import small_side
from tslake.session import checkpoint_root
from tslake.sources.catalog import WINDOW_DAYS

#: Watermarks that may pass through the driver, a name and a date each.
KNOWN_SERIES = 2000


def watermarks(obs: DataFrame) -> DataFrame:
    """Per series: last reference date and row count; plus the last batch
    when the frame carries batch columns (O-11)."""
    aggs = [
        F.max("data").alias("last_reference_date"),
        F.count(F.lit(1)).alias("rows_ingested"),
    ]
    if "batch_id" in obs.columns and "ingestion_date" in obs.columns:
        aggs += [
            F.max("ingestion_date").alias("last_ingestion_date"),
            F.max_by("batch_id", F.struct("ingestion_date", "batch_id")).alias("last_batch_id"),
        ]
    return obs.groupBy("series_name").agg(*aggs)


def after_watermark(obs: DataFrame, wm: DataFrame, inclusive: bool = False, lookback_days: int = 0) -> DataFrame:
    """Rows newer than the series' watermark; all rows of a series without one.

    ``inclusive`` and ``lookback_days`` re-admit the boundary (and the days
    before it) so that source revisions can arrive (D5). Up to ``KNOWN_SERIES``
    watermarks, one row per series, are fetched once and come back as a small
    local relation; the oldest of them bounds the dates of the known series, as
    a literal that reaches the scan, so that files and row groups of old rows
    are skipped. More watermarks are joined as a table. Either way the
    observations are not shuffled.
    """
    last = F.col("_wm")
    bound = F.date_sub(last, lookback_days) if lookback_days else last
    newer = (F.col("data") >= bound) if inclusive else (F.col("data") > bound)
    known = wm.select("series_name", F.col("last_reference_date").alias("_wm"))
    rows = known.limit(KNOWN_SERIES + 1).collect()
    if len(rows) > KNOWN_SERIES:
        known = small_side(known)
    else:
        known = F.broadcast(obs.sparkSession.createDataFrame(rows, known.schema))
        if rows and all(r["_wm"] for r in rows):
            oldest = min(r["_wm"] for r in rows) - dt.timedelta(days=lookback_days)
            obs = obs.where((F.col("data") >= F.lit(oldest)) | F.col("series_name").isNull() | ~F.col("series_name").isin([r["series_name"] for r in rows if r["series_name"] is not None]))
    return obs.join(known, "series_name", "left").where(last.isNull() | newer).drop("_wm")


def fetch_start(catalog: DataFrame, wm: DataFrame) -> DataFrame:
    """Start of the next request per series (O-18b): watermark, else available_from."""
    return (
        catalog.join(wm.select("series_name", "last_reference_date"), "series_name", "left")
        .select(
            "series_name",
            "frequency",
            F.coalesce("last_reference_date", "available_from").alias("start_date"),
        )
    )


def classify(catalog: DataFrame, new_rows: DataFrame, wm: DataFrame, today: Column) -> DataFrame:
    """Status of every catalogue series for one ingestion run (O-14).

    ``up_to_date``: the request would start after ``today``; ``new_data``:
    rows past the watermark arrived; ``no_data``: nothing new but the series
    has history; ``failed``: no history and nothing arrived.
    """
    counts = new_rows.groupBy("series_name").agg(F.count(F.lit(1)).alias("n_new"))
    start = F.coalesce(F.col("last_reference_date"), F.col("available_from"))
    status = (
        F.when(start > today, F.lit("up_to_date"))
        .when(F.coalesce(F.col("n_new"), F.lit(0)) > 0, F.lit("new_data"))
        .when(F.col("last_reference_date").isNotNull(), F.lit("no_data"))
        .otherwise(F.lit("failed"))
    )
    return (
        catalog.select("series_name", "available_from")
        .join(wm.select("series_name", "last_reference_date"), "series_name", "left")
        .join(counts, "series_name", "left")
        .select("series_name", F.coalesce("n_new", F.lit(0)).alias("n_new"), status.alias("series_status"))
    )


def classify_monthly_batches(obs: DataFrame) -> DataFrame:
    """Classify every (series, monthly batch) over a whole history at once.

    A batch is a calendar month of reference dates. Months with rows are
    ``new_data``; months inside the series' history without rows are
    ``no_data``, also after the series' last row up to the last month of the
    whole table. Missing months are produced by exploding the gap between a
    series' consecutive months (per-series window over month aggregates, no
    cross join); the table's last month is a scalar subquery.
    """
    per_month = obs.groupBy("series_name", month_start("data").alias("batch_month")).agg(
        F.count(F.lit(1)).alias("n_new"), F.max("data").alias("max_data")
    )
    # Materialised once (series x months rows): the plan below and the scalar
    # subquery for the last month both read it, so the observations are
    # scanned once, not twice.
    checkpoint_root(obs.sparkSession)
    per_month = per_month.checkpoint(eager=True)
    last_month = per_month.agg(F.max("batch_month")).scalar()
    w = Window.partitionBy("series_name").orderBy("batch_month")
    nxt = F.coalesce(F.lead("batch_month").over(w), F.add_months(last_month, 1))
    gaps = per_month.select(
        "series_name",
        F.add_months("batch_month", 1).alias("_from"),
        F.add_months(nxt, -1).alias("_to"),
    ).where(F.col("_from") <= F.col("_to"))
    missing = gaps.select(
        "series_name",
        F.explode(F.sequence("_from", "_to", F.expr("INTERVAL 1 MONTH"))).alias("batch_month"),
        F.lit(0).cast("bigint").alias("n_new"),
        F.lit("no_data").alias("series_status"),
    )
    present = per_month.select("series_name", "batch_month", "n_new", F.lit("new_data").alias("series_status"))
    return present.unionByName(missing)


def carry_forward(entries: DataFrame) -> DataFrame:
    """For each (batch, series): the latest committed batch up to it that
    changed the series (O-16). A window per series over its batches."""
    changed = F.when(
        (F.col("batch_status") == "committed") & F.col("series_status").isin("new_data", "success"),
        F.col("batch_id"),
    )
    w = (
        Window.partitionBy("series_name")
        .orderBy("ingestion_date", "batch_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return entries.select(
        "batch_id",
        "ingestion_date",
        "series_name",
        F.last(changed, ignorenulls=True).over(w).alias("source_batch_id"),
    )


def snapshot_as_of(clean_committed: DataFrame, as_of: Column, order_extra: list[str] | None = None) -> DataFrame:
    """The full view of every series as of a batch date (O-17): committed
    rows landed up to ``as_of``, latest batch wins per (series, date)."""
    order = ["ingestion_date", "batch_id"] + list(order_extra or []) + ["valor"]
    upto = clean_committed.where(F.col("ingestion_date") <= as_of)
    return latest_per_key(upto, ["series_name", "data"], order)


def holes(spans: DataFrame, fetched: DataFrame) -> DataFrame:
    """What of each series' span ``[start_date, end_date]`` no fetched window
    ``(series_name, window_start, window_end)`` covers, as spans of the same kind
    (O-18): the days before, between and after them. Windows may overlap, touch,
    repeat or reach beyond the span. A window function over a series' windows;
    they are one row per request, not per observation."""
    known = fetched.select("series_name", "window_start", "window_end").where("window_start <= window_end")
    inside = spans.join(known, "series_name", "left").where("window_start is null or (window_end >= start_date and window_start <= end_date)")
    # a series without a window inside its span keeps one row that covers nothing
    bare = spans.join(inside.select("series_name").distinct(), "series_name", "left_anti").withColumns({"window_start": F.lit(None).cast("date"), "window_end": F.lit(None).cast("date")})
    rows = inside.unionByName(bare)
    order = Window.partitionBy("series_name").orderBy("window_start", "window_end")
    covered = F.max("window_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    last = F.lead("series_name").over(order).isNull()
    reached = F.greatest(F.coalesce(covered, F.date_sub("start_date", 1)), F.coalesce("window_end", F.date_sub("start_date", 1)))
    marked = rows.withColumn("_from", F.date_add(F.coalesce(covered, F.date_sub("start_date", 1)), 1)).withColumn("_rest", F.when(last, F.date_add(reached, 1)))
    keep = [c for c in spans.columns if c not in ("start_date", "end_date")]
    gaps = F.array(
        F.struct(F.greatest("_from", "start_date").alias("a"), F.date_sub("window_start", 1).alias("b")),
        F.struct(F.greatest("_rest", "start_date").alias("a"), F.when(F.col("_rest").isNotNull(), F.col("end_date")).alias("b")),
    )
    return marked.select(*keep, F.explode(gaps).alias("_g")).where("_g.a <= _g.b").select(*keep, F.col("_g.a").alias("start_date"), F.col("_g.b").alias("end_date"))


def request_windows(spans: DataFrame) -> DataFrame:
    """Split ``[start_date, end_date]`` per series into request windows (O-18).

    Window length is fixed per frequency (inclusive days); the next window
    starts the day after the previous one ends. Unknown frequency raises.
    """
    n = F.when(F.col("frequency") == "monthly", F.lit(WINDOW_DAYS["monthly"])).when(
        F.col("frequency") == "daily", F.lit(WINDOW_DAYS["daily"])
    ).otherwise(F.raise_error(F.concat(F.lit("Frequency not supported: "), F.col("frequency"))))
    spans = spans.where(F.col("start_date") <= F.col("end_date")).withColumn("_n", n)
    idx = F.sequence(F.lit(0), F.floor(F.datediff("end_date", "start_date") / F.col("_n")).cast("int"))
    out = spans.select("*", F.explode(idx).alias("window_index"))
    begin = F.date_add("start_date", F.col("window_index") * F.col("_n"))
    return out.select(
        "series_name",
        "frequency",
        "window_index",
        begin.alias("window_start"),
        F.least(F.date_add(begin, F.col("_n") - 1), F.col("end_date")).alias("window_end"),
    )
