"""Observation views over the supplied TPC-H-style tables.

Each view reads only the columns it needs (column pruning reaches the
Parquet scan) and presents rows as observations ``(series_name, data, valor)``
plus the table's own key columns for deterministic tie-breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslake.functions.dates import format_source_date

# FIXED VALUES: which supplied series feed which catalogue series in the
# end-to-end pipeline (orders by priority, lineitem by return flag + status).
ORDERS_TO_CATALOG = {
    "1-URGENT": "selic",
    "2-HIGH": "selic_meta",
    "3-MEDIUM": "dolar_venda",
    "4-NOT SPECIFIED": "dolar_compra",
    "5-LOW": "ipca",
}
LINEITEM_TO_CATALOG = {
    "AF": "atividade_economica",
    "AO": "atividade_industria",
    "NF": "atividade_servicos",
    "NO": "credito_concedido_pf",
    "RF": "inadimplencia_pf",
    "RO": "taxa_credito_pf",
}
# Column names used for the orders priorities when they are pivoted as-is.
PRIORITY_COLUMNS = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "not_specified",
    "5-LOW": "low",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def obs_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("series_name"),
        F.col("o_orderdate").cast("date").alias("data"),
        F.col("o_totalprice").alias("valor"),
        "o_orderkey",
    )


def obs_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat("l_returnflag", "l_linestatus").alias("series_name"),
        F.col("l_shipdate").cast("date").alias("data"),
        F.col("l_extendedprice").alias("valor"),
        "l_orderkey",
        "l_linenumber",
    )


def obs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("series_name"),
        F.col("ts").cast("date").alias("data"),
        F.col("value").alias("valor"),
        "event_id",
        "ts",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders rendered as the source API's text, with realistic defects:
    ISO dates (urgent + pending orders), an impossible 31 February (open
    orders dated on the 31st), comma decimals (finished low-priority orders)
    and empty values (open high-priority orders)."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    data_text = (
        F.when((prio == "1-URGENT") & (status == "P"), F.date_format(d, "yyyy-MM-dd"))
        .when((F.dayofmonth(d) == 31) & (status == "O"), F.concat(F.lit("31/02/"), F.year(d).cast("string")))
        .otherwise(format_source_date(d))
    )
    price = F.col("o_totalprice").cast("string")
    valor_text = (
        F.when((status == "F") & (prio == "5-LOW"), F.regexp_replace(price, r"\.", ","))
        .when((status == "O") & (prio == "2-HIGH"), F.lit(""))
        .otherwise(price)
    )
    return o.select(
        prio.alias("series_name"), data_text.alias("data"), valor_text.alias("valor"), "o_orderkey", d.alias("order_date")
    )


def _map_series(col, mapping: dict[str, str]):
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(col == src, F.lit(dst)) if expr is None else expr.when(col == src, F.lit(dst)))
    return expr


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lineitem as catalogue series, with tie-break keys k1, k2."""
    o = obs_orders(spark, sf_dir).select(
        _map_series(F.col("series_name"), ORDERS_TO_CATALOG).alias("series_name"),
        "data",
        "valor",
        F.col("o_orderkey").alias("k1"),
        F.lit(0).alias("k2"),
    )
    li = obs_lineitem(spark, sf_dir).select(
        _map_series(F.col("series_name"), LINEITEM_TO_CATALOG).alias("series_name"),
        "data",
        "valor",
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").alias("k2"),
    )
    return o.unionByName(li)


# ---- batches derived from the events table -------------------------------
# A batch is one day of events (batch_id b<yyyyMMdd>, ingestion_date = day);
# the series are the event types. FIXED VALUE: a batch's ``error`` series
# fails when that day holds an error event with value above this threshold.
ERROR_FAILURE_THRESHOLD = 250.0


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs_events with the batch columns of its landing day."""
    return obs_events(spark, sf_dir).select(
        "*",
        F.concat(F.lit("b"), F.date_format("data", "yyyyMMdd")).alias("batch_id"),
        F.col("data").alias("ingestion_date"),
    )


def _event_series_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_observations(spark, sf_dir)
    failed = (F.col("series_name") == "error") & (F.max("valor") > ERROR_FAILURE_THRESHOLD)
    return ev.groupBy("batch_id", "ingestion_date", "series_name").agg(
        F.when(failed, F.lit("failed")).otherwise(F.lit("new_data")).alias("series_status")
    )


def event_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per day batch (status, series map, counts)."""
    from tslake.operators.gate import rollup_batches

    return rollup_batches(_event_series_status(spark, sf_dir))


def event_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest entries (batch, series, statuses) derived from the events."""
    per = _event_series_status(spark, sf_dir)
    batch = event_manifests(spark, sf_dir).select("ingestion_date", "batch_id", F.col("status").alias("batch_status"))
    return per.join(batch, ["ingestion_date", "batch_id"])


def event_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed raw text rows with their batch partition columns."""
    ev = event_observations(spark, sf_dir)
    return ev.select(
        format_source_date("data").alias("data"),
        F.col("valor").cast("string").alias("valor"),
        "event_id",
        "series_name",
        "ingestion_date",
        "batch_id",
    )


def orders_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders text (with its defects) as landed batches: one batch per
    order month (``batch_id`` m<yyyyMM>, ``ingestion_date`` = last day of that
    month), series named by the catalogue mapping."""
    return orders_fetched(spark, sf_dir).select(
        "data",
        "valor",
        "series_name",
        F.last_day("order_date").alias("ingestion_date"),
        F.concat(F.lit("m"), F.date_format("order_date", "yyyyMM")).alias("batch_id"),
    )


def orders_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders text as the source's answer, series named by the
    catalogue mapping, with the true date of each row as ``order_date``."""
    return raw_orders(spark, sf_dir).withColumn("series_name", _map_series(F.col("series_name"), ORDERS_TO_CATALOG))


def landing_manifests(landing: DataFrame) -> DataFrame:
    """Committed manifests for landed batches: every series that landed rows
    in a batch is ``new_data``."""
    from tslake.operators.gate import rollup_batches

    per = landing.groupBy("batch_id", "ingestion_date", "series_name").agg(F.lit("new_data").alias("series_status"))
    return rollup_batches(per).drop("n_series", "n_failed")
