"""Normalise raw observations (O-06) and report errors per series (O-18c)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.functions.dates import parse_source_date, parse_value


def parse_raw(raw: DataFrame) -> DataFrame:
    """Type the text columns ``data``/``valor``; keeps the text for auditing.

    ANSI mode is on in Spark 4, so only ``try_*`` parsing is used: a bad row
    never aborts the job, it becomes a NULL and is routed by ``quarantine_rows``.
    """
    return (
        raw.withColumnRenamed("data", "data_text")
        .withColumnRenamed("valor", "valor_text")
        .withColumn("data", parse_source_date("data_text"))
        .withColumn("valor", parse_value("valor_text"))
    )


def clean_rows(parsed: DataFrame, with_ingestion_ts: bool = False) -> DataFrame:
    """Rows with a valid date. A NULL ``valor`` is legal and kept."""
    out = (
        parsed.where(F.col("data").isNotNull())
        .drop("data_text", "valor_text", "raw_line")
        .withColumn("year", F.year("data"))
        .withColumn("month", F.month("data"))
    )
    if with_ingestion_ts:
        out = out.withColumn("ingestion_timestamp", F.current_timestamp())
    return out


def quarantine_rows(parsed: DataFrame) -> DataFrame:
    """Rows whose date is missing or not a valid ``dd/MM/yyyy`` date, and lines
    that could not be read at all, with their text (``raw_line``, if there is one)."""
    reason = F.when(F.col("data_text").isNull(), F.lit("missing_date")).otherwise(F.lit("bad_date"))
    if "raw_line" in parsed.columns:
        reason = F.when(F.col("raw_line").isNotNull(), F.lit("malformed_line")).otherwise(reason)
    return parsed.where(F.col("data").isNull()).drop("data", "valor").withColumn("reason", reason)


def normalize(raw: DataFrame, with_ingestion_ts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(clean, quarantine)`` from one parse of the raw frame."""
    parsed = parse_raw(raw)
    return clean_rows(parsed, with_ingestion_ts), quarantine_rows(parsed)


def error_report(parsed: DataFrame, by: str = "series_name") -> DataFrame:
    """One aggregation per series: rows, quarantined rows, NULL values."""
    return parsed.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("data").isNull()).alias("n_quarantined"),
        F.count_if(F.col("data").isNotNull() & F.col("valor").isNull()).alias("n_null_valor"),
    )
