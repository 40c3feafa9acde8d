"""Explicit schemas: raw text, manifests, Silver and Gold. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# One landed observation as published by the source API: both fields are text.
RAW = T.StructType(
    [
        T.StructField("data", T.StringType(), True),
        T.StructField("valor", T.StringType(), True),
    ]
)

# Partition columns of the landing layout, batch first: a batch is the unit
# that is committed and applied, so reading pending batches lists only their
# folders. Always typed explicitly: a numeric batch id would otherwise be
# inferred as an integer.
LANDING_PARTITIONS = T.StructType(
    [
        T.StructField("ingestion_date", T.DateType(), True),
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("series_name", T.StringType(), True),
    ]
)

# One manifest per batch attempt: series -> status, plus the batch status, and
# what the landed rows of a series add up to (``operators.gate.content_checks``;
# NULL where the writer left none).
MANIFEST = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("ingestion_date", T.DateType(), True),
        T.StructField("series", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("checks", T.MapType(T.StringType(), T.StringType()), True),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("data", T.DateType(), True),
        T.StructField("valor", T.DoubleType(), True),
        T.StructField("ingestion_date", T.DateType(), True),
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("ingestion_timestamp", T.TimestampType(), True),
        T.StructField("series_name", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
    ]
)
SILVER_KEYS = ["series_name", "data"]
# Which row of a key is the newest.
SILVER_ORDER = ["ingestion_date", "batch_id", "valor"]
# Partition granularity of Silver. An upsert rewrites every partition it
# touches, so the granularity bounds the copy-on-write cost of a batch:
# (series, year) suits many small series (few files); (series, year, month)
# suits hot series whose yearly partition is too large to rewrite per batch.
# Both layouts are read with the same schema.
SILVER_PARTITIONS = ["series_name", "year"]
SILVER_PARTITIONS_MONTHLY = ["series_name", "year", "month"]

GOLD_LONG = T.StructType(
    [
        T.StructField("series_name", T.StringType(), True),
        T.StructField("reference_month", T.DateType(), True),
        T.StructField("valor", T.DoubleType(), True),
    ]
)

CHANGED_STATUSES = ("new_data", "success")
