"""Every state a series has ever been in, as intervals (O-17).

A history row ``(series_name, data, valor, batch_id, valid_from, valid_to)`` says
what the value of a date was from the landing day ``valid_from`` on until the
day before ``valid_to`` (NULL: until now). The snapshot of any day is a range
filter over the history; no landed row is read for it.

A batch closes the intervals it supersedes. Batches may come late: a batch of an
earlier day than others of the same key goes between their intervals. So the
intervals of the keys a batch touches are made anew from their own rows and the
batch's, and those of all other keys stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslake.operators.dedupe import latest_per_key

KEY = ["series_name", "data"]
COLUMNS = [*KEY, "valor", "batch_id", "valid_from", "valid_to"]


def intervals(rows: DataFrame) -> DataFrame:
    """History of committed rows (series_name, data, valor, ingestion_date,
    batch_id). Of several rows of a key on one day the newest batch's counts. A
    day that states what was known already has a row as well: a late batch may
    come between them."""
    days = latest_per_key(rows.select(*KEY, "valor", "ingestion_date", "batch_id"), [*KEY, "ingestion_date"], ["batch_id", "valor"])
    order = Window.partitionBy(*KEY).orderBy("ingestion_date")
    return days.select(*KEY, "valor", "batch_id", F.col("ingestion_date").alias("valid_from"), F.lead("ingestion_date").over(order).alias("valid_to"))


def extend(history: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The intervals of the keys of ``rows`` after these rows came: what takes
    the place of all intervals of the same keys in ``history``."""
    new = rows.select(*KEY, "valor", "ingestion_date", "batch_id")
    if history is None:
        return intervals(new)
    old = history.join(new.select(*KEY).distinct(), KEY, "left_semi")
    return intervals(old.select(*KEY, "valor", F.col("valid_from").alias("ingestion_date"), "batch_id").unionByName(new))


def as_of(history: DataFrame, day: Column) -> DataFrame:
    """What was known on a day: a range filter."""
    return history.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day)))
