"""Date text handling and month arithmetic (O-07, O-10c, O-10d)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the source API's date text format and the characters that are
# not allowed in a batch id.
SOURCE_DATE_FORMAT = "dd/MM/yyyy"
ISO_DATE_FORMAT = "yyyy-MM-dd"
BATCH_ID_FORBIDDEN = "[:+/]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_source_date(c) -> Column:
    """``dd/MM/yyyy`` text to DATE; malformed or impossible dates give NULL."""
    return F.try_to_date(_col(c), SOURCE_DATE_FORMAT)


def parse_iso_date(c) -> Column:
    return F.try_to_date(_col(c), ISO_DATE_FORMAT)


def format_source_date(c) -> Column:
    return F.date_format(_col(c), SOURCE_DATE_FORMAT)


def parse_value(c) -> Column:
    """Numeric text to DOUBLE; text that is not a number gives NULL: ``""``,
    ``"1,5"``, and also ``NaN`` and ``Infinity``, which no source value is."""
    value = _col(c).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def month_start(c) -> Column:
    """First day of the month as a DATE (``date_trunc`` without the TIMESTAMP)."""
    return F.trunc(_col(c), "month")


def sanitize_batch_id(c) -> Column:
    return F.regexp_replace(_col(c), BATCH_ID_FORBIDDEN, "_")
