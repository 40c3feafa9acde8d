"""Monthly aggregation and pivot to the wide Gold table (O-07, O-19, O-21)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslake.functions.dates import month_start
from tslake.operators.small import small_side


CELL = ["series_name", "reference_month"]


def _least(name: str) -> Column:
    """The least value of a column; NULL is less than any."""
    return F.when(F.count_if(F.col(name).isNull()) == 0, F.min(name))


def first_values(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """``value`` of each key's first row by ``order`` (NULL first; of equal rows
    the least value).

    ``min_by`` over a struct would sort all rows of a task, as structs fit no hash
    aggregation's buffer. Here two columns of the order are settled at a time:
    the least second one for each first one, then the least first one. The
    next two are settled among the rows that have these, which a semi join with
    the keys' settled columns leaves. So a task holds keys and values of the
    first column of a pair (dates, and what is left after them), never rows,
    and ``rows`` is read once for each pair.
    """
    keys = list(keys)
    columns = list(dict.fromkeys([*order, value]))
    columns = columns[: columns.index(value) + 1]  # what follows the value decides nothing
    best = None
    for i in range(0, len(columns), 2):
        if best is not None:
            settled = small_side(best.select(*(F.col(c).alias(f"_{c}") for c in best.columns)))
            rows = rows.join(settled, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in best.columns)), "left_semi")
        a, b = columns[i], columns[min(i + 1, len(columns) - 1)]
        if a == b:
            best = rows.groupBy(*keys).agg(_least(a).alias(a))
        else:
            pairs = rows.groupBy(*keys, a).agg(_least(b).alias(b))
            missing = F.col(a).isNull()
            second = F.when(F.count_if(missing) == 0, F.min_by(b, a)).otherwise(F.max(F.when(missing, F.col(b))))
            best = pairs.groupBy(*keys).agg(_least(a).alias(a), second.alias(b))
    return best.select(*keys, value)


def monthly(obs: DataFrame, frequencies: DataFrame | str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One value per (series, month): daily series -> mean of the month,
    monthly series -> the non-NULL value with the earliest date.

    ``frequencies`` is the catalogue (``series_name, frequency``; series
    outside it are not part of Gold) or one frequency for every series. It is
    joined with the cells, not with the observations: a shuffle of these by their
    few series, as the planner chooses for a catalogue of unknown size, would
    put a series into one task. ``tiebreak`` orders rows with the same date
    (Silver is unique per date and needs none; see ``first_values``).
    Two-stage hash aggregate: partial aggregation before the shuffle bounds each
    task's output by the number of (series, month) cells it sees.
    """
    rows = obs.withColumn("reference_month", month_start("data"))
    if tiebreak:
        means = rows.groupBy(*CELL).agg(F.avg("valor").alias("_avg"))
        first = first_values(rows.where(F.col("valor").isNotNull()), CELL, ["data", *tiebreak], "valor")
        both = means.withColumn("_first", F.lit(None)).unionByName(first.select(*CELL, F.lit(None).alias("_avg"), F.col("valor").alias("_first")))
        cells = both.groupBy(*CELL).agg(F.max("_avg").alias("_avg"), F.max("_first").alias("_first"))
    else:
        earliest = F.min_by("valor", F.when(F.col("valor").isNotNull(), F.col("data")))
        cells = rows.groupBy(*CELL).agg(F.avg("valor").alias("_avg"), earliest.alias("_first"))
    if isinstance(frequencies, str):
        joined = cells.withColumn("frequency", F.lit(frequencies))
    else:
        joined = cells.join(frequencies.select("series_name", "frequency").distinct(), "series_name")
    value = (
        F.when(F.col("frequency") == "daily", F.col("_avg"))
        .when(F.col("frequency") == "monthly", F.col("_first"))
        .otherwise(F.raise_error(F.concat(F.lit("Unsupported frequency: "), F.col("frequency"))))
    )
    return joined.select("series_name", "reference_month", value.alias("valor"))


def to_wide(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pivot long Gold to one row per month and one column per series.

    The explicit name list keeps the schema fixed (absent series are NULL
    columns) and needs no distinct pass. Long Gold holds one row per
    (series, month), so a conditional aggregate per name is the pivot, in one
    hash aggregation (``pivot()`` plans two).
    """
    series = F.col("series_name")
    return long.groupBy("reference_month").agg(
        *(F.max(F.when(series == F.lit(n), F.col("valor"))).alias(n) for n in names)
    )
