"""Monthly cells kept up to date from a change feed (O-19).

A cell (series, month) keeps what its Gold value is made of, so that a change
needs no other row of the month: the number and the exact decimal sum of its
values for the mean, and the earliest non-NULL value for monthly series.
Changes are added and withdrawn; sums of decimals do not depend on the order in
which that happens. Two kinds of change cannot be told from the state alone, and
such cells come out as ``stale``, to be computed anew from their observations:
the earliest value is withdrawn (becomes NULL) and a later one takes its place,
and a mean has values outside the range that the decimals hold (``SMALLEST`` to
``LARGEST``; zero is inside).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslake.functions.dates import month_start

CELL = ["series_name", "reference_month"]
#: 20 digits before the point and 16 behind it; a sum of as many values as a month has stays inside.
DECIMAL = "decimal(36,16)"
SMALLEST, LARGEST = 1e-3, 1e12
STATE = (
    "series_name string, reference_month date, n long, total decimal(36,16), n_outside long, "
    "first_data date, first_valor double, mean double, commit long"
)
STATE_COLUMNS = [field.split()[0] for field in STATE.split(", ")]


def _inside(valor: Column) -> Column:
    return (valor == 0) | F.abs(valor).between(SMALLEST, LARGEST)


def _exact(valor: Column) -> Column:
    return F.when(_inside(valor), valor).otherwise(F.lit(0.0)).cast(DECIMAL)


def _count(condition: Column) -> Column:
    return F.sum(F.coalesce(condition, F.lit(False)).cast("long"))


def build(obs: DataFrame, commit: int) -> DataFrame:
    """The state of all cells of observations that are unique by (series, date)."""
    valor = F.col("valor")
    first = F.min(F.when(valor.isNotNull(), F.struct("data", "valor")))
    grouped = obs.groupBy("series_name", month_start("data").alias("reference_month")).agg(
        F.count("valor").alias("n"),
        F.sum(F.coalesce(_exact(valor), F.lit(0).cast(DECIMAL))).cast(DECIMAL).alias("total"),
        _count(~_inside(valor)).alias("n_outside"),
        first.alias("_first"),
        F.avg("valor").alias("_avg"),
    )
    mean = F.when(F.col("n_outside") == 0, _mean(F.col("total"), F.col("n"))).otherwise(F.col("_avg"))
    return grouped.select(
        *CELL, "n", "total", "n_outside", F.col("_first.data").alias("first_data"), F.col("_first.valor").alias("first_valor"), mean.alias("mean"), F.lit(commit).cast("long").alias("commit")
    )


def _mean(total: Column, n: Column) -> Column:
    """The mean of values inside the range; no order of sums decides its last bit."""
    return F.when(n > 0, total.cast("double") / n)


def changes(feed: DataFrame) -> DataFrame:
    """What a feed (series_name, data, old, new) adds to each cell: a row per
    cell, however many observations of it changed."""
    old, new = F.col("old.valor"), F.col("new.valor")
    zero = F.lit(0).cast(DECIMAL)
    gained = F.sum(F.coalesce(_exact(new), zero)).cast(DECIMAL)
    lost = F.sum(F.coalesce(_exact(old), zero)).cast(DECIMAL)
    return feed.groupBy("series_name", month_start("data").alias("reference_month")).agg(
        (_count(new.isNotNull()) - _count(old.isNotNull())).alias("n"),
        (gained - lost).cast(DECIMAL).alias("total"),
        (_count(~_inside(new)) - _count(~_inside(old))).alias("n_outside"),
        F.min(F.when(new.isNotNull(), F.struct("data", new.alias("valor")))).alias("first"),
        # at most the days of a month
        F.collect_set(F.when(new.isNull() & old.isNotNull(), F.col("data"))).alias("withdrawn"),
    )


def apply(state: DataFrame, change: DataFrame, commit: int) -> DataFrame:
    """The state after ``change``, with ``stale`` cells marked. A join by cell;
    untouched cells stay as they are, with the commit of their last change."""
    old, new = state.alias("s"), change.withColumnsRenamed({c: f"d_{c}" for c in ("n", "total", "n_outside")}).alias("d")
    joined = old.join(new, CELL, "full")
    touched = F.col("d_n").isNotNull()
    earlier = F.col("first_data").isNull() | (F.col("first.data") <= F.col("first_data"))
    takes = F.col("first").isNotNull() & earlier
    withdrawn = ~takes & F.array_contains("withdrawn", F.col("first_data"))
    plus = lambda name: F.coalesce(name, F.lit(0)) + F.coalesce(f"d_{name}", F.lit(0))
    total = (F.coalesce("total", F.lit(0).cast(DECIMAL)) + F.coalesce("d_total", F.lit(0).cast(DECIMAL))).cast(DECIMAL)
    out = joined.select(
        *CELL,
        plus("n").alias("n"),
        total.alias("total"),
        plus("n_outside").alias("n_outside"),
        F.when(takes, F.col("first.data")).otherwise(F.col("first_data")).alias("first_data"),
        F.when(takes, F.col("first.valor")).otherwise(F.col("first_valor")).alias("first_valor"),
        F.when(~touched, F.col("mean")).alias("_mean"),
        F.when(touched, F.lit(commit).cast("long")).otherwise(F.col("commit")).alias("commit"),
        (touched & (F.coalesce(withdrawn, F.lit(False)) | (plus("n_outside") > 0))).alias("stale"),
    )
    exact = _mean(F.col("total"), F.col("n"))
    return out.withColumn("mean", F.when(F.col("commit") == commit, exact).otherwise(F.col("_mean"))).select(*STATE_COLUMNS, "stale")


def values(state: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Long Gold from the cells: the mean of daily series, the earliest non-NULL
    value of monthly ones; series outside the catalogue are not part of it."""
    frequency = F.col("frequency")
    valor = (
        F.when(frequency == "daily", F.col("mean"))
        .when(frequency == "monthly", F.col("first_valor"))
        .otherwise(F.raise_error(F.concat(F.lit("Unsupported frequency: "), frequency)))
    )
    return state.join(frequencies.select("series_name", "frequency"), "series_name").select(*CELL, valor.alias("valor"))
