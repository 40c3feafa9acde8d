"""Lag features over the month axis (O-23, O-24, O-24a, O-24b, O-25).

The reference computes ``lag(x, k) OVER (ORDER BY reference_month)`` on the
wide Gold table: a positional lag over the months present in Gold. Here the
same result is computed in long form without an unpartitioned window over the
data and without a months x series spine:

1. the month axis = distinct months of Gold numbered 1..n (the only global
   step: one aggregate over at most twelve dates per calendar year);
2. every (series, month, value) cell is emitted once per needed offset ``k``
   with its month index moved forward by ``k`` (``explode``), so the cell
   lands on the month that reads it as ``lag k``;
3. one hash aggregation by month index (or by series and month index)
   gathers the value and its lags (conditional aggregates: each cell has one
   row); an inner join with the axis drops cells shifted past the last month.

A lag therefore sees the calendar gaps exactly as the wide window does: the
month before is the previous month *present in Gold*, and a series without a
row there gives NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.functions import growth


def month_axis(long: DataFrame) -> DataFrame:
    """``(reference_month, month_idx)`` for every month present in ``long``.

    One global aggregate collects the set of distinct months, then sorts and
    numbers it. That set is bounded by the calendar (12 per year: 561 months
    from 1980 to 2026), not by the data volume, and each task's partial set
    obeys the same bound.
    """
    months = long.agg(F.array_sort(F.collect_set("reference_month")).alias("_m"))
    return months.select(F.posexplode("_m").alias("_i", "reference_month")).select(
        "reference_month", (F.col("_i") + 1).alias("month_idx")
    )


def _shift(indexed: DataFrame, offsets: Sequence[int]) -> DataFrame:
    ks = F.array(*[F.lit(int(k)) for k in offsets])
    return (
        indexed.select("series_name", "month_idx", "valor", F.explode(ks).alias("_k"))
        .withColumn("month_idx", F.col("month_idx") + F.col("_k"))
    )


def lag_long(long: DataFrame, offsets: Iterable[int], axis: DataFrame | None = None) -> DataFrame:
    """``(series_name, reference_month, valor, lag_<k>...)`` in long form.

    A row exists for every (series, month) where the value or one of its lags
    exists, so pivoting it reproduces the wide form exactly.
    """
    ks = sorted({0} | {int(k) for k in offsets})
    axis = month_axis(long) if axis is None else axis
    indexed = long.join(axis, "reference_month")
    cells = _shift(indexed, ks)
    # one row per (series, month index, offset): a conditional aggregate is a
    # pivot in a single hash aggregation (pivot() would plan two)
    names = ["valor" if k == 0 else f"lag_{k}" for k in ks]
    wide = cells.groupBy("series_name", "month_idx").agg(
        *(F.max(F.when(F.col("_k") == k, F.col("valor"))).alias(n) for k, n in zip(ks, names))
    )
    return wide.join(axis, "month_idx").select("series_name", "reference_month", *names)


def calendar_lag(long: DataFrame, k: int) -> DataFrame:
    """Value at exactly ``k`` calendar months before (O-24b, D17): an equi
    join on (series, month + k), so a missing month gives NULL instead of
    shifting to an older one."""
    prev = long.select(
        "series_name",
        F.add_months("reference_month", int(k)).alias("reference_month"),
        F.col("valor").alias(f"lag_{k}"),
    )
    return long.join(prev, ["series_name", "reference_month"], "left")


@dataclass(frozen=True)
class Feature:
    """One output column: ``op`` over ``inputs`` with lag ``k``.

    ops: ``value`` (pass-through), ``lag``, ``change`` (x - lag k),
    ``pct_change`` ((x / lag k - 1) * 100), ``spread`` (a - b),
    ``midpoint`` ((a + b) / 2). A lag is positional over the months of Gold
    (the default, as the published marts) or, with ``calendar=True``, the
    value exactly ``k`` calendar months before (O-24b).
    """

    name: str
    op: str
    inputs: tuple[str, ...]
    k: int = 0
    calendar: bool = False

    def cells(self) -> set[tuple[str, int, bool]]:
        x, lagged = self.inputs[0], (self.inputs[0], self.k, self.calendar)
        if self.op == "value":
            return {(x, 0, False)}
        if self.op == "lag":
            return {lagged}
        if self.op in ("change", "pct_change"):
            return {(x, 0, False), lagged}
        if self.op in ("spread", "midpoint"):
            return {(x, 0, False), (self.inputs[1], 0, False)}
        raise ValueError(f"unknown feature op: {self.op}")


def _cell(series: str, k: int, calendar: bool = False) -> str:
    return f"{series}@{'c' if calendar and k else ''}{k}"


def _expr(f: Feature):
    c = lambda s, k=0: F.col(f"`{_cell(s, k, f.calendar)}`")
    x = f.inputs[0]
    if f.op == "value":
        return c(x)
    if f.op == "lag":
        return c(x, f.k)
    if f.op == "change":
        return growth.change(c(x), c(x, f.k))
    if f.op == "pct_change":
        return growth.pct_change(c(x), c(x, f.k))
    if f.op == "spread":
        return growth.spread(c(x), c(f.inputs[1]))
    if f.op == "midpoint":
        return growth.midpoint(c(x), c(f.inputs[1]))
    raise ValueError(f"unknown feature op: {f.op}")


def _calendar_shift(long: DataFrame, axis: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """Cells moved ``k`` calendar months forward and placed on the month axis
    by an equi join on the month (months absent from Gold drop out)."""
    ks = F.array(*[F.lit(int(k)) for k in offsets])
    moved = long.select("series_name", "valor", F.explode(ks).alias("_k"), "reference_month").withColumn(
        "reference_month", F.add_months("reference_month", F.col("_k"))
    )
    return moved.join(axis, "reference_month").select(
        "month_idx", "valor", F.concat(F.col("series_name"), F.lit("@c"), F.col("_k").cast("string")).alias("_cell")
    )


def dependencies(features: Sequence[Feature]) -> list[tuple[str, int, bool]]:
    """(series, k, calendar) of every cell that a row's features read: the cell
    k months before the row, by position or by the calendar."""
    return sorted(set().union(*(f.cells() for f in features)))


def affected_rows(cells: DataFrame, added: DataFrame, features: Sequence[Feature], axis: DataFrame) -> DataFrame:
    """``month_idx`` of the rows that must be computed anew when ``cells``
    (series_name, reference_month) have changed and the months ``added``
    (reference_month) are new on the axis. A new month moves the positions of
    those after it, which matters to as many rows as the longest lag spans."""
    needs = dependencies(features)
    row = F.struct(F.lit("").alias("series"), F.lit(0).alias("k"), F.lit(False).alias("calendar"))
    offsets = F.array(*[F.struct(F.lit(s).alias("series"), F.lit(k).alias("k"), F.lit(bool(c and k)).alias("calendar")) for s, k, c in needs]) if needs else F.array(row)
    read = cells.where(F.col("series_name").isin(sorted({s for s, _, _ in needs}))).select(
        "reference_month", F.explode(F.filter(offsets, lambda o: o["series"] == F.col("series_name"))).alias("o")
    )
    by_position = read.where("not o.calendar").join(axis, "reference_month").select((F.col("month_idx") + F.col("o.k")).alias("month_idx"))
    by_calendar = read.where("o.calendar").select(F.add_months("reference_month", F.col("o.k")).alias("reference_month")).join(axis, "reference_month").select("month_idx")
    longest = max((k for _, k, c in needs if not c), default=0)
    moved = added.join(axis, "reference_month").select(F.explode(F.sequence("month_idx", F.col("month_idx") + longest)).alias("month_idx"))
    return by_position.union(by_calendar).union(moved).distinct().join(axis.select("month_idx"), "month_idx", "left_semi")


def wide_cells(long: DataFrame, needs: Sequence[tuple[str, int, bool]], axis: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    """One row per month of the axis with the cells (series, k, calendar) that
    features read (``dependencies``), in one aggregation whatever the number of
    features. ``select_features`` makes features of them.

    ``long`` is Gold in long form (``series_name, reference_month, valor``);
    the axis is taken from all of it, as the wide table's rows are. With
    ``rows`` (month_idx) only these months' rows are computed.
    """
    names = [_cell(s, k, cal) for s, k, cal in needs]
    axis = month_axis(long) if axis is None else axis
    positional = [(s, k) for s, k, cal in needs if not (cal and k)]
    calendar = [(s, k) for s, k, cal in needs if cal and k]
    parts = []
    if positional:
        series = sorted({s for s, _ in positional})
        indexed = long.where(F.col("series_name").isin(series)).join(axis, "reference_month")
        parts.append(
            _shift(indexed, sorted({k for _, k in positional}))
            .select("month_idx", "valor", F.concat(F.col("series_name"), F.lit("@"), F.col("_k").cast("string")).alias("_cell"))
        )
    if calendar:
        series = sorted({s for s, _ in calendar})
        parts.append(_calendar_shift(long.where(F.col("series_name").isin(series)), axis, sorted({k for _, k in calendar})))
    shifted = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    shifted = shifted.where(F.col("_cell").isin(names))
    if rows is not None:
        shifted, axis = shifted.join(rows, "month_idx", "left_semi"), axis.join(rows, "month_idx", "left_semi")
    pivoted = shifted.groupBy("month_idx").agg(
        *(F.max(F.when(F.col("_cell") == n, F.col("valor"))).alias(n) for n in dict.fromkeys(names))
    )
    return axis.join(pivoted, "month_idx", "left")


def select_features(cells: DataFrame, features: Sequence[Feature]) -> DataFrame:
    return cells.select("reference_month", *(_expr(f).alias(f.name) for f in features))


def wide_features(long: DataFrame, features: Sequence[Feature], axis: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    """One row per month of the axis (or of ``rows``) with the requested feature
    columns."""
    return select_features(wide_cells(long, dependencies(features), axis, rows), features)
